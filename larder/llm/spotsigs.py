"""SpotSigs fingerprints: chains of content words that follow common-word anchors. DataFrame operations only.

A signature hashes an anchor (a word of a short list of very common ones) with the next ``CHAIN`` content words, other
anchors between them skipped. A text's fingerprint is the sorted set of its signatures. Two fingerprints are compared by
Jaccard; pairs whose set lengths already rule the wanted likeness out are not intersected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import quoted
from larder.session import materialise

CHAIN = 3
# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is was are be that this for with on by at from or it an "
    "der die das und ist den dem des ein eine zu mit von für auf sich nicht auch als im "
    "le la les des et est un une du dans pour par sur au que qui en de "
    "el los las y del con se su una por no lo al es"
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.transform(F.array(value), body)[0]


def signatures(text: Column) -> Column:
    """The fingerprint of a whole text as a sorted array of distinct 32-bit signatures; empty without words.

    A text without any anchor takes every word as one, so that it has a fingerprint too.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    anchors = sorted(set(ANCHORS.split()))

    def hashed(anchor: Column, words: Column, first: Column) -> Column:
        chain = [F.get(words, first + i) for i in range(CHAIN)]
        # Nulls after the last word do not enter the hash.
        return F.shiftright(F.xxhash64(anchor, *chain), 32).cast("int")

    def of(words: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(anchors), i)), lambda p: p.isNotNull())
        content = F.filter(words, lambda w: ~w.isin(anchors))
        every = F.transform(words, lambda w, i: hashed(w, words, i + 1))

        # The i-th anchor stands behind i other anchors, so place - i content words come before it.
        def spots(s: Column) -> Column:
            return F.transform(s["p"], lambda p, i: hashed(F.get(words, p), s["c"], p - i))

        found = _let(F.struct(places.alias("p"), content.alias("c")), lambda s: F.when(F.size(s["p"]) > 0, spots(s)))
        return F.array_sort(F.array_distinct(F.coalesce(found, every)))

    return _let(words, of)


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits for each signature."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two fingerprints, 1 for two empty ones; 0 if their lengths alone keep it below ``least``."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = _let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    pruned = short < F.lit(least) * long
    return F.when(long == 0, F.lit(1.0)).when(pruned | (short == 0), F.lit(0.0)).otherwise(common)


def _followers(rows: DataFrame) -> DataFrame:
    """Each distinct ``id, h`` with the one that follows it in descending order; the first follows the last.

    Rows are dealt by ranges; each range knows its own followers, and its last row is followed by the first one of the
    next range that has any, which is a table with one row for each range.
    """
    order = (F.col("id").desc_nulls_last(), F.col("h").asc())
    placed = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed = materialise(placed, name="ranges")
    first = F.min(F.struct(F.col("id").isNull().alias("no"), (-F.col("id")).alias("minus"), "h")).alias("first")
    by_range = Window.orderBy("range")  # one row for each range
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct((-F.col("first.minus")).alias("id"), F.col("first.h").alias("h"))
    later = F.coalesce(F.lead(own).over(by_range), F.first(own).over(whole)).alias("later")
    firsts = placed.groupBy("range").agg(first).select("range", later)
    inner = F.lead(F.struct("id", "h")).over(Window.partitionBy("range").orderBy(*order))
    out = placed.withColumn("next", inner).join(firsts, "range").withColumn("next", F.coalesce("next", "later"))
    return out.select("id", "h", "n", "copies", F.col("next.id").alias("next_id"), F.col("next.h").alias("next_h"))


def _keyed(rows: DataFrame, id_: str = "id", h: str = "h") -> DataFrame:
    """``rows`` with the key as the columns k, z and h, none of which is ever null."""
    return rows.withColumns({"k": F.coalesce(id_, F.lit(0)), "z": F.col(id_).isNull(), "h": F.col(h)})


def edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document's fingerprint against that of an edited text and of the next document in descending key order.

    The edited text has the last third of the code points (rounded down) replaced by as many first ones of the next
    document, or all of it. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row for each row of ``docs``. Nulls: a text counts as empty, a null key comes last. Equal keys are
    ordered by their texts' hash; of equal rows each but the last is followed by its copy. One row is followed by
    itself. An empty table gives an empty result.

    Texts and fingerprints are shuffled once by key and hash. A second shuffle, by the document that asks, has a third
    of the text at most. Equal rows are one before each shuffle and are repeated at the end.
    """
    id_, whole = F.col(quoted(key)).cast("long").alias("id"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    rows = docs.select(id_, whole.alias("t")).withColumn("h", F.xxhash64("t"))
    keys = rows.select("id", "h", F.char_length("t").cast("long").alias("n"))
    keys = keys.groupBy("id", "h").agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    follows = materialise(_followers(keys), name="followers")

    at = ["k", "z", "h"]
    rows = _keyed(rows).select(*at, "t", signatures(F.col("t")).alias("sigs")).dropDuplicates(at)
    asked = _keyed(follows.withColumnsRenamed({"id": "by_id", "h": "by_h"}), "next_id", "next_h")
    given = rows.join(asked, at).select(
        "by_id", "by_h", "copies", "n", F.substring(F.col("t"), F.lit(1), _third(F.col("n"))).alias("head"), F.col("sigs").alias("next_sigs")
    )
    own = rows.join(_keyed(given, "by_id", "by_h").drop("by_h"), at)

    follower = F.struct("head", F.col("next_sigs").alias("sigs"), F.lit(1).cast("long").alias("times"))
    copy = F.struct(F.substring(F.col("t"), F.lit(1), _third(F.col("n"))).alias("head"), "sigs", (F.col("copies") - 1).alias("times"))
    each = F.when(F.col("copies") > 1, F.array(follower, copy)).otherwise(F.array(follower))
    own = own.withColumn("next", F.explode(each))
    kept = F.substring(F.col("t"), F.lit(1), (F.col("n") - _third(F.col("n"))).cast("int"))
    own = own.withColumn("edited", F.concat(kept, "next.head"))
    own = own.withColumn("edited_sigs", signatures(F.col("edited")))
    out = own.select(
        F.col("by_id").alias("doc_id"), F.col("n").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("sigs")).alias("fingerprint"), as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next.sigs")).alias("near_next"),
        F.col("next.times").alias("times"),
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times")


def _third(n: Column) -> Column:
    return F.floor(n / 3).cast("int")


def length_bounds(least: float, most: int = 1 << 31) -> list[int]:
    """Where the partitions of set lengths begin: sets as like as ``least`` lie in the same or in neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(int(bounds[-1] / least + 1e-9) + 1)
    return bounds


def similar_pairs(fingerprints: DataFrame, least: float = 0.8, key: str = "doc_id", sigs: str = "sigs") -> tuple[DataFrame, DataFrame]:
    """Pairs of distinct fingerprints of a likeness of ``least`` or more, and which document has which.

    Returns ``a, b, likeness`` over classes of equal fingerprints (a < b), and ``doc_id, class``. Empty fingerprints are
    a class of their own without pairs; nulls count as empty. An empty table gives empty results.

    Sets are partitioned by length, and only the same and the next partition are compared. Within them, two sets that
    are alike share one of their rarest signatures, of which each has n - least * n + 1 to look at; position and length
    then bound the overlap before any set is intersected. Copies are one class, so they are not expanded into pairs; a
    signature of very many documents is nobody's rarest unless its sets have hardly any others.
    """
    rows = fingerprints.select(F.col(quoted(key)).alias("doc_id"), F.coalesce(F.col(quoted(sigs)), F.array().cast("array<int>")).alias("s"))
    rows = rows.withColumn("class", F.xxhash64("s"))
    sets = rows.where(F.size("s") > 0).groupBy("class").agg(F.first("s").alias("s"))
    sets = materialise(sets, name="fingerprints")
    each = sets.select("class", F.size("s").alias("n"), F.explode("s").alias("sig"))
    rarity = each.groupBy("sig").agg(F.count("*").alias("c"))
    ordered = F.array_sort(F.collect_list(F.struct("c", "sig")))  # one fingerprint's own signatures
    ranked = each.join(rarity, "sig").groupBy("class", "n").agg(ordered.alias("r"))
    # One millionth against rounding: looking at one more signature loses nothing.
    first = F.slice("r", F.lit(1), F.greatest(F.lit(1), F.col("n") - F.ceil(F.col("n") * least - 1e-6).cast("int") + 1))
    part = F.size(F.filter(F.lit(length_bounds(least)), lambda b: b <= F.col("n")))
    keys = ranked.select("class", "n", part.alias("part"), F.posexplode(F.transform(first, lambda x: x["sig"])).alias("at", "sig"))
    keys = materialise(keys, name="rare-signatures")

    longer = keys.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("at").alias("to"), "sig", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    met = keys.withColumnRenamed("class", "a").join(longer, ["part", "sig"])
    rest = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("to"))
    alike = (F.col("n") >= F.col("m") * least - 1e-6) & (rest >= (F.col("n") + F.col("m")) * (least / (1 + least)) - 1e-6)
    # The shorter set asks the longer; sets of one length ask by class.
    asks = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("a") < F.col("b")))
    pairs = met.where(asks & alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    whole = sets.select(F.col("class").alias("b"), F.col("s").alias("s2"))
    found = pairs.join(sets.withColumnRenamed("class", "a"), "a").join(whole, "b")
    found = found.select("a", "b", likeness(F.col("s"), F.col("s2"), least).alias("likeness")).where(F.col("likeness") >= least)
    return found, rows.select("doc_id", "class")
