"""Full-text search: an inverted index with BM25 ranking, built and queried as DataFrame jobs.

The index is one row for each (term, cell): a cell is a set of about ``CELL`` documents of like length, the same for all
terms, and the row holds the term's postings there and the greatest score factor among them. Scores of whole documents are
sums over the terms, so the sum of a cell's greatest factors bounds them. A search for the best documents reads these bounds
alone first, scores the cells of the greatest bounds, and then only the cells whose bound reaches the n-th score found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from larder.constants import BM25_B, BM25_K1, FULL_TEXT_ROWS, SEARCH_ROWS
from larder.functions.text import STEMMERS, words
from larder.operators.filters import all_of
from larder.session import concurrently, local_rows, materialise, remove, scratch
from larder.sources.tables import TEXT_BYTES, export, planned_bytes, sink_width, write_clustered


# Documents of a cell, about, and cells that a search scores before it trusts a bound.
CELL = 512
PROBED = 16
# Index rows of at least so many postings are laid out apart from the others, and bytes of a row and a posting in a task, about.
FREQUENT = 64
ROW, POSTING = 64, 72
# Sums of the same parts may differ in their last digits.
SLACK = 1e-9


@dataclass(frozen=True)
class TextIndex:
    """A stored index. ``blocks``: one row per (term, cell) with the number of postings, the greatest score factors (all
    fields together, and each) and the postings. ``terms``: document frequency and idf per term. ``corpus``: one row,
    document count, mean length and the settings that the index was built with; the numbers are read once, when the index
    is opened.
    """

    blocks: DataFrame
    terms: DataFrame
    corpus: DataFrame
    key: str
    fields: tuple[str, ...]
    pattern: str
    stemmer: str
    avgdl: float | None

    @property
    def postings(self) -> DataFrame:
        """One row per (term, key) with the document length and one tf column per field."""
        return self.blocks.select("term", F.explode("docs").alias("d")).select(f"d.{self.key}", "term", "d.dl", *(f"d.{_tf(f)}" for f in self.fields))


CORPUS = "n_docs bigint, avgdl double, key string, key_type string, fields array<string>, pattern string, stemmer string"
TERMS = "term string, df bigint, idf double"


def _tf(field: str) -> str:
    return f"tf_{field}"


def _top(field: str) -> str:
    return f"top_{field}"


def _parts(path: str) -> tuple[str, str]:
    """The folders of rows with many and with few postings."""
    return f"{path}/blocks/frequent", f"{path}/blocks/rare"


def open_index(spark: SparkSession, path: str) -> TextIndex:
    """The index with the settings it was built with; all schemas are declared, no file is opened to guess one."""
    corpus = spark.read.schema(CORPUS).parquet(f"{path}/corpus")
    made = corpus.first()
    counts = ", ".join(f"`{_tf(f)}`: int" for f in made["fields"])
    tops = ", ".join(f"`{_top(f)}` double" for f in made["fields"])
    docs = f"docs array<struct<`{made['key']}`: {made['key_type']}, dl: int, {counts}>>"
    blocks = spark.read.schema(f"term string, cell bigint, n bigint, top double, {tops}, {docs}").parquet(*_parts(path))
    terms = spark.read.schema(TERMS).parquet(f"{path}/terms")
    return TextIndex(
        blocks, terms, corpus, made["key"], tuple(made["fields"]), made["pattern"], made["stemmer"], made["avgdl"]
    )


def _factor(tf: Column, dl: Column, avgdl: float | None, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """What a document's count of a term contributes to its score, but for the term's weight."""
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / F.lit(avgdl))
    return tf * F.lit(k1 + 1) / (tf + norm)


def _cells(length: Column, key: str, sizes: Sequence[Row]) -> Column:
    """The cell of a document: its class of length, and a part of the class by the key's hash."""
    parts = F.create_map(*(F.lit(v) for r in sizes for v in (r["length"], -(-r["n"] // CELL)))) if sizes else None
    of_class = F.lit(1) if parts is None else parts[length]
    return (F.shiftleft(length.cast("long"), 40) + F.pmod(F.xxhash64(key), of_class)).cast("long")


def create_index(
    df: DataFrame,
    path: str,
    key: str = "recipe_id",
    fields: Sequence[str] = ("title", "ingredients_validated"),
    pattern: str = "[a-z0-9]+",
    stemmer: str = "english",
) -> TextIndex:
    """Index text or array columns (array items are read one after the other) and store the index.

    No stop words. ``key`` is unique. The texts, smaller than their postings, are shuffled once, by cell, so that counting
    words and listing postings need no further shuffle and a word found in every document stays spread. The lists are
    written once, then clustered by term, long and short ones apart: a query reads the files of its terms only.
    A row holds the postings of one cell, so a word of every document is as many rows as there are cells.
    """
    spark = df.sparkSession

    def tokens(field: str) -> Column:
        is_array = isinstance(df.schema[field].dataType, ArrayType)
        return words(F.array_join(field, " ") if is_array else F.col(field), pattern)

    def tagged(i: int) -> Column:
        return F.transform(f"_t{i}", lambda t: F.struct(F.lit(i).alias("field"), t.alias("word")))

    parts = range(len(fields))
    size = reduce(add, (F.size(tokens(f)) for f in fields))
    # The classes are of logarithms of an int, some 220 at most; their numbers go to the driver. Characters are counted, so
    # that the shuffle waits for no words.
    chars = reduce(add, (F.coalesce(F.length(F.array_join(f, " ") if isinstance(df.schema[f].dataType, ArrayType) else F.col(f)), F.lit(0)) for f in fields))
    length = F.floor(F.log1p(chars) * 10).cast("int")
    sizes = df.select(length.alias("length"), size.alias("dl")).groupBy("length").agg(F.count("*").alias("n"), F.sum("dl").alias("dl")).collect()
    n_docs, total = sum(r["n"] for r in sizes), sum(r["dl"] for r in sizes)
    avgdl = total / n_docs if n_docs else None
    width = sink_width(planned_bytes(df), int(spark.conf.get("spark.sql.shuffle.partitions")), TEXT_BYTES)
    placed = df.select(key, *fields, _cells(length, key, sizes).alias("_cell")).repartition(width, "_cell")
    docs = placed.select(key, "_cell", *(tokens(f).alias(f"_t{i}") for i, f in enumerate(fields)))
    occurrences = docs.select(
        key,
        "_cell",
        reduce(add, (F.size(f"_t{i}") for i in parts)).alias("dl"),
        F.explode(F.concat(*(tagged(i) for i in parts))).alias("t"),
    ).select(key, F.col("_cell").alias("cell"), "dl", STEMMERS[stemmer](F.col("t.word")).alias("term"), "t.field")
    counted = occurrences.groupBy("cell", key, "term", "dl").agg(
        *(F.count_if(F.col("field") == i).cast("int").alias(_tf(f)) for i, f in enumerate(fields))
    )
    tfs = [F.col(_tf(f)) for f in fields]
    tops = {"top": reduce(add, tfs), **{_top(f): tf for f, tf in zip(fields, tfs, strict=True)}}
    blocks = counted.groupBy("term", "cell").agg(
        F.count("*").alias("n"),
        *(F.max(_factor(tf, F.col("dl"), avgdl)).alias(name) for name, tf in tops.items()),
        F.collect_list(F.struct(key, "dl", *tfs)).alias("docs"),  # one cell's documents
    )
    copy = scratch(spark, "postings")
    blocks = materialise(blocks, copy)
    found = F.col("df")
    idf = F.log((F.lit(n_docs) - found + F.lit(0.5)) / (found + F.lit(0.5)) + F.lit(1.0))
    terms = blocks.groupBy("term").agg(F.sum("n").alias("df")).withColumn("idf", idf)
    # Ranges hold like numbers of rows, so rows of like size are laid out together: else the long rows of one frequent term fill
    # a range. Two rows of sums say how wide the layout must be.
    many = F.col("n") >= FREQUENT
    sums = {r["many"]: ROW * r["rows"] + POSTING * r["n"] for r in blocks.groupBy(many.alias("many")).agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    frequent, rare = _parts(path)
    made = [(n_docs, avgdl, key, dict(df.dtypes)[key], list(fields), pattern, stemmer)]
    corpus = spark.createDataFrame(made, CORPUS)
    concurrently(
        spark,
        [
            lambda: write_clustered(blocks.filter(many), frequent, ["term", "cell"], n_bytes=sums.get(True, 0)),
            lambda: write_clustered(blocks.filter(~many), rare, ["term", "cell"], n_bytes=sums.get(False, 0)),
            lambda: write_clustered(terms, f"{path}/terms", ["term"]),
            lambda: export(corpus, f"{path}/corpus"),
        ],
    )
    remove(spark, copy)
    return open_index(spark, path)


def query_terms(spark: SparkSession, query: str, pattern: str = "[a-z0-9]+", stemmer: str = "english") -> list[str]:
    """The distinct terms of a search string, by the same expressions that built the index.

    A table of one literal row is folded by the optimizer, so no job runs.
    """
    row = spark.sql("SELECT * FROM VALUES (:q) AS t(q)", args={"q": query}).select(
        F.array_distinct(F.transform(words("q", pattern), STEMMERS[stemmer])).alias("terms")
    )
    return row.first()["terms"]


def _terms_of(index: TextIndex, query: str) -> list[str]:
    return query_terms(index.postings.sparkSession, query, index.pattern, index.stemmer)


def _counts(index: TextIndex, blocks: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """``key, idf, dl, tf`` of the postings of ``blocks`` with a term in the fields."""
    tf = reduce(add, (F.col(f"d.{_tf(f)}") for f in (fields or index.fields)))
    found = blocks.select("idf", F.explode("docs").alias("d"))
    return found.select(f"d.{index.key}", "idf", "d.dl", tf.alias("tf")).filter("tf > 0")


def _asked(index: TextIndex, wanted: Sequence[str]) -> DataFrame:
    """The terms' blocks with their ``idf``; the filter reaches both scans, and a row for each term goes to the tasks."""
    of_terms = F.col("term").isin(list(wanted))
    return index.blocks.filter(of_terms).join(F.broadcast(index.terms.filter(of_terms).select("term", "idf")), "term")


def matches(index: TextIndex, query: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Keys of the documents that hold any query term in the fields, unranked."""
    return _counts(index, _asked(index, _terms_of(index, query)), fields).select(index.key).distinct()


def _scores(index: TextIndex, blocks: DataFrame, fields: Sequence[str] | None, k1: float, b: float) -> DataFrame:
    part = F.col("idf") * _factor(F.col("tf"), F.col("dl"), index.avgdl, k1, b)
    return _counts(index, blocks, fields).groupBy(index.key).agg(F.sum(part).alias("score"))


def bm25(
    index: TextIndex,
    query: str,
    fields: Sequence[str] | None = None,
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> DataFrame:
    """(key, score) of every document that holds any query term in the fields.

    Document length, document frequency and the corpus numbers are those of the whole index; ``fields``
    limits the term frequency.
    """
    return _scores(index, _asked(index, _terms_of(index, query)), fields, k1, b)


def bounds(index: TextIndex, wanted: Sequence[str], fields: Sequence[str] | None = None) -> DataFrame:
    """``cell, bound, n``: what no document of the cell can exceed, and the number of postings. No posting is read."""
    fields = fields or index.fields
    # A factor grows with the count, so that of all fields together bounds any of them.
    top = F.col(_top(fields[0])) if len(fields) == 1 else F.col("top")
    found = _asked(index, wanted).groupBy("cell").agg(F.sum(F.col("idf") * top).alias("bound"), F.sum("n").alias("n"))
    return found.filter("bound > 0")


def reaching(index: TextIndex, wanted: Sequence[str], fields: Sequence[str] | None, least: float | None, digits: int) -> DataFrame:
    """The cells that may hold a document with the rounded score ``least``; all if there is none yet."""
    found = bounds(index, wanted, fields)
    return found if least is None else found.filter(F.col("bound") >= least - 10.0**-digits - SLACK)


def top_scores(
    index: TextIndex, query: str, n: int = FULL_TEXT_ROWS, fields: Sequence[str] | None = None, digits: int = 6, probed: int = PROBED
) -> tuple[DataFrame, list | None]:
    """The n best of ``bm25``, rounded, ties by key, and their keys if they are known already.

    The same rows as ``best(bm25(...))``. Cells of the greatest bounds are scored first; the n-th score there leaves out all
    cells whose bound is below it. If it leaves out all others, the n rows are known here; else they are a frame that reads
    the cells that are left. On the driver are ``probed`` bounds and n rows.
    """
    spark, wanted = index.blocks.sparkSession, _terms_of(index, query)
    kind = StructType([index.blocks.schema["docs"].dataType.elementType[index.key], StructField("score", DoubleType())])
    if not wanted or not n:
        return local_rows(spark, [], kind), []
    asked = _asked(index, wanted)
    first = bounds(index, wanted, fields).orderBy(F.desc("bound"), "cell").limit(probed + 1).collect()
    some = asked.filter(F.col("cell").isin([r["cell"] for r in first[:probed]]))
    rows = best(_scores(index, some, fields, BM25_K1, BM25_B), index.key, n, digits).collect() if first else []
    least = rows[-1]["score"] if len(rows) == n else None
    if len(first) <= probed or least is not None and first[probed]["bound"] < least - 10.0**-digits - SLACK:
        return local_rows(spark, rows, kind), [r[0] for r in rows]
    left = asked.join(reaching(index, wanted, fields, least, digits), "cell", "left_semi")
    return best(_scores(index, left, fields, BM25_K1, BM25_B), index.key, n, digits), None


def best(scores: DataFrame, key: str, n: int = FULL_TEXT_ROWS, digits: int = 6) -> DataFrame:
    """The n best scores, rounded, ties by key."""
    rounded = scores.withColumn("score", F.round("score", digits))
    return rounded.orderBy(F.desc("score"), key).limit(n)


def full_text(
    main: DataFrame,
    index: TextIndex,
    query: str,
    n: int = FULL_TEXT_ROWS,
    fields: Sequence[str] | None = None,
    columns: Sequence[str] = ("recipe_id", "title", "nutri_score", "cook_time_category"),
) -> DataFrame:
    """The n best matches with their catalog columns, best first; a blank query finds nothing.

    ``columns`` start with the index's key. The n best keys, at most n rows, are broadcast to the catalog's scan; where
    they are known already, they filter it.
    """
    top, keys = top_scores(index, query, n, fields)
    found = main.select(*columns)
    found = (found if keys is None else found.filter(F.col(index.key).isin(keys))).join(F.broadcast(top), index.key)
    return found.orderBy(F.desc("score"), index.key).limit(n)


def full_text_by_name(main: DataFrame, index: TextIndex, query: str, n: int = SEARCH_ROWS, field: str = "title") -> DataFrame:
    columns = ("recipe_id", "title", "cook_minutes", "nutri_score", "image_url")
    return full_text(main, index, query, n, [field], columns)


def full_text_by_item(
    main: DataFrame, index: TextIndex, query: str, n: int = SEARCH_ROWS, field: str = "ingredients_raw"
) -> DataFrame:
    columns = ("recipe_id", "title", "cook_minutes", "nutri_score", "image_url", field)
    return full_text(main, index, query, n, [field], columns)


def full_text_advanced(
    main: DataFrame,
    index: TextIndex,
    name: str | None = None,
    ingredient: str | None = None,
    max_time: int | None = None,
    nutri_score: str | None = None,
    n: int = SEARCH_ROWS,
    name_field: str = "title",
    item_field: str = "ingredients_raw",
    order_by: str | None = None,
) -> DataFrame:
    """Recipes under optional facets that match the text in the fields asked for; unranked.

    Name searches the name field, ingredient the item field, both search both. ``order_by`` makes the
    choice of n rows reproducible; without it any n rows come back and the scan stops early.
    """
    parts = []
    if max_time:
        parts.append(F.col("cook_minutes") <= max_time)
    if nutri_score:
        parts.append(F.col("nutri_score") == nutri_score.upper())
    found = main.filter(all_of(parts))
    text = " ".join(t for t in (name, ingredient) if t)
    if text:
        fields = [f for f, asked in ((name_field, name), (item_field, ingredient)) if asked]
        found = found.join(matches(index, text, fields), index.key, "left_semi")
    found = found.orderBy(order_by) if order_by else found
    return found.limit(n).select(
        "recipe_id", "title", "cook_minutes", "cook_time_category", "nutri_score", "image_url", item_field
    )
