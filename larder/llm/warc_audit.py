"""Fixity audit of replicated web archives with Merkle trees.

Each record of a file is a leaf: its ordinal, offset, length and SHA-256. Sixteen neighbours make a node that hashes its
offset range with its children's hashes in order; a file's last node is its root. Files meet by the leading hexadecimal
digits of their name's hash up to one root for the archive. Two replicas are compared from the top, and only the children of nodes
that differ are read, so an audit of healthy replicas reads one row of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import quoted
from larder.session import materialise

FANOUT_BITS = 4
# Leading hexadecimal digits of a file's hash below the archive's root.
FILE_DIGITS = 4
# Records of one file: a range of the key, and if more share it, parts of it.
KEYS_A_FILE = 512
RECORDS_A_FILE = 2048


def record(url: Column, html: Column) -> Column:
    """The bytes of a page's response record; nulls count as empty."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def leaves(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``file, ordinal, offset, length, digest, key, url`` of the records of ``pages``, as they lie in their files.

    A file is a range of ``KEYS_A_FILE`` keys in the order of key, url and hash; null keys, and ranges with more than
    ``RECORDS_A_FILE`` records, are dealt to several files by hash. Bodies are hashed where they are read and never
    shuffled. Rows that are wholly equal are counted before the shuffle and numbered after it, so a page that is a
    third of all rows fills many files. An empty table has no leaves.
    """
    return _manifest(pages, key, url, html).drop("copy")


def _records(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """``key, url, length, digest, copy, range`` of each record."""
    body = record(F.col(quoted(url)), F.col(quoted(html)))
    rows = pages.select(
        F.col(quoted(key)).cast("long").alias("key"), F.coalesce(F.col(quoted(url)), F.lit("")).alias("url"),
        F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"),
    )
    counted = rows.groupBy("key", "url", "length", "digest").agg(F.count("*").alias("n"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    return materialise(each.withColumn("range", F.coalesce(F.floor(F.col("key") / KEYS_A_FILE), F.lit(-1))), name="records")


def _dealt(each: DataFrame, mark: str = "") -> DataFrame:
    """Records with their ``file`` and ``ordinal``; ``mark`` tells files of their own apart."""
    parts = each.groupBy("range").agg(F.ceil(F.count("*") / RECORDS_A_FILE).alias("parts"))
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("key", "url", "digest", "copy"), F.col("parts"))).otherwise(0)
    placed = each.join(parts, "range").withColumn("file", F.concat("range", F.lit("-" + mark), part.cast("string")))
    order = Window.partitionBy("file").orderBy(F.col("key").asc_nulls_first(), "url", "digest", "copy")
    return placed.withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))


def _with_offsets(placed: DataFrame) -> DataFrame:
    before = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")
    return placed.select("file", "ordinal", offset, "length", "digest", "key", "url", "copy")


def _manifest(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    return _with_offsets(_dealt(_records(pages, key, url, html)))


def replica_leaves(manifest: DataFrame, replica: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The leaves of ``replica``, each where the primary's ``manifest`` has that record, so damage moves no other record.

    Records equal to one of the primary take its place. The others take the places of the same key and url that are
    left, in order, those of the same length first; records without a place are added ones and lie in files of their own. Places without a record are
    missing. Only records that equal none of the primary are numbered by key and url.
    """
    same = [F.coalesce("key", F.lit(0)).alias("k"), F.col("key").isNull().alias("z"), "url"]
    free = manifest.select(*same, "length", "digest", "copy", "file", "ordinal")
    rest, placed = _records(replica, key, url, html).select("*", *same[:2]), None
    columns = ["file", "ordinal", "length", "digest", "key", "url", "copy"]
    for shared in (["digest", "copy"], ["length"], []):
        on = ["k", "z", "url", *shared]
        if "digest" not in shared:
            one, on = Window.partitionBy(*on), [*on, "i"]
            free = free.withColumn("i", F.row_number().over(one.orderBy("file", "ordinal")))
            rest = rest.withColumn("i", F.row_number().over(one.orderBy("digest", "copy")))
        met = materialise(rest.join(free.select(*on, "file", "ordinal"), on, "left"), name="placed")
        found = met.where("file IS NOT NULL")
        free = free.join(found.select(*on), on, "left_anti").drop("i")
        rest = met.where("file IS NULL").drop("file", "ordinal", "i")
        placed = found.select(*columns) if placed is None else placed.unionByName(found.select(*columns))
    return _with_offsets(placed.unionByName(_dealt(rest, "added-").select(*columns))).drop("copy")


def tree(replicas: Sequence[DataFrame], materialised: bool = True) -> list[DataFrame]:
    """The trees of some replicas' leaves, level by level from the leaves up: ``replica, a, b, up_a, up_b, lo, hi, digest``.

    Up to a file's root ``a`` is the file and ``b`` a position in it, above that ``a`` is a group of files. A node has
    at most sixteen children within a file, and a file group as many as the archive has files for each group.
    """
    rows = None
    for i, leaf in enumerate(replicas):
        own = leaf.select(
            F.lit(i).alias("replica"), F.col("file").alias("a"), F.col("ordinal").alias("b"), F.col("offset").alias("lo"),
            (F.col("offset") + F.col("length")).alias("hi"), "digest",
        )
        rows = own if rows is None else rows.unionByName(own)
    level = materialise(_with_parent(rows, F.col("a"), F.shiftright("b", FANOUT_BITS)), name="leaves")
    levels = [level]
    most = level.agg(F.max("b")).first()[0] or 0
    for _ in range(max(1, -(-most.bit_length() // FANOUT_BITS)) - 1):
        levels.append(materialise(_with_parent(_parents(levels[-1]), F.col("a"), F.shiftright("b", FANOUT_BITS)), name="nodes"))
    group = F.substring(F.lpad(F.hex(F.xxhash64("a")), 16, "0"), 1, FILE_DIGITS)
    levels.append(materialise(_with_parent(_parents(levels[-1]), group, F.lit(0).cast("long")), name="files"))
    for digits in range(FILE_DIGITS - 1, -1, -1):
        shorter = F.substring("a", 1, digits) if digits else F.lit("")
        levels.append(materialise(_with_parent(_parents(levels[-1]), shorter, F.lit(0).cast("long")), name="groups"))
    return [*levels, _parents(levels[-1])]


def _with_parent(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.withColumns({"up_a": a, "up_b": b})


def _parents(level: DataFrame) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("a", "b", "lo", "hi", "digest")))
    text = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["lo"], c["hi"], c["digest"])), "\n")
    nodes = level.groupBy("replica", "up_a", "up_b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sha2(text, 256).alias("digest"))
    return nodes.withColumnsRenamed({"up_a": "a", "up_b": "b"})


def _differing(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """Nodes that the two replicas do not share, among the children of ``above``."""
    rows = level
    if above is not None:
        rows = rows.join(above.select(F.col("a").alias("up_a"), F.col("b").alias("up_b")), ["up_a", "up_b"], "left_semi")
    columns = ["a", "b", "lo", "hi", "digest"]
    one, two = (rows.where(F.col("replica") == i).select(*columns) for i in (0, 1))
    two = two.withColumnsRenamed({"lo": "lo2", "hi": "hi2", "digest": "digest2"})
    return one.join(two, ["a", "b"], "full").where("NOT (digest <=> digest2 AND lo <=> lo2 AND hi <=> hi2)")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """The leaves that differ: ``file, ordinal, lo, hi, lo2, hi2, status``; ``status`` is damaged, missing or added.

    The ranges are the record's bytes in the primary and in the replica. A record that changes its length moves all
    that follow it in its file; these are then damaged too, as their offsets are wrong. Equal or empty replicas give no
    rows. The driver only learns whether a level has differences.
    """
    levels, above = tree([primary, replica]), None
    for level in reversed(levels):
        above = materialise(_differing(level, above), name="differing")
        if above.isEmpty():
            break
    if above is None or "digest" not in above.columns:
        raise ValueError("no levels")
    status = F.when(F.col("digest2").isNull(), "missing").when(F.col("digest").isNull(), "added").otherwise("damaged")
    return above.select(F.col("a").alias("file"), F.col("b").alias("ordinal"), "lo", "hi", "lo2", "hi2", status.alias("status"))


def damaged_copy(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A replica for drills: every 97th page has its last letter exchanged, every 97th is lost but for its head.

    By ``key``; rows that share it are damaged alike. A page with a null key stays as it is; a null page
    stays null if its letter is exchanged, an empty one gets a letter. Other columns stay; an empty table gives an empty one.
    """
    k, body = F.col(quoted(key)), F.col(quoted(html))
    swapped = F.concat(F.substring(body, 1, F.greatest(F.length(body) - 1, F.lit(0))), F.lit("#"))
    return pages.withColumn(html, F.when(F.pmod(k, F.lit(97)) == 3, swapped).when(F.pmod(k, F.lit(97)) == 60, "").otherwise(body))


def report(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """``page_id, file, ordinal, lo, hi, sha256, status`` of each record of ``pages``; intact ones are never descended to.

    Null and empty pages are records of an empty body, long ones are hashed whole; repeated rows are records of their own;
    other columns are not read. An empty table gives an empty result.
    """
    own = materialise(_manifest(pages), name="primary")
    found = audit(own, materialise(replica_leaves(own, replica), name="replica")).select("file", "ordinal", "status")
    return own.join(found, ["file", "ordinal"], "left").select(
        F.col("key").alias("page_id"), "file", "ordinal", F.col("offset").alias("lo"), (F.col("offset") + F.col("length")).alias("hi"),
        F.col("digest").alias("sha256"), F.coalesce("status", F.lit("intact")).alias("status"),
    )


# DuckDB SQL for the registered query: every leaf compared with every leaf.
_LEAVES = """
  SELECT page_id, file, row_number() OVER w - 1 AS ordinal, coalesce(sum(strlen(rec)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo,
         strlen(rec) AS n, sha256(rec) AS sha256
  FROM (SELECT page_id, coalesce(url, '') AS url, floor(page_id / 512)::BIGINT::VARCHAR || '-0' AS file,
               'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
               || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
               || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec
        FROM {pages})
  WINDOW w AS (PARTITION BY file ORDER BY page_id NULLS FIRST, url, sha256(rec))"""
ORACLE = f"""
WITH other AS (SELECT page_id, url, CASE WHEN page_id % 97 = 3 THEN substr(html, 1, greatest(length(html) - 1, 0)) || '#'
                 WHEN page_id % 97 = 60 THEN '' ELSE html END AS html FROM pages),
one AS ({_LEAVES.format(pages="pages")}), two AS ({_LEAVES.format(pages="other")})
SELECT one.page_id, one.file, one.ordinal, one.lo, one.lo + one.n AS hi, one.sha256,
  CASE WHEN two.sha256 IS NULL THEN 'missing' WHEN one.lo = two.lo AND one.n = two.n AND one.sha256 = two.sha256 THEN 'intact' ELSE 'damaged' END AS status
FROM one LEFT JOIN two USING (file, ordinal)
"""
