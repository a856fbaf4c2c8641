"""Mixing sources to target weights: a min-cost flow over membership patterns decides, a seeded draw selects.

A document may belong to several sources; documents with the same set of sources share a pattern. Patterns are sums, so
the flow's graph has one node for each pattern and source, whatever the number of documents: capacity for every pass
over a pattern (each further pass costs more a word than the one before), on to the pattern's sources, each with its
target. The flow's amounts become cuts in a seeded order of the pattern's documents. So whether a document is taken
depends on its own row and the cuts alone: texts are neither shuffled nor joined.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.llm.common import WORD_PATTERN, fresh, quoted
from larder.session import local_rows, materialise

WEIGHTS = (5.0, 2.0, 1.0)
PASSES = 3
SEED = 7
# Rows of the seeded order in one bucket of its running sums.
BUCKET_ROWS = 4096
# A pattern's gap is closed by so many documents that fit, and one that is nearest.
CLOSING_ROUNDS = 3
# The driver holds one row for each pattern and solves the flow over them.
MOST_PATTERNS = 20_000

Source = str | None


def word_count(text: str) -> Column:
    """Number of words of the whole text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(quoted(text)), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def by_name(sources: set[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[Source, int], total: float, weights: Sequence[float] = WEIGHTS, most: float = PASSES) -> dict[Source, float]:
    """Shares of ``total`` by repeating weights; one above ``most`` times its source's size stops there and the excess
    is shared anew among the others."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(by_name(set(sizes)))}
    out: dict[Source, float] = {}
    while len(out) < len(sizes):
        free = [s for s in by_name(set(sizes)) if s not in out]
        unit = max(0.0, total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        out |= {s: most * float(sizes[s]) for s in over} or {s: unit * weight[s] for s in free}
    return out


def min_cost_flow(
    sizes: dict[str, int], members: dict[str, list[Source]], quotas: dict[Source, int], passes: int = PASSES
) -> dict[tuple[str, Source], int]:
    """Words that each pattern gives each of its sources: as many as the quotas ask for, repeated as little as can be.

    Pass r over a pattern costs r a word, so repetition is convex and a pattern is used up evenly before it is repeated.
    Shortest augmenting paths with node potentials; each path empties an edge.
    """
    start, end, heads, room, cost = 0, 1, [], [], []
    edges: list[list[int]] = [[], []]

    def link(a: int, b: int, capacity: int, price: int) -> int:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            edges[x].append(len(heads))
            heads.append(y)
            room.append(c)
            cost.append(p)
        return len(heads) - 2

    def node() -> int:
        edges.append([])
        return len(edges) - 1

    ends = {s: node() for s in quotas}
    for s, quota in quotas.items():
        link(ends[s], end, quota, 0)
    given = {}
    for pattern, size in sizes.items():
        at = node()
        for r in range(passes):
            link(start, at, size, r)
        for s in members[pattern]:
            given[pattern, s] = link(at, ends[s], passes * size, 0)
    height = [0] * len(edges)
    while True:
        far, via, heap = {start: 0}, {}, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in edges[a]:
                b, there = heads[e], d + cost[e] + height[a] - height[heads[e]]
                if room[e] > 0 and there < far.get(b, there + 1):
                    far[b], via[b] = there, e
                    heapq.heappush(heap, (there, b))
        if end not in far:
            return {k: room[e ^ 1] for k, e in given.items()}
        reach = max(far.values())
        for a in range(len(edges)):
            height[a] += far.get(a, reach)
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = heads[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


class Mix:
    """A decided mix: the sources' sizes, targets and taken words, and the cuts that select documents."""

    def __init__(self, sources: dict[Source, tuple[int, float]], patterns: list[dict]):
        self.sources, self.patterns = sources, patterns

    def copies(self, spark: SparkSession, rows: DataFrame, pattern: str, size: str, draw: str, uses: str) -> DataFrame:
        """``rows`` with ``uses``: for each copy that the mix takes, the source that it counts for."""
        schema = f"`{pattern}` string, cuts array<struct<source: string, pass: int, cut: long>>, closing array<long>"
        data = [(p["pattern"], [{k: c[k] for k in ("source", "pass", "cut")} for c in p["cuts"]], p["closing"]) for p in self.patterns]
        # At most MOST_PATTERNS rows, so it may go to every executor.
        plan = F.broadcast(local_rows(spark, data, StructType.fromDDL(schema)))

        def inside(r: Column, cut: Column) -> Column:
            return (r < cut["pass"]) | ((r == cut["pass"]) & F.coalesce(F.col(draw) <= cut["cut"], F.lit(False)))

        turns = F.sequence(F.lit(0), F.when(F.col(size) > 0, PASSES - 1).otherwise(0))
        parts = F.transform(turns, lambda r: F.filter("cuts", lambda cut: inside(r, cut)))
        named = F.transform(F.filter(parts, lambda hits: F.size(hits) > 0), lambda hits: hits[0]["source"])
        closing = F.when(F.array_contains("closing", F.col(draw)), F.array(F.element_at("cuts", -1)["source"])).otherwise(F.array().cast("array<string>"))
        joined = rows.join(plan, pattern, "left").withColumn(uses, F.coalesce(F.concat(named, closing), F.array().cast("array<string>")))
        return joined.select(*rows.columns, uses)


def _marked(docs: DataFrame, text: str, members: Column, key: str, names: list[str], seed: int) -> DataFrame:
    """``docs`` with size, pattern (its sources as JSON, sorted) and place in the seeded order."""
    size, pattern, draw = names
    sources = F.array_sort(F.array_distinct(members))
    return docs.withColumns(
        {
            size: word_count(text),
            # A document without any source has no pattern and is not taken.
            pattern: F.when(F.size(sources) > 0, F.to_json(sources)),
            draw: F.xxhash64(F.lit(seed), F.col(quoted(key)), F.col(quoted(text))),
        }
    )


def decide(marked: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = PASSES) -> Mix:
    """The mix for rows ``size, pattern, draw``; see ``mix``."""
    rows = marked.where("pattern IS NOT NULL").groupBy("pattern", "draw").agg(F.sum("size").alias("size"))
    rows = materialise(rows, name="draws")
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(sums) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} sets of sources")
    sizes = {r["pattern"]: r["size"] for r in sorted(sums, key=lambda r: r["pattern"])}
    members = {p: by_name(set(json.loads(p))) for p in sizes}
    source_sizes = {s: 0 for p in members for s in members[p]}
    for p, size in sizes.items():
        for s in members[p]:
            source_sizes[s] += size
    wanted = targets(source_sizes, float(sum(sizes.values())), weights, passes) if sizes else {}
    flow = min_cost_flow(sizes, members, {s: round(wanted[s]) for s in by_name(set(wanted))}, passes)

    ends, plans = [], []
    for p, size in sizes.items():
        at, cuts = 0, []
        for s in members[p]:
            at += flow[p, s]
            if flow[p, s]:
                cuts.append({"source": s, "pass": at // size, "left": at % size, "cut": None, "gap": at % size})
                ends.append((p, len(cuts) - 1, at % size))
        plans.append({"pattern": p, "cuts": cuts, "closing": []})
    if ends:
        _find_cuts(rows, ends, plans, max(r["n"] for r in sums))
    return Mix({s: (source_sizes[s], wanted[s]) for s in by_name(set(wanted))}, plans)


def _find_cuts(rows: DataFrame, ends: list[tuple[str, int, int]], plans: list[dict], most_rows: int) -> None:
    """Fill in, for each end of an amount, the last draw whose running sum does not pass it, and the closing documents.

    Running sums in two steps: over buckets of the draw's leading bits, then within the one bucket where an end lies.
    So no task holds a pattern's rows. A pattern's closing documents, taken once more, fill what the last pass misses.
    """
    spark, bits = rows.sparkSession, max(1, (most_rows // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("bucket", F.shiftright("draw", 64 - bits))
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    points = F.broadcast(local_rows(spark, ends, StructType.fromDDL("pattern string, i int, aim long")))
    hit = sums.join(points, "pattern").where("before <= aim AND aim < before + words").select("pattern", "bucket", "before", "i", "aim")
    inner = Window.partitionBy("pattern", "bucket", "i").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.join(hit, ["pattern", "bucket"]).withColumn("upto", F.col("before") + F.sum("size").over(inner))
    fits = F.col("upto") <= F.col("aim")
    found = run.groupBy("pattern", "i").agg(
        F.max(F.when(fits, F.col("draw"))).alias("cut"),
        F.max(F.when(fits, F.col("upto"))).alias("upto"),
        F.min("before").alias("before"),
        F.min("bucket").alias("bucket"),
    )
    plan = {p["pattern"]: p for p in plans}
    for r in found.collect():
        cut = plan[r["pattern"]]["cuts"][r["i"]]
        # If not even the bucket's first row fits, the cut lies at the end of the bucket before it.
        cut["cut"] = r["cut"] if r["cut"] is not None else (r["bucket"] << (64 - bits)) - 1 if r["bucket"] > -(1 << (bits - 1)) else None
        cut["gap"] = cut["left"] - (r["upto"] if r["upto"] is not None else r["before"])
    for fitting in (*[True] * CLOSING_ROUNDS, False):
        _close(rows, plans, fitting)


def _close(rows: DataFrame, plans: list[dict], fitting: bool) -> None:
    """One more closing document for each pattern that still misses words: the largest that fits, or the nearest."""
    gaps = [(p["pattern"], p["cuts"][-1]["gap"], p["cuts"][-1]["cut"], p["closing"]) for p in plans if p["cuts"] and p["cuts"][-1]["gap"] > 0]
    if not gaps:
        return
    open_ends = F.broadcast(local_rows(rows.sparkSession, gaps, StructType.fromDDL("pattern string, gap long, cut long, closing array<long>")))
    rest = rows.join(open_ends, "pattern").where("size > 0 AND (cut IS NULL OR draw > cut) AND NOT array_contains(closing, draw)")
    rest = rest.withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("size <= gap" if fitting else "off < gap")
    best = {r["pattern"]: r["best"] for r in rest.groupBy("pattern").agg(F.min(F.struct("off", "draw", "size")).alias("best")).collect()}
    for p in plans:
        if p["pattern"] in best:
            p["closing"].append(best[p["pattern"]]["draw"])
            p["cuts"][-1]["gap"] -= best[p["pattern"]]["size"]


def with_uses(
    docs: DataFrame, members: Column, text: str = "text", key: str = "doc_id", uses: str = "uses",
    weights: Sequence[float] = WEIGHTS, seed: int = SEED,
) -> tuple[DataFrame, Mix]:
    """``docs`` with ``uses`` (the sources that each copy taken counts for; empty: not taken) and the mix.

    ``members`` is the array of a document's sources; a null in it is a source of its own, the last by name; an empty or
    null array means no source, and the document is not taken. Targets share the words of all documents by weight, up to
    ``PASSES`` times a source's size. A copy is a whole document. The amounts miss their targets by less than the size of one
    document, and closing documents make that small. Null or empty texts have no words; they are taken once if their place in the order is.
    Rows that repeat key and text share their place. The order depends on seed, key and text alone, so reruns agree
    for any partitioning. An empty table gives an empty mix.
    """
    names = fresh(docs, "size", "pattern", "draw")
    marked = _marked(docs, text, members, key, names, seed)
    mix = decide(marked.select(*(F.col(n).alias(c) for n, c in zip(names, ("size", "pattern", "draw"), strict=True))), weights)
    size, pattern, draw = names
    return mix.copies(docs.sparkSession, marked, pattern, size, draw, uses).drop(*names), mix


def mixed(docs: DataFrame, members: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.

    Null and empty texts have no words, long ones count whole; repeated rows share a draw and are taken alike; other columns
    stay, ``uses`` among them. An empty table gives an empty one.
    """
    (uses,) = fresh(docs, "uses")
    out, _ = with_uses(docs, members, text, key, uses)
    return out.withColumn(uses, F.explode(uses)).drop(uses)


def report(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for documents of one source each; ``target`` is the source's."""
    spark = docs.sparkSession
    slim = docs.select(F.col(quoted(key)).alias("doc_id"), F.col(quoted(source)).alias("source"), F.col(quoted(text)).alias("text"))
    out, mix = with_uses(slim, F.array("source"))
    rows = [(s, size, target) for s, (size, target) in mix.sources.items()]
    table = F.broadcast(local_rows(spark, rows, StructType.fromDDL("name string, source_size long, target double")))
    out = out.withColumn("size", word_count("text")).withColumn("taken", F.col("size") * F.size("uses"))
    return out.join(table, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "size", "source_size", "target", "taken")
