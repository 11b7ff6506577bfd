"""Mixing sources to target weights by min-cost flow (operator 11).

A document may belong to several sources.  A mix takes words of documents so
that each source gets its quota of them; a word taken for one source is not
taken for another, and no document is taken more than ``REPEATS`` times.

*Patterns.*  Documents with the same set of sources are alike to the flow, so
Spark adds up the sizes by membership pattern and only the patterns go on.

*Flow.*  Words flow from patterns to their sources, at most a quota into each.
The r-th time that a pattern's words are taken costs r, so costs are convex:
everything is taken once before anything is taken twice.  Only the arcs into
patterns cost something, so cheapest paths come in the order of r: with the
arcs of the first r rounds open, augmenting paths (shortest first) are sought
until there are none, then the next round's arcs are opened.  A path never
gives back what a pattern has taken, so the earlier rounds stay full: the flow
is the greatest one, and of those the one with the fewest repeats.

*Targets.*  Sources weigh ``WEIGHTS`` in turn, by name, and share ``SHARE`` of
all words; none gets more than ``REPEATS`` times its size, the excess is shared
by weight among the others until none is above.  That is one level for all: the
largest (words - caps before) / (weights from there on) over the sources in the
order of cap / weight.

*Documents.*  What a pattern gives is so many whole copies of all its
documents, and one more copy of the first ones in a seeded order (digest of
seed and key).  The last of these gives only the words that are still missing,
so quotas are met to the word; with ``whole`` it gives a whole copy where that
comes nearer and none otherwise.  Running sums in that order come from ranges
of equal row count: Spark's range partitioner cuts (pattern, digest), each
range is summed, and the sums of the ranges before a range are its start.  So a
pattern that holds a third of all rows is spread over a third of all ranges.

Texts are read once, for their sizes; the rest works on (key, size, pattern,
digest).  The driver holds one row for each pattern that occurs.

Defined cases: a null text has size 0; a null source is a source of its own,
the last one; a document without any source (null or empty set) gives nothing;
a source named twice counts once; rows that share a key stand next to each
other in the seeded order, by size; equal rows are interchangeable; size 0
takes 0; an empty table gives an empty table; other columns are left out; long
texts are measured whole.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import read, written

#: Weights of the sources in turn, words of the mix per word of the sources, and
#: how often a document may be taken.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
#: Part of the digest that orders documents.
SEED = "11"
WORD = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, members: Column, key: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """(key, size, pattern, mark) of every row; ``members``: the array of a
    row's sources.  ``pattern`` is their set as JSON text."""
    return docs.select(
        F.col(key).alias("key"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.coalesce(F.to_json(F.array_sort(F.array_distinct(members))), F.lit("[]")).alias("pattern"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")).alias("mark"),
    )


def targets(
    sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> dict[str | None, float]:
    """The words that each source should give; ``sizes``: words by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    by_cap = sorted(names, key=lambda s: float(repeats) * sizes[s] / weight[s])
    left, rest, level = share * sum(sizes.values()), sum(weight.values()), 0.0
    before = 0
    for s in by_cap:
        level = max(level, (left - before) / rest)
        before += repeats * sizes[s]
        rest -= weight[s]
    return {s: min(float(repeats) * sizes[s], weight[s] * level) for s in names}


def route(
    patterns: list[tuple[tuple, int]], quotas: dict[str | None, int], repeats: int = REPEATS
) -> list[dict[str | None, int]]:
    """The words that each pattern (its sources, its size) gives to each of its
    sources: the greatest flow within the quotas, with the fewest repeats."""
    flow: list[dict] = [{} for _ in patterns]
    givers: dict = {s: set() for s in quotas}
    open_quota = dict(quotas)
    for _ in range(repeats):
        supply = [size for _, size in patterns]
        while (path := _augmenting(patterns, supply, open_quota, givers)) is not None:
            # pattern, source, pattern, ..., source: forward and back in turn
            amount = min(supply[path[0]], open_quota[path[-1]], *(flow[p][s] for s, p in zip(path[1:-1:2], path[2::2], strict=True)))
            for p, s in zip(path[::2], path[1::2], strict=True):
                flow[p][s] = flow[p].get(s, 0) + amount
                givers[s].add(p)
            for s, p in zip(path[1:-1:2], path[2::2], strict=True):
                flow[p][s] -= amount
                if not flow[p][s]:
                    givers[s].remove(p)
            supply[path[0]] -= amount
            open_quota[path[-1]] -= amount
    return flow


def _augmenting(patterns, supply, open_quota, givers) -> list | None:
    """A shortest path from a pattern with words left to a source with quota
    left; from a source it goes on to patterns that give to it."""
    came: dict = {("p", i): None for i, left in enumerate(supply) if left}
    queue = deque(came)
    while queue:
        node = queue.popleft()
        kind, at = node
        if kind == "p":
            near = [("s", s) for s in patterns[at][0] if s in open_quota]
        elif open_quota[at]:
            path = []
            while node is not None:
                path.append(node[1])
                node = came[node]
            return path[::-1]
        else:
            near = [("p", p) for p in sorted(givers[at])]
        for other in near:
            if other not in came:
                came[other] = node
                queue.append(other)
    return None


def select(lots: DataFrame, plan: DataFrame, whole: bool = False) -> DataFrame:
    """(key, size, pattern, copies, taken) and the further columns of ``plan``:
    (pattern, base copies, rest words of one more copy, ...)."""
    order = ["pattern", "mark", "key", "size"]
    ranged = written(lots.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("pattern", "range").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("pattern").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("pattern", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    # what holds for a pattern reaches its rows by (pattern, range) too, so the
    # rows of a large pattern never meet at its name
    starts = written(starts.join(plan, "pattern"), "starts")
    within = W.partitionBy("pattern", "range").orderBy(*order[1:]).rowsBetween(W.unboundedPreceding, 0)
    rows = ranged.join(starts, ["pattern", "range"]).withColumn(
        "before", F.col("start") + F.sum("size").over(within) - F.col("size")
    )
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before")))
    if whole:
        more = F.when(2 * more >= F.col("size"), F.col("size")).otherwise(0)
    return rows.select(
        "key",
        "size",
        "pattern",
        (F.col("base") + ((more > 0) & (more == F.col("size"))).cast("long")).alias("copies"),
        (F.col("base") * F.col("size") + more).alias("taken"),
        *plan.drop("pattern", "base", "rest").columns,
    )


def pattern_sizes(lots: DataFrame) -> dict[str, int]:
    """Words by pattern: partial sums, one row a pattern reaches the driver."""
    return {r[0]: r[1] for r in lots.groupBy("pattern").agg(F.sum("size")).orderBy("pattern").collect()}


def source_sizes(sizes: dict[str, int]) -> dict[str | None, int]:
    """Words by source, from words by pattern."""
    out: dict = {}
    for pattern, n in sizes.items():
        for s in json.loads(pattern):
            out[s] = out.get(s, 0) + n
    return out


def planned(
    sizes: dict[str, int], quotas: dict[str | None, float] | None = None, repeats: int = REPEATS
) -> tuple[dict[str | None, float], dict[str, dict[str | None, int]]]:
    """The quotas (``targets`` of the sources where none are given) and the
    words that each pattern gives to each of its sources."""
    quotas = targets(source_sizes(sizes), repeats=repeats) if quotas is None else quotas
    flows = route([(tuple(json.loads(p)), n) for p, n in sizes.items()], {s: int(q + 0.5) for s, q in quotas.items()}, repeats)
    return quotas, dict(zip(sizes, flows, strict=True))


def _copies(routes: dict[str, dict], sizes: dict[str, int]) -> list[tuple[str, int, int]]:
    return [(p, *(divmod(sum(f.values()), sizes[p]) if sizes[p] else (0, 0))) for p, f in routes.items()]


def mix(
    docs: DataFrame,
    members: Column,
    quotas: dict[str | None, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    repeats: int = REPEATS,
    seed: str = SEED,
    whole: bool = False,
) -> tuple[DataFrame, dict[str, dict[str | None, int]]]:
    """The mix of ``docs``: (key, size, pattern, copies, taken) of every row,
    and the words that each pattern gives to each source."""
    lots = written(measured(docs, members, key, text, seed), "sizes")
    sizes = pattern_sizes(lots)
    _, routes = planned(sizes, quotas, repeats)
    plan = docs.sparkSession.createDataFrame(_copies(routes, sizes), "pattern string, base long, rest long")
    return select(lots, plan, whole).withColumnRenamed("key", key), routes


def q_op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the targets of their sources."""
    lots = written(measured(read(spark, sf_dir, "documents"), F.array("source")), "sizes")
    sizes = pattern_sizes(lots)
    wanted, routes = planned(sizes)
    # each pattern is one source here
    told = [(*row, sizes[row[0]], wanted[s]) for row in _copies(routes, sizes) for s in json.loads(row[0])]
    plan = spark.createDataFrame(told, "pattern string, base long, rest long, source_size long, target double")
    return select(lots, plan).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = rf"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS mark FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
    [{", ".join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS w
    FROM docs GROUP BY source),
steps AS (SELECT {SHARE} * (sum(source_size) OVER ())::DOUBLE AS total, sum(w) OVER later AS rest,
    coalesce(sum({REPEATS} * source_size) OVER earlier, 0)::DOUBLE AS before FROM sources
    WINDOW earlier AS (ORDER BY {REPEATS}::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      later AS (ORDER BY {REPEATS}::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT max((total - before) / rest::DOUBLE) AS level FROM steps),
wanted AS (SELECT source, source_size, least({REPEATS}::DOUBLE * source_size, w * level) AS target FROM sources, level),
quotas AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM wanted),
plan AS (SELECT *, coalesce(quota // nullif(source_size, 0), 0) AS base FROM quotas),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mark, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM docs)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (p.base * d.size + greatest(0, least(d.size, p.quota - p.base * p.source_size - d.before)))::BIGINT AS taken
FROM placed d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
"""

QUERIES = {"op11_source_mix": q_op11_source_mix}
ORACLE_SQL = {"op11_source_mix": SQL}
