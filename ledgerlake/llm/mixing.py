"""Mixing sources to target weights by min-cost flow.

Documents may belong to several overlapping sources.  They are aggregated by
membership pattern (the sorted set of their sources); a flow network then
routes the words of the patterns to the quotas of the sources:

    start -> pattern   one arc per repetition r, capacity = the pattern's
                       words, cost rising with r (convex: a second copy of
                       one pattern costs more than a first copy of another)
    pattern -> source  for each source of the pattern
    source -> end      capacity = the source's target

The network has a node per pattern and source, not per document, and is
solved by successive shortest paths.  The flow of a pattern is realised by
whole copies of all its documents plus, for the rest, the documents that come
first in a seeded order until the rest is filled.

The seeded order is cut into hash ranges, about ``RANGE_ROWS`` documents each
(the count follows the largest pattern): a running sum over range totals finds
the range where the rest ends, and only that range is summed document by
document.  So a source with a third of all rows is never in one task.

Defined results: a NULL source is a source of its own (last in order); NULL
text has size 0 and is taken 0 times; equal rows get equal shares of a tie by
id; an empty table gives an empty mix; documents whose sizes are all 0 get
target 0; texts of any length are sized whole; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import bounded_batches, words, written

#: Documents per hash range of the seeded order.
RANGE_ROWS = 1024

#: Cost of the first, second, ... copy of a document.
COPY_COSTS = (0, 1, 4, 9, 16, 25, 36, 49)


def targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share ``total`` by weight; no source above ``most`` times its size, the
    excess reshared by weight among the others until none is above."""
    out, open_ = {k: 0.0 for k in sizes}, set(sizes)
    left = float(total)
    while open_:
        w = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / w > most * sizes[k]]
        if not over:
            out.update({k: left * weights[k] / w for k in open_})
            break
        for k in sorted(over, key=repr):
            out[k] = float(most * sizes[k])
        left -= sum(out[k] for k in over)
        open_ -= set(over)
    return out


def min_cost_flow(patterns: dict, quotas: dict, copies: int) -> dict:
    """Flow (integer words) of each pattern, {pattern: {source: words}}.

    ``patterns`` maps a tuple of sources to its words, ``quotas`` a source to
    its target.  Successive shortest paths with potentials (Dijkstra); each
    augmentation saturates an arc.
    """
    nodes = ["start", *(("p", p) for p in sorted(patterns, key=repr)),
             *(("s", s) for s in sorted(quotas, key=repr)), "end"]
    at = {n: i for i, n in enumerate(nodes)}
    arcs: list[list] = []          # [to, capacity, cost]
    out: list[list[int]] = [[] for _ in nodes]

    def arc(a, b, capacity, cost):
        out[at[a]].append(len(arcs))
        arcs.append([at[b], capacity, cost])
        out[at[b]].append(len(arcs))
        arcs.append([at[a], 0, -cost])

    for p, n in patterns.items():
        for r in range(copies):
            arc("start", ("p", p), n, COPY_COSTS[r] if r < len(COPY_COSTS) else r * r)
        for s in p:
            if s in quotas:
                arc(("p", p), ("s", s), n * copies, 0)
    for s, q in quotas.items():
        arc(("s", s), "end", q, 0)
    potential, end = [0] * len(nodes), at["end"]
    while True:
        dist, via = [math.inf] * len(nodes), [-1] * len(nodes)
        dist[0], heap = 0, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in out[u]:
                v, capacity, cost = arcs[e]
                nd = d + cost + potential[u] - potential[v]
                if capacity > 0 and nd < dist[v]:
                    dist[v], via[v] = nd, e
                    heapq.heappush(heap, (nd, v))
        if dist[end] == math.inf:
            break
        potential = [p + d if d < math.inf else p for p, d in zip(potential, dist)]
        path, v = [], end
        while v:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        amount = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= amount
            arcs[e ^ 1][1] += amount
    flow = {p: {} for p in patterns}
    for p in patterns:
        for e in out[at["p", p]]:
            v = nodes[arcs[e][0]]
            if not e & 1 and v[0] == "s" and arcs[e ^ 1][1]:
                flow[p][v[1]] = arcs[e ^ 1][1]
    return flow


def select(docs: DataFrame, shares: DataFrame, seed: int) -> DataFrame:
    """``docs`` (id, size, pattern) with ``copies``: whole repetitions taken.

    ``shares`` has (pattern, whole, rest): whole copies of every document and
    the words still to fill.  A document is in the rest while the sum before
    it in the seeded order, plus half its size, stays within the rest.
    """
    key = F.xxhash64(F.lit(seed), F.col("id"))
    most = docs.groupBy("pattern").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, most / RANGE_ROWS))))
    width = 64 - bits
    part = (F.shiftrightunsigned(key, width) if bits else F.lit(0)).cast("long")
    d = docs.withColumns({"k": key, "part": part})
    totals = d.groupBy("pattern", "part").agg(F.sum("size").alias("words"))
    before = (totals.withColumn("upto", F.sum("words").over(
        Window.partitionBy("pattern").orderBy("part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(shares.withColumnRenamed("pattern", "of"), F.expr("pattern <=> of"))
        .selectExpr("pattern AS of", "part AS of_part", "upto - words AS below", "upto",
                    "whole", "rest"))
    d = d.join(before, F.expr("pattern <=> of AND part = of_part"))
    inside = (F.col("below") < F.col("rest")) & (F.col("upto") > F.col("rest"))
    cut = d.where(inside)
    run = F.sum("size").over(Window.partitionBy("pattern", "part").orderBy("k", "id")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = cut.withColumn("first", F.col("below") + run - F.col("size") / 2 <= F.col("rest"))
    full = d.where(~inside).withColumn("first", F.col("upto") <= F.col("rest"))
    return full.unionByName(cut).select(
        "id", "size", "pattern", (F.col("whole") + F.col("first").cast("int")).alias("copies"))


def mix(docs: DataFrame, weights, share: float = 1.5, most: int = 2, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", sources: Column | None = None) -> DataFrame:
    """One row per document: id, size, pattern (array of sources), target
    (sum of its sources' targets), copies, taken.

    ``sources`` is an array column (default: the one ``source`` column);
    ``weights`` maps the ordered list of sources to a list of weights.
    """
    bounded_batches(docs.sparkSession)
    member = sources if sources is not None else F.array(F.col("source"))
    d = docs.select(F.col(id_col).alias("id"),
                    F.size(words(F.col(text_col))).cast("long").alias("size"),
                    F.array_sort(F.array_distinct(member)).alias("pattern"))
    d = written(d, "mixing")
    # a pattern is a combination of the configured sources: one row each
    rows = d.groupBy("pattern").agg(F.sum("size").alias("words")).collect()
    spark = docs.sparkSession
    pattern_words = {tuple(r.pattern or ()): r.words for r in rows}
    sizes: dict = {}
    for p, n in pattern_words.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    quota = targets(sizes, dict(zip(order, weights(order))), share * sum(pattern_words.values()), most)
    flow = min_cost_flow(pattern_words, {s: int(round(t)) for s, t in quota.items()}, most)
    schema = ("pattern array<string>, whole int, rest long, source_size long, target double")
    plan = []
    for p, n in pattern_words.items():
        f = sum(flow[p].values())
        whole = f // n if n else 0
        plan.append((list(p), whole, f - whole * n, sum(sizes[s] for s in p),
                     float(sum(quota[s] for s in p))))
    shares = spark.createDataFrame(plan, schema)
    picked = select(d, shares.select("pattern", "whole", "rest"), seed)
    info = shares.selectExpr("pattern AS of", "source_size", "target")
    return (picked.join(info, F.expr("pattern <=> of"))
            .select("id", "size", "pattern", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))
