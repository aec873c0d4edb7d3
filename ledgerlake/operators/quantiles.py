"""Cost quantiles and the spike flag.

``exact_quantile`` returns ``percentile_disc(q)``: the smallest value v with
``count(x <= v) >= ceil(q * n)`` over the finite values.  Spark's built-in
``percentile_disc`` keeps every distinct value of the group in one buffer and
merges them in a single task, which does not hold at scale.  Here the answer
is found by histogram narrowing instead: each pass is one distributed
aggregate that bins the rows of the current value range into ``bins``
equal-width buckets (partial aggregation on the map side, at most ``bins``+1
rows reach the driver), picks the bucket that holds the target rank and
narrows the range to that bucket's actual min and max.  A pass strictly
shrinks the range, and two-decimal money resolves in three or four passes.
Only the bucket histogram (bounded by ``bins``) ever leaves the executors.
Infinities and NaN have no place in a width, so they are left out (the quality
rules quarantine the rows that carry them); over finite doubles the search
always ends, because every pass leaves at most 1 / ``bins`` of a width.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_flag


def exact_quantile(df: DataFrame, col: str, q: float, *, bins: int = 1024) -> float | None:
    return exact_quantiles(df, col, [q], bins=bins)[0]


def _bucket(x: Column, lo: float, hi: float, bins: int) -> Column:
    # width_bucket computes bins × (x − lo) before dividing by the width:
    # values are scaled by a power of two just small enough to keep that
    # product finite (scaling is exact and monotone; small ranges keep scale
    # 1 and full precision).  The bucket of a value is monotone in the value,
    # so buckets are contiguous runs of the sorted values.
    scale = 1.0
    while not math.isfinite((hi * scale - lo * scale) * bins):
        scale /= 2.0
    return F.width_bucket(x * scale, F.lit(lo * scale), F.lit(hi * scale), F.lit(bins))


def exact_quantiles(df: DataFrame, col: str, qs, *, bins: int = 1024) -> list[float | None]:
    """``percentile_disc`` of each q in ``qs`` over the finite values, found together.

    Every pass is ONE aggregate over the input: each open search range gets
    its own histogram (a row belongs to every range that contains it, so an
    explode of at most ``len(qs)`` copies, and only while ranges overlap), and
    the passes needed are those of the slowest quantile, not their sum.
    The next range of a quantile is its chosen bucket's own [min, max], at
    most 1/bins of the current width, so each search reaches a single value.
    """
    for q in qs:
        if not 0.0 <= q <= 1.0:
            raise ValueError("q must be in [0, 1]")
    x = df.select(F.col(col).cast("double").alias("x"))
    x = x.filter(F.abs("x") < F.lit(float("inf")))        # finite: neither NULL, NaN nor infinite
    n, lo, hi = x.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return [None] * len(qs)
    # per quantile: [1-based target rank, lo, hi, rows strictly below lo]; the first
    # and the last rank are known: the least and the greatest value
    ranks = [max(1, math.ceil(q * n)) for q in qs]
    state = {i: [r, lo if r < n else hi, hi if r > 1 else lo, 0] for i, r in enumerate(ranks)}
    out: dict[int, float] = {}
    while True:
        for i in [i for i, st in state.items() if st[1] == st[2]]:
            out[i] = state.pop(i)[1]
        if not state:
            return [out[i] for i in range(len(qs))]
        ranges = sorted({(st[1], st[2]) for st in state.values()})
        xc = F.col("x")
        member = F.array(*[F.when(xc.between(a, b), F.lit(r)) for r, (a, b) in enumerate(ranges)])
        rows = x.select("x", F.explode(F.filter(member, lambda e: e.isNotNull())).alias("r"))
        bucket = None
        for r, (a, b) in enumerate(ranges):
            cond, val = F.col("r") == r, _bucket(xc, a, b, bins)
            bucket = F.when(cond, val) if bucket is None else bucket.when(cond, val)
        hist = (rows.groupBy("r", bucket.alias("b"))
                .agg(F.count("*").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
                .orderBy("r", "b")
                .collect())
        by_range: dict[int, list] = {}
        for row in hist:
            by_range.setdefault(row["r"], []).append(row)
        for st in state.values():
            cum = st[3]
            for row in by_range.get(ranges.index((st[1], st[2])), []):
                if cum + row["c"] >= st[0]:
                    st[1], st[2], st[3] = row["lo"], row["hi"], cum
                    break
                cum += row["c"]


def spike_threshold(df: DataFrame, cost_col: str = "cost_usd_increment", q: float = 0.99,
                    multiplier: float = 3.0) -> float | None:
    """q-quantile of cost × multiplier (NULL when the column has no value)."""
    p = exact_quantile(df, cost_col, q)
    return None if p is None else p * multiplier


def spike_flag(threshold: float | None, cost_col: str = "cost_usd_increment") -> Column:
    """cost > threshold as a two-valued flag; no threshold → false for every row."""
    if threshold is None:
        return F.lit(False)
    return as_flag(F.col(cost_col) > F.lit(threshold))


def quantile_name(q: float) -> str:
    """'p99' for 0.99, 'p99.5' for 0.995: distinct for distinct q."""
    return f"p{round(q * 100, 10):.12g}"


def method_label(q: float, multiplier: float) -> str:
    """'p99_x3' for q = 0.99, ×3."""
    return f"{quantile_name(q)}_x{multiplier:.12g}"
