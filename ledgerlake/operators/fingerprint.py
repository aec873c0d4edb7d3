"""Table fingerprints: a hash of the multiset of rows per partition.

Equal tables have equal fingerprints, whatever the order of rows, files and
partitions; unlike ones differ but for a chance of about 2^-120.  One pass and a
map-side sum per table; rows are compared only in partitions that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, to_money


def _hash(cols: list[str], seed: int) -> Column:
    """64 bits of a row; whether a column is NULL counts, as does its place."""
    parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def fingerprint(df: DataFrame, by: str | None = None, amount: str | None = None) -> DataFrame:
    """(part, rows, h1, h2, amount) per value of ``by``; sums, so copies count.
    ``amount`` is the exact sum of that column (NULL without one)."""
    cols = sorted(df.columns)
    part = F.col(by).cast("string") if by else F.lit(None).cast("string")
    total = F.sum(to_money(amount)) if amount else F.lit(None).cast(MONEY)
    return (df.groupBy(part.alias("part"))
            .agg(F.count("*").alias("rows"), F.sum(_hash(cols, 1)).alias("h1"), F.sum(_hash(cols, 2)).alias("h2"),
                 total.alias("amount")))


def compared(a: DataFrame, b: DataFrame, by: str | None = None, amount: str | None = None) -> dict:
    """One pass over each table: ``parts``, the values of ``by`` (as text) whose
    rows differ, as many as partitions at most, and of both sides the rows
    (``rows``, ``n``) and exact totals of ``amount`` (``total``, ``total_b``)."""
    x, y = fingerprint(a, by, amount), fingerprint(b, by, amount).toDF("p", "n", "g1", "g2", "amount_b")
    same = F.col("rows").eqNullSafe(F.col("n")) & F.col("h1").eqNullSafe(F.col("g1")) & F.col("h2").eqNullSafe(F.col("g2"))
    both = x.join(y, F.col("part").eqNullSafe(F.col("p")), "full_outer")
    one = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "n")],
                   F.sum("amount").alias("total"), F.sum("amount_b").alias("total_b"),
                   F.collect_list(F.when(~same, F.struct(F.coalesce("part", "p").alias("part")))).alias("parts")).first()
    return {**one.asDict(), "parts": [r.part for r in one.parts]}


def differing_parts(a: DataFrame, b: DataFrame, by: str | None = None) -> list:
    """Values of ``by`` (as text) whose rows differ: as many as partitions at most."""
    return compared(a, b, by)["parts"]


def differing_rows(a: DataFrame, b: DataFrame, by: str | None = None, parts: list | None = None) -> DataFrame:
    """Distinct rows that one side has more often than the other, with
    ``surplus`` (positive: of ``a``), from differing partitions only (``parts``,
    if they are known)."""
    parts = differing_parts(a, b, by) if parts is None else parts
    if by is None or not parts:
        keep = F.lit(bool(parts))
    else:
        keep = F.col(by).cast("string").isin([p for p in parts if p is not None])
        keep = keep | F.col(by).isNull() if None in parts else keep
    both = (a.where(keep).withColumn("surplus", F.lit(1))
            .unionByName(b.where(keep).withColumn("surplus", F.lit(-1))))
    return both.groupBy(*a.columns).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")
