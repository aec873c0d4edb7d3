"""Joins on keys of which a few hold much of the rows.

Heavy keys are found with bounded memory in two aggregates: counts of ``WIDTH``
hash buckets, then exact counts of the keys in the buckets that are heavy enough
to hold one.  The large side's rows of a heavy key are dealt over salts, and the
small side's rows of that key repeated once per salt; all other keys have one
salt.  A task then holds about as much of a heavy key as of many light ones,
whether AQE would have split it or not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets counted first.
WIDTH = 1 << 14


def heavy_keys(df: DataFrame, key: str, share: float) -> dict:
    """Keys that hold more than ``share`` of the rows, with their counts: fewer
    than 1 / share.  NULL joins nothing, so it is never one."""
    rows = df.where(F.col(key).isNotNull()).select(key)
    bucket = F.pmod(F.xxhash64(key), F.lit(WIDTH))
    counts = rows.groupBy(bucket.alias("b")).count()
    total = df.count()
    heavy = [r.b for r in counts.where(F.col("count") > share * total).collect()]
    if not heavy:
        return {}
    found = (rows.where(bucket.isin(heavy)).groupBy(key).count()
             .where(F.col("count") > share * total).collect())
    return {r[0]: r["count"] for r in found}


def _salts(heavy: dict, key: str, total: int, tasks: int) -> Column:
    """How many salts a key has: its part of ``tasks``, rounded up."""
    out = F.lit(1)
    for k, n in heavy.items():
        out = F.when(F.col(key) == F.lit(k), F.lit(max(2, math.ceil(n * tasks / total)))).otherwise(out)
    return out


def skew_join(large: DataFrame, small: DataFrame, key: str, how: str = "inner", *, share: float = 0.02,
              tasks: int | None = None) -> DataFrame:
    """``large`` join ``small`` on ``key`` ("inner" or "left"), heavy keys salted.

    ``tasks``: partitions that the rows should spread over (default: the
    session's shuffle partitions)."""
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps the large side's rows: inner or left")
    spark = large.sparkSession
    heavy = heavy_keys(large, key, share)
    if not heavy:
        return large.join(small, key, how)
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = _salts(heavy, key, large.count(), tasks)
    # copies of a row differ in their place, so they spread over salts too
    place = F.xxhash64(F.monotonically_increasing_id(), *large.columns)
    a = large.withColumn("_salt", F.pmod(place, n).cast("int"))
    b = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return a.join(b, [key, "_salt"], how).drop("_salt")
