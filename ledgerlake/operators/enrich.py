"""Enrichment joins.

A dimension is broadcast by hint only if its size is known: a written layer's
bytes come from its file listing (``sources.files.bytes_of``), which costs no
job.  Without a known size there is no hint: the planner broadcasts a scan
whose statistics are small, AQE one whose shuffled side turns out small, and
otherwise both sides are sorted and merged, with AQE splitting a skewed
fact-side partition (a hot org) across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parquet bytes of a dimension that may be broadcast; in memory it may take
# several times as much, which executors of a few GB hold.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def sized_broadcast(dim: DataFrame, dim_bytes: int | None,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    return F.broadcast(dim) if dim_bytes is not None and dim_bytes <= max_bytes else dim


def check_unique(dim: DataFrame, key: Sequence[str], name: str = "dimension") -> DataFrame:
    """``dim`` itself, if no non-NULL key occurs twice; raises otherwise.

    A left join to a dimension with repeated keys multiplies facts, so the
    layers check theirs when they write them.
    """
    key = list(key)
    twice = dim.dropna(subset=key).groupBy(*key).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"{name} has repeated keys, for example {twice.first().asDict()}")
    return dim


def left_enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], columns: Sequence[str],
                *, dim_bytes: int | None = None) -> DataFrame:
    """fact ⟕ dim[on + columns]; dim must be unique on ``on`` (see ``check_unique``)."""
    d = dim.select(*on, *columns)
    return fact.join(sized_broadcast(d, dim_bytes), list(on), "left")


def left_flag(fact: DataFrame, dim: DataFrame, on: Sequence[str], flag: str,
              *, dim_bytes: int | None = None) -> DataFrame:
    """fact ⟕ dim on a (composite) key, keeping only a match flag: whether the
    registry knows the fact's resource."""
    d = dim.select(*on).withColumn(flag, F.lit(True))
    return (fact.join(sized_broadcast(d, dim_bytes), list(on), "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
