"""Column-level helpers: conversions, exact sums and ratios, flags.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money and measures are summed as DECIMAL and cast to DOUBLE at the very end.
# A double sum depends on the order in which partitions are combined, so a
# rounded total can land on either side of a boundary from one run to the
# next; a decimal sum is exact and order independent.  Twelve decimals hold
# amounts far below a cent; 26 integer digits hold 1e11 rows of the largest
# number a row may carry.
MONEY = DecimalType(38, 12)
# Numbers of this size or more, infinities and NaN are not measures: rows
# that carry one are quarantined (``operators.quality``).
NUMBER_BOUND = 1e15
# the ends of BIGINT, where whole totals stop
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: str | Column) -> Column:
    """DOUBLE → exact DECIMAL used for summing."""
    return col_(c).cast(MONEY)


def money_sum(c: str | Column, scale: int) -> Column:
    """``round(sum(c), scale)`` computed exactly, returned as DOUBLE.

    The decimal is rounded *before* it is cast to double, so the result is
    the correctly rounded value rather than a rounded approximation.
    """
    return F.round(F.sum(to_money(c)), scale).cast("double")


def money_mean(c: str | Column, scale: int) -> Column:
    """Mean of the non-NULL values as exact sum / count, rounded."""
    return F.round(F.sum(to_money(c)) / F.count(col_(c)), scale).cast("double")


def share(predicate: Column, scale: int) -> Column:
    """Rows for which the predicate is true over all rows (two exact counts)."""
    return F.round(F.count_if(predicate) / F.count("*"), scale)


def whole_of(total: Column) -> Column:
    """DECIMAL total as BIGINT, fraction truncated toward zero.

    ``NUMBER_BOUND`` lets a few thousand rows pass what BIGINT holds; such a
    total stays at BIGINT's end, where it can be told, and ends no job.
    """
    low, high = (F.lit(n).cast(MONEY) for n in (LONG_MIN, LONG_MAX))
    return (F.when(total >= high, F.lit(LONG_MAX)).when(total <= low, F.lit(LONG_MIN))
            .otherwise(total.cast("long")))


def whole_sum(c: str | Column) -> Column:
    """Exact sum as BIGINT (see ``whole_of``)."""
    return whole_of(F.sum(to_money(c)))


def out_of_range(c: str | Column) -> Column:
    """True for NaN, infinities and numbers of ``NUMBER_BOUND`` or more."""
    c = col_(c).cast("double")
    return F.isnan(c) | (F.abs(c) >= F.lit(NUMBER_BOUND))


def try_double(c: str | Column) -> Column:
    """Text → DOUBLE; unparsable text becomes NULL instead of failing the job.

    Spark 4 runs with ANSI mode on, where a plain ``cast`` of ``'n/a'`` aborts.
    """
    return col_(c).try_cast("double")


def as_flag(predicate: Column) -> Column:
    """Collapse SQL three-valued logic to two: NULL → false."""
    return F.coalesce(predicate, F.lit(False))


def any_null(cols: Iterable[str | Column]) -> Column:
    cols = [col_(c).isNull() for c in cols]
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out
