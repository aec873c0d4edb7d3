"""Deterministic deduplication by natural key.

``dropDuplicates`` keeps an arbitrary survivor.  Here the survivor is the row
that is greatest under a total order (the given ``order`` columns first, then
every remaining column), so reruns and recomputations after a lost executor
pick the same row.

It is ``row_number() = 1`` in one scan: Spark limits each key per map task
before the shuffle (``WindowGroupLimit``), so a key holding a third of all rows
reaches the reducer as one row per map task.

A NULL in a key column means two things.  In an id it is a missing id:
such rows are not duplicates of each other and all pass through (the default).
In the key of an aggregate it is a group of its own: ``null_is_value`` keeps
one row of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import any_null


def dedupe_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = (),
                  null_is_value: bool = False) -> DataFrame:
    key, cols = list(key), df.columns
    rest = [c for c in cols if c not in key and c not in order]
    ranked = [F.col(c).desc_nulls_last() for c in [*order, *rest]] or [F.lit(1)]
    by = key
    if not null_is_value:
        # a row without an id is alone in its window
        alone = F.when(any_null(key), F.monotonically_increasing_id())
        df, by = df.withColumn("_alone", alone), [*key, "_alone"]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*ranked))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).select(*cols)
