"""Key merge (upsert) on plain Parquet frames.

``upsert(existing, updates, key)`` = updates ∪ (existing ▷ updates): every key
in ``updates`` takes the new row, every other key keeps its row.  Keys are
compared null-safely: the key of a mart comes from a ``groupBy``, where NULL
is one group, so a replayed row with a NULL key part replaces itself instead of
doubling.  The anti join shuffles only key columns of ``updates``; when the
update batch is small AQE turns it into a broadcast.  If ``updates`` may hold
several rows per key, ``order`` picks the last write (greatest under the
order).

``KeyedTable`` is for a table that is merged into again and again: it lies
bucketed by its key, encoded as one string that is never NULL, so a plain
equality compares keys null-safely and the join needs no exchange and no sort
order of the table's side.  Only the updates are shuffled, into its buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .dedupe import dedupe_by_key


def upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str],
           order: Sequence[str] | None = None) -> DataFrame:
    key = list(key)
    if order is not None:
        updates = dedupe_by_key(updates, key, order, null_is_value=True)
    new = updates.select(*[F.col(k).alias(f"_new_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key])
    return updates.select(*existing.columns).unionByName(existing.join(new, same, "left_anti"))


KEY = "_key"


def encoded_key(cols: Sequence[str]) -> Column:
    """One string per key, never NULL: each part with its length before it."""
    part = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")),
                       F.lit("-")) for c in cols]
    return F.concat(*part)


@dataclass(frozen=True)
class KeyedTable:
    """Rows bucketed by their encoded key; a merge writes a table of its own."""

    spark: SparkSession
    path: str
    schema: StructType
    key: tuple[str, ...]
    buckets: int

    @classmethod
    def create(cls, df: DataFrame, path: str, key: Sequence[str], buckets: int) -> KeyedTable:
        table = cls(df.sparkSession, path, df.schema, tuple(key), buckets)
        table._write(df.withColumn(KEY, encoded_key(key)).repartition(buckets, KEY))
        return table

    def _name(self) -> str:
        """The table's name in the session's catalog, registered if it is not."""
        name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()}"
        fields = StructType([*self.schema.fields, StructField(KEY, StringType())])
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                       f"CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return name

    def _write(self, keyed: DataFrame) -> None:
        keyed.select(*self.schema.fieldNames(), KEY).write.insertInto(self._name())

    def frame(self) -> DataFrame:
        return self.spark.table(self._name()).select(*self.schema.fieldNames())

    def _merged(self, updates: DataFrame, order: Sequence[str] | None) -> DataFrame:
        if order is not None:
            updates = dedupe_by_key(updates, self.key, order, null_is_value=True)
        new = updates.select(encoded_key(self.key).alias("_new_key"), F.struct(*self.schema.fieldNames()).alias("_new"))
        old = self.spark.table(self._name()).select(KEY, F.struct(*self.schema.fieldNames()).alias("_old"))
        # every key of either side once: the new row where there is one
        both = old.join(new.repartition(self.buckets, "_new_key"), F.col(KEY) == F.col("_new_key"), "full_outer")
        row = F.when(F.col("_new_key").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
        return (both.select(row.alias("_row"), F.coalesce("_new_key", KEY).alias(KEY))
                .select("_row.*", KEY))

    def upserted(self, updates: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        """The table's rows after a merge (``updates`` has one row per key, or
        ``order`` picks the last)."""
        return self._merged(updates, order).select(*self.schema.fieldNames())

    def merge(self, updates: DataFrame, path: str, order: Sequence[str] | None = None) -> KeyedTable:
        """Writes the merged rows as a keyed table at ``path``: the join leaves
        every bucket in one task, so the write shuffles nothing either."""
        out = KeyedTable(self.spark, path, self.schema, self.key, self.buckets)
        out._write(self._merged(updates, order))
        return out
