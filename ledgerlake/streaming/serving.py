"""Gold → serving as a stream: ``foreachBatch`` key-merge into a snapshot table.

Each micro-batch is merged by primary key into the serving table without
passing through the driver:

1. the (period, bucket) folders the batch touches (a bounded list, see
   ``touched_partitions``);
2. the batch's rows, NULL measures mapped to 0 (the serving null policy, as the
   batch serving write), tagged with period and bucket;
3. the table's rows in the touched folders only (the manifest names them: other
   folders are neither listed nor read);
4. one row per key of (2) and (3), the one of the latest load, where NULL key
   parts equal each other; written to new folders, rebalanced and sorted by
   primary key;
5. one commit replaces the touched folders by the new ones.

An incremental load touches the latest periods, so the history is never
rewritten; within a period only the buckets of the orgs in the batch are.

Readers see the table before step 5 or after it, never between
(``sources.snapshots``).  ``foreachBatch`` is at-least-once: a batch that stopped
before step 5 left the table as it was and is merged again; one that is in the
table's log is left out.  Two writers may share a table: the second to commit
merges again on top of the first.

``rebucket`` gives a period the bucket count its bytes ask for, as a commit like
any other; ``compact`` does so for all periods that outgrew or never filled theirs.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedupe import dedupe_by_key
from ..plans import serving
from ..plans.serving import (BUCKET, BUCKET_COUNT, LOAD_SEQ, PERIOD, ServingSpec, buckets_for, null_policy,
                             serving_schema, with_layout)
from ..sources import readers
from ..sources.snapshots import SnapshotTable, Version, may_hold, retried


def with_load_seq(schema: StructType) -> StructType:
    """The schema of gold files that carry the number of their load."""
    if LOAD_SEQ in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(LOAD_SEQ, LongType(), True)])


def snapshot_table(spark: SparkSession, path: str, mart_schema: StructType, spec: ServingSpec) -> SnapshotTable:
    """The serving table at ``path``; it has no version before its first commit."""
    zones = tuple(c for c in dict.fromkeys((*spec.primary_key, "service")) if c in mart_schema.fieldNames())
    return SnapshotTable(spark, path, serving_schema(mart_schema, spec), spec.layout, spec.primary_key, zones)


def bucket_counts(table: SnapshotTable, version: Version, spec: ServingSpec, buckets: int) -> Column:
    """Bucket count of each period: the table's, or ``buckets`` for a period it
    does not have yet.  Periods are few (months or years)."""
    held = table.manifest(version)
    if not spec.time_col:
        first = held.select(BUCKET_COUNT).limit(1).collect()
        return F.lit(first[0][0] if first else buckets)
    out = F.lit(buckets)
    for p, n in held.select(PERIOD, BUCKET_COUNT).distinct().collect():
        if n != buckets:
            out = F.when(F.col(PERIOD).eqNullSafe(F.lit(p).cast("date")), F.lit(n)).otherwise(out)
    return out


def touched_partitions(laid_out: DataFrame, spec: ServingSpec) -> list[tuple]:
    """The (period, bucket) folders a batch writes to.

    Bounded by the layout, not by the data: at most periods × buckets values,
    a bucket standing for hundreds of MB.
    """
    return [tuple(r) for r in laid_out.select(*spec.layout).distinct().collect()]


def folder_filter(folders: list[tuple], spec: ServingSpec) -> Column:
    """Predicate on the partition columns selecting exactly ``folders``
    (static partition pruning: only those folders are listed and read).  NULL
    is a folder like any other."""
    if not folders:
        return F.lit(False)
    outer = spec.layout[:-1]            # every level above key_bucket
    by_prefix: dict = defaultdict(set)
    for f in folders:
        by_prefix[tuple(f[:-1])].add(f[-1])
    cond = None
    for prefix, bs in by_prefix.items():
        c = F.col(BUCKET).isin(sorted(b for b in bs if b is not None))
        if None in bs:
            c = c | F.col(BUCKET).isNull()
        for name, value in zip(outer, prefix):
            c = (F.col(name).isNull() if value is None else F.col(name) == F.lit(value)) & c
        cond = c if cond is None else cond | c
    return cond


def merge_batch(table: SnapshotTable, batch: DataFrame, batch_id: int, writer: str, spec: ServingSpec,
                buckets: int = 1) -> Version:
    """Merges a batch by primary key and commits it; a batch that the table's log
    already has from this writer changes nothing."""
    schema = table.schema

    def work() -> Version:
        base = table.head()
        if base.batches.get(writer, -1) >= batch_id:
            return base
        counts = bucket_counts(table, base, spec, buckets)
        updates = with_layout(null_policy(batch, spec), spec, counts).select(*schema.fieldNames())
        folders = touched_partitions(updates, spec)        # the one pass before the write
        if not folders:                                    # an empty batch
            return base
        touched = folder_filter(folders, spec)
        held = table.read(base, touched)
        merged = dedupe_by_key(held.unionByName(updates), list(spec.primary_key), [LOAD_SEQ], null_is_value=True)
        return table.commit(base, table.write(merged), touched, writer=writer, batch=batch_id)

    return retried(work)


def rebucket(table: SnapshotTable, spec: ServingSpec, period, buckets: int) -> Version:
    """One period's rows dealt into ``buckets`` org buckets, in one commit."""
    def work() -> Version:
        base = table.head()
        own = F.col(PERIOD).eqNullSafe(F.lit(period).cast("date")) if spec.time_col else F.lit(True)
        rows = table.read(base, own)
        return table.commit(base, table.write(with_layout(rows.drop(PERIOD, BUCKET_COUNT, BUCKET), spec, buckets)), own)

    return retried(work)


def compact(table: SnapshotTable, spec: ServingSpec) -> list:
    """Re-buckets the periods whose buckets are more than twice the set size, or so
    small that twice their bytes would do with fewer, one commit each; returns them.

    Sizes come from the manifest.  (Bytes change a little with the number of files:
    the margin keeps a period from being dealt anew again and again.)"""
    groups = [PERIOD] if spec.time_col else []
    sizes = (table.manifest(table.head()).groupBy(*groups)
             .agg(F.sum("bytes").alias("size"), F.max(BUCKET_COUNT).alias("n")).collect())
    wrong = [(r[PERIOD] if groups else None, buckets_for(r["size"])) for r in sizes if r["n"] is not None
             and (buckets_for(r["size"]) > 2 * r["n"] or buckets_for(2 * r["size"]) < r["n"])]
    for period, n in wrong:
        rebucket(table, spec, period, n)
    return [p for p, _ in wrong]


def ask(table: SnapshotTable, spec: ServingSpec, org, *, date_from: str | None = None, date_to: str | None = None,
        service: str | None = None, version: Version | None = None) -> DataFrame:
    """The folders that may hold an org's rows, of one version, for a question.

    The manifest is asked first: the org's bucket in each folder's count, the
    period range, and the folder's ranges of org and service."""
    org = F.lit(org).cast(table.schema["org_id"].dataType)
    where = (F.col(BUCKET) == F.pmod(F.xxhash64(org), F.col(BUCKET_COUNT)).cast("int")) & may_hold("org_id", org)
    if spec.time_col and date_from:
        where = where & (F.col(PERIOD) >= serving.period_of(F.lit(date_from), spec.period_grain))
    if spec.time_col and date_to:
        where = where & (F.col(PERIOD) <= serving.period_of(F.lit(date_to), spec.period_grain))
    if service is not None and "service" in table.zones:
        where = where & may_hold("service", service)
    return table.read(version, where)


def start_serving_stream(spark: SparkSession, gold_dir: str, mart_schema: StructType,
                         table: str, checkpoint: str, spec: ServingSpec,
                         *, files_per_trigger: int | None = 1, buckets: int = 1):
    """Start streaming every gold file present into the serving table.

    The gold files carry ``load_seq`` next to the mart's columns.  ``buckets``
    is the bucket count of periods the table does not have yet.  Returns
    ``(query, batch_ids)``; the query stops by itself once the files present at
    start are merged (``availableNow``).  Several targets may run at once in one
    session, each with its own checkpoint.
    """
    src = readers.stream_parquet(spark, gold_dir, with_load_seq(mart_schema),
                                 max_files_per_trigger=files_per_trigger)
    target = snapshot_table(spark, table, mart_schema, spec)
    seen: list[int] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        merge_batch(target, batch, batch_id, checkpoint, spec, buckets)

    q = (src.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    return q, seen


def run_serving_stream(spark: SparkSession, gold_dir: str, mart_schema: StructType,
                       table: str, checkpoint: str, spec: ServingSpec,
                       *, files_per_trigger: int | None = 1, buckets: int = 1) -> int:
    """Stream every gold file present into the serving table; returns batches run."""
    q, seen = start_serving_stream(spark, gold_dir, mart_schema, table, checkpoint, spec,
                                   files_per_trigger=files_per_trigger, buckets=buckets)
    q.awaitTermination()
    return len(seen)
