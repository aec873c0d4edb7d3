"""Streaming bronze: JSON-lines file stream → lineage → watermark → dedupe → Parquet.

``dropDuplicatesWithinWatermark`` keeps a key's state only until the
watermark passes its event time, so state stays bounded by the watermark
delay; plain ``dropDuplicates`` on the id (event time not in the key) keeps
every id forever and is selectable with ``bounded_state=False``.  Rows without
an id are not duplicates of each other and rows without a time are behind no
watermark: both pass the dedupe as they are, to where the quality rules
quarantine them.

Rows older than the watermark are dropped by the dedupe operator.  A run counts
them from all its progress reports (a listener: the query object keeps only the
last hundred), and :func:`backfill_late` brings them back from the landing
files, so late data is neither lost nor uncounted.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.dedupe import dedupe_by_key
from ..sources import files, readers

WATERMARK = "2 days"
FILES_PER_TRIGGER = 10
# seconds to wait for the reports of a query that has ended
REPORT_TIMEOUT = 60


@dataclass
class StreamRun:
    output: str
    checkpoint: str
    batches: int              # that had rows
    rows_read: int
    rows_dropped_late: int


class _Totals(StreamingQueryListener):
    """Adds up the progress of one query (by run id), however many batches."""

    def __init__(self):
        self.batches = self.rows = self.late = 0
        self.run_id = None
        self.ended = threading.Event()
        self._early: list = []

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        if self.run_id is None:
            self._early.append(p)
        else:
            self._add(p)

    def follow(self, run_id: str):
        self.run_id = run_id
        for p in self._early:
            self._add(p)

    def _add(self, p: dict):
        if p["runId"] != self.run_id:
            return
        self.rows += p["numInputRows"]
        self.batches += p["numInputRows"] > 0
        self.late += sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])

    def onQueryTerminated(self, event):
        if self.run_id in (None, str(event.runId)):
            self.ended.set()


def dedupe_stream(events: DataFrame, *, key: str = "event_id", event_time: str = "timestamp",
                  watermark: str = WATERMARK, bounded_state: bool = True) -> DataFrame:
    """Events without the copies of an id that come within the watermark.

    One branch, so every file is read once.  A row without id or time gets a key
    of its own and no time for the watermark: it is a duplicate of nothing, late
    for nothing and moves the watermark nowhere, and its state expires with the
    next batch.  With unbounded state nothing expires, so there such rows pass
    beside the dedupe, by a second read.
    """
    whole = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    if not bounded_state:
        src = events.withWatermark(event_time, watermark)
        return src.filter(whole).dropDuplicates([key]).unionByName(src.filter(~whole))
    src = events.withColumns({
        "_key": F.when(whole, F.concat(F.lit("k"), F.col(key).cast("string"))).otherwise(F.expr("uuid()")),
        "_time": F.when(whole, F.col(event_time))}).withWatermark("_time", watermark)
    return src.dropDuplicatesWithinWatermark(["_key"]).select(*events.columns)


def start_with_state_partitions(spark: SparkSession, writer, state_partitions: int):
    """Start a stateful query with ``state_partitions`` state-store partitions.

    A new query takes its state partitioning from ``spark.sql.shuffle.partitions``
    at start and keeps it in its checkpoint for good, so the caller states it:
    it must suit the largest state the checkpoint will ever hold.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def run_bronze_stream(spark: SparkSession, landing: str, schema, output: str, checkpoint: str,
                      *, state_partitions: int, files_per_trigger: int = FILES_PER_TRIGGER,
                      watermark: str = WATERMARK, bounded_state: bool = True,
                      lineage: bool = True) -> StreamRun:
    """One ``availableNow`` run: process every file present, then stop.

    Re-running with the same checkpoint resumes after the last committed
    batch; files already processed are not read again.  The run has a session
    of its own (same catalog and context), so its settings touch no other query.
    """
    own = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass"):
        own.conf.set(k, spark.conf.get(k))
    src = readers.stream_jsonl(own, landing, schema, max_files_per_trigger=files_per_trigger)
    if lineage:
        src = readers.with_lineage(src)
    out = dedupe_stream(src, watermark=watermark, bounded_state=bounded_state)
    totals = _Totals()
    own.streams.addListener(totals)
    try:
        q = start_with_state_partitions(
            own, out.writeStream.format("parquet").option("path", output)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True), state_partitions)
        totals.follow(str(q.runId))
        q.awaitTermination()
        if not totals.ended.wait(REPORT_TIMEOUT):
            raise RuntimeError("the stream ended, its reports did not arrive")
    finally:
        own.streams.removeListener(totals)
    return StreamRun(output, checkpoint, totals.batches, totals.rows // (1 if bounded_state else 2), totals.late)


def read_bronze(spark: SparkSession, bronze: str, late: str, schema) -> DataFrame:
    """The stream's table and the backfills beside it.  (A folder that a stream
    writes lists its files in a log of its own: files that others append to it
    are not read.)"""
    out = readers.read_parquet(spark, bronze, schema)
    return out.unionByName(read_late(spark, late, schema))


def late_runs(spark: SparkSession, late: str) -> list[str]:
    """Names of the complete backfills, oldest first."""
    found = [n[len("run="):] for n in files.names(spark, late) if n.startswith("run=")]
    return sorted(n for n in found if files.exists(spark, f"{late}/run={n}/_SUCCESS"))


def read_late(spark: SparkSession, late: str, schema, runs: list[str] | None = None) -> DataFrame:
    paths = [f"{late}/run={n}" for n in (late_runs(spark, late) if runs is None else runs)]
    return readers.read_parquet_files(spark, paths, schema)


def unseen_files(spark: SparkSession, landing: str, ledger: str) -> list[str]:
    """Landed files that no backfill has reconciled: the listing without the
    ledger's; as many names as files came since."""
    landed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
              .select("path"))
    if files.exists(spark, f"{ledger}/_SUCCESS"):
        landed = landed.join(spark.read.schema("path string").parquet(ledger), "path", "left_anti")
    return sorted(r.path for r in landed.collect())


def backfill_late(spark: SparkSession, landing: str, schema, bronze: str, late: str, *,
                  key: str = "event_id", event_time: str = "timestamp") -> str | None:
    """Writes the landed events whose id neither table has, as one run of
    ``late``; returns its name (None if no file came since the last run).

    These are the rows the watermark dropped.  Rows without id or time never
    pass the dedupe, so they are in bronze already.  Every file is read by one
    run: a ledger keeps the names of those reconciled, and the run's events are
    held against bronze in their own time range only (a re-delivered event keeps
    its time).  It is for files that the stream has taken.  A run that stops
    before its ledger entry is done again and finds what it wrote in ``late``.
    """
    ledger = f"{late}-files"
    names = unseen_files(spark, landing, ledger)
    if not names:
        return None
    landed = readers.with_lineage(readers.read_jsonl(spark, names, schema))
    landed = landed.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
    first, last = landed.agg(F.min(event_time).cast("string"), F.max(event_time).cast("string")).first()
    held = (read_bronze(spark, bronze, late, landed.schema)
            .filter(F.col(event_time).between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))
            .select(key))
    missing = dedupe_by_key(landed.join(held, key, "left_anti"), [key])
    run = f"{len(files.names(spark, late)):08d}-{uuid.uuid4().hex[:8]}"
    missing.select(*landed.columns).write.parquet(f"{late}/run={run}")
    spark.createDataFrame([(n,) for n in names], "path string").write.mode("append").parquet(ledger)
    return run
