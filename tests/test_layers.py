"""Stream state and reports, late rows, dynamic overwrite, the lossless serving merge."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import gold, jobs, serving
from ledgerlake.plans.assemble import Lake
from ledgerlake.session import run_dir
from ledgerlake.sources import files, readers, standins, writers
from ledgerlake.sources.snapshots import SnapshotTable
from ledgerlake.streaming import bronze as sbronze
from ledgerlake.streaming import serving as sserving
from ledgerlake.streaming.landing import file_number, land_files

from conftest import SF_MID, SF_SMALL

SPEC = serving.SERVING["daily_usage"]


# ------------------------------------------------------------------ bronze stream
def _state_rows(spark, bounded):
    feed = Lake(spark, SF_SMALL).bronze_events()
    landing = run_dir(spark, "t_landing")
    land_files(feed, landing, file_number("timestamp", standins.FEED_START, 3))
    src = readers.stream_jsonl(spark, landing, feed.schema, max_files_per_trigger=1)
    out = sbronze.dedupe_stream(src, bounded_state=bounded)
    writer = (out.writeStream.format("parquet").option("path", run_dir(spark, "t_out"))
              .option("checkpointLocation", run_dir(spark, "t_ckpt")).trigger(availableNow=True))
    q = sbronze.start_with_state_partitions(spark, writer, 4)
    q.awaitTermination()
    last = [p for p in q.recentProgress if p["stateOperators"]][-1]
    keyed = feed.filter("event_id IS NOT NULL AND timestamp IS NOT NULL").count()
    return last["stateOperators"][0]["numRowsTotal"], keyed


def test_watermark_bounds_dedupe_state(spark):
    bounded, ids = _state_rows(spark, True)
    unbounded, _ = _state_rows(spark, False)
    assert unbounded == ids            # every id kept forever
    assert bounded < ids / 3           # only ids within the watermark delay


def test_stream_reads_each_file_once(spark):
    """One scan in the stream's plan; rows without id or time stay, copies too,
    and leave no state behind."""
    feed = Lake(spark, SF_SMALL).bronze_events().schema
    landing, out, ckpt = run_dir(spark, "t_land"), run_dir(spark, "t_bronze"), run_dir(spark, "t_ckpt")
    first = ['{"event_id":1,"timestamp":"2024-03-01T00:00:00.000000Z"}'] * 2 + \
        ['{"timestamp":"2024-03-01T00:00:00.000000Z"}'] * 3 + ['{"event_id":2}'] * 2 + ["{}"]
    late = ['{"timestamp":"2024-01-01T00:00:00.000000Z"}', '{"event_id":3,"timestamp":"2024-01-01T00:00:00.000000Z"}']
    for lines in (first, ['{"event_id":4,"timestamp":"2024-03-09T00:00:00.000000Z"}'], late,
                  ['{"event_id":5,"timestamp":"2024-03-10T00:00:00.000000Z"}']):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)
    run = sbronze.run_bronze_stream(spark, landing, feed, out, ckpt, state_partitions=2, files_per_trigger=1)
    rows = readers.read_parquet(spark, out, feed).collect()
    assert sorted((r.event_id is None, r.event_id or 0, r.timestamp is None) for r in rows) == [
        (False, 1, False), (False, 2, True), (False, 2, True), (False, 4, False), (False, 5, False),
        (True, 0, False), (True, 0, False), (True, 0, False), (True, 0, False), (True, 0, True)]
    assert (run.rows_read, run.rows_dropped_late, run.batches) == (12, 1, 4)
    left = spark.read.format("statestore").load(ckpt)
    assert {r.key["_key"] for r in left.select("key").collect()} <= {"k4", "k5"}


def test_every_row_lands_and_every_batch_is_counted(spark):
    """More batches than the query object remembers; rows before the first day
    and rows without a time; late rows counted and brought back."""
    n = 115
    rows = [(i, f"2024-03-{1 + i % 28:02d} 00:{i % 60:02d}:00") for i in range(n)]
    rows += [(1000, "2023-12-01 00:00:00"), (1001, None)]
    feed = (spark.createDataFrame(rows, "event_id long, timestamp string")
            .withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    landing = run_dir(spark, "t_landing")
    # a group per row, in the order of the ids: times jump back every 28 rows
    groups = land_files(feed, landing, F.when(F.col("event_id") != 1001, F.col("event_id").cast("int")))
    assert len(groups) == n + 2 and groups[0] is None
    run = sbronze.run_bronze_stream(spark, landing, feed.schema, run_dir(spark, "t_bronze"),
                                    run_dir(spark, "t_ckpt"), state_partitions=1,
                                    files_per_trigger=1, lineage=True)
    assert (run.batches, run.rows_read) == (n + 2, n + 2)
    held = readers.read_parquet(spark, run.output, feed.schema).count()
    assert run.rows_dropped_late == n + 2 - held > 50
    late = run_dir(spark, "t_late")
    for _ in range(2):                                    # the second run finds nothing
        sbronze.backfill_late(spark, landing, feed.schema, run.output, late)
        schema = readers.with_lineage(readers.read_jsonl(spark, landing, feed.schema)).schema
        got = sbronze.read_bronze(spark, run.output, late, schema)
        assert sorted((r.event_id for r in got.collect())) == sorted(r[0] for r in rows)


def test_corrupt_records_keep_their_text(spark):
    landing = run_dir(spark, "t_lines")
    lines = ['{"event_id":1,"timestamp":"2024-01-01T00:00:00.000000Z"}', '{broken',
             '{"event_id":2,"timestamp":"no time"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(landing)
    schema = readers.with_corrupt(Lake(spark, SF_SMALL).bronze_events().schema)
    df = jobs.bronze_lines(spark, landing, Lake(spark, SF_SMALL).bronze_events().schema,
                           run_dir(spark, "t_bronze"))
    assert set(schema.fieldNames()) <= set(df.columns)
    assert sorted(r[0] for r in df.select("_corrupt_record").dropna().collect()) == sorted(lines[1:])


def test_csv_corrupt_records_keep_their_text(spark):
    path = run_dir(spark, "t_csv")
    spark.createDataFrame([("k,v",), ("1,2",), ("x,3",)], "value string").coalesce(1).write.text(path)
    df = readers.read_csv(spark, path, spark.createDataFrame([], "k int, v int").schema, keep_corrupt=True)
    assert sorted(((r.k, r.v, r._corrupt_record) for r in df.collect()), key=repr) == [
        (1, 2, None), (None, 3, "x,3")]


def test_dynamic_overwrite_replaces_only_given_days(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int") \
        .withColumn("d", F.col("d").cast("date"))
    path = writers.write_partitioned(df, run_dir(spark, "t_dyn"), "d")
    fix = spark.createDataFrame([("2024-01-02", 20)], "d string, v int").withColumn("d", F.col("d").cast("date"))
    writers.write_partitioned(fix, path, "d", dynamic=True)
    got = sorted((str(r.d), r.v) for r in readers.read_parquet(spark, path, df.schema).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20)]


# ------------------------------------------------------------------ serving merge
def _mart(spark):
    return gold.build(Lake(spark, SF_SMALL).usage_features(None), gold.DAILY_USAGE)


def _load(df, seq):
    return df.withColumn(serving.LOAD_SEQ, F.lit(seq).cast("long"))


class Table:
    """A serving table with its writer."""

    def __init__(self, spark, schema, spec=SPEC):
        self.spark, self.schema, self.spec = spark, schema, spec
        self.table = sserving.snapshot_table(spark, run_dir(spark, "t_serving"), schema, spec)

    def merge(self, df, batch_id, seq=1, buckets=1, writer="t"):
        return sserving.merge_batch(self.table, _load(df, seq), batch_id, writer, self.spec, buckets)

    def frame(self, version=None):
        return self.table.read(version)

    def rows(self, version=None):
        return sorted((tuple(r) for r in self.frame(version).select(*self.schema.fieldNames()).collect()), key=repr)

    def folders(self):
        m = self.table.manifest(self.table.head())
        return {tuple(str(r[c]) for c in self.spec.layout): r for r in m.collect()}


def _rows_of(df, spec=SPEC):
    return sorted((tuple(r) for r in serving.null_policy(df, spec).collect()), key=repr)


def test_merge_replay_changes_nothing(spark):
    mart = _mart(spark)
    assert mart.filter("service IS NULL").count() > 0      # NULL is part of some keys
    t = Table(spark, mart.schema)
    t.merge(mart, 0)
    assert t.rows() == _rows_of(mart)
    for batch_id in (0, 1, 2):
        t.merge(mart, batch_id)
        assert t.rows() == _rows_of(mart)
    for c in SPEC.zero_if_null:                            # the serving null policy holds
        assert t.frame().filter(F.col(c).isNull()).count() == 0, c


def test_merge_keeps_rows_of_a_null_period(spark):
    mart = _mart(spark)
    no_date = mart.limit(2).withColumn("usage_date", F.lit(None).cast("date"))
    one, two = (no_date.withColumn("org_id", F.lit(k).cast("long")).dropDuplicates(["org_id"]) for k in (1, 2))
    t = Table(spark, mart.schema)
    t.merge(one, 0)
    t.merge(two, 1, seq=2)
    assert sorted(r[0] for r in t.frame().select("org_id").collect()) == [1, 2]
    t.merge(two, 2, seq=3)
    assert t.frame().count() == 2


def test_later_load_stays_whatever_the_order(spark):
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    t.merge(mart.withColumn("total_cost_usd", F.lit(2.0)), 0, seq=2)
    t.merge(mart.withColumn("total_cost_usd", F.lit(1.0)), 1, seq=1)
    assert {r[0] for r in t.frame().select("total_cost_usd").collect()} == {2.0}
    assert t.frame().count() == mart.count()


def test_crash_before_the_commit_changes_nothing(spark, monkeypatch):
    """Rows are written, the commit does not come: readers see the old table, and
    the replay merges once more."""
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    t.merge(mart, 0)
    fix = (spark.createDataFrame(mart.limit(5).collect(), mart.schema)
           .withColumn("total_cost_usd", F.lit(-1.0)))
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            t.merge(fix, 1, seq=2)
    assert t.table.head().number == 1 and t.rows() == _rows_of(mart)
    t.merge(fix, 1, seq=2)
    once = t.rows()
    assert t.table.head().number == 2 and len(once) == mart.count() and once != _rows_of(mart)
    assert t.merge(fix, 1, seq=2).number == 2              # the log has this batch


def test_readers_see_the_old_table_or_the_new_one(spark, monkeypatch):
    """A question asked at any point of a merge, and one that began before it."""
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    t.merge(mart, 0)
    old, pinned, seen = t.rows(), t.table.head(), []
    begun = t.frame(pinned)                                # planned now, run after the merge
    fix = mart.withColumn("total_cost_usd", F.lit(-1.0))
    write, commit = SnapshotTable.write, SnapshotTable.commit

    def watched(step, before):
        def run(self, *a, **k):
            if before:
                seen.append(t.rows())
            out = step(self, *a, **k)
            seen.append(t.rows())
            return out
        return run

    monkeypatch.setattr(SnapshotTable, "write", watched(write, True))
    monkeypatch.setattr(SnapshotTable, "commit", watched(commit, True))
    t.merge(fix, 1, seq=2)
    new = _rows_of(fix)
    assert seen == [old, old, old, new]
    assert t.rows(pinned) == old
    assert sorted((tuple(r) for r in begun.select(*mart.columns).collect()), key=repr) == old


def test_second_writer_merges_on_top_of_the_first(spark, monkeypatch):
    """Two batches start from one version: the later commit starts over."""
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    t.merge(mart, 0)
    org = mart.agg(F.min("org_id")).first()[0]
    one = mart.where(F.col("org_id") == org).withColumn("total_cost_usd", F.lit(-1.0))
    two = mart.where(F.col("org_id") != org).withColumn("total_cost_usd", F.lit(-2.0))
    commit, raced = SnapshotTable.commit, []

    def race(self, *a, **k):
        if not raced:
            raced.append(1)
            t.merge(one, 7, seq=2, writer="first")
        return commit(self, *a, **k)

    monkeypatch.setattr(SnapshotTable, "commit", race)
    assert t.merge(two, 1, seq=2).number == 3
    assert t.rows() == _rows_of(one.unionByName(two))
    assert t.table.head().batches == {"t": 1, "first": 7}


def test_two_checkpoints_merge_into_one_table(spark):
    mart = _mart(spark)
    gold_dir = run_dir(spark, "t_gold")
    _load(mart, 1).write.parquet(gold_dir)
    table = run_dir(spark, "t_serving")
    for _ in range(2):                                     # two checkpoints, batch 0 in each
        sserving.run_serving_stream(spark, gold_dir, mart.schema, table, run_dir(spark, "t_ckpt"), SPEC,
                                    files_per_trigger=None)
        assert sserving.snapshot_table(spark, table, mart.schema, SPEC).read().count() == mart.count()


def test_stream_restart_keeps_table(spark):
    """Second availableNow run on the same checkpoint: no batch, table intact."""
    mart = _mart(spark)
    gold_dir, table, ckpt = (run_dir(spark, f"t_{x}") for x in ("gold", "serving", "ckpt"))
    _load(mart, 1).write.parquet(gold_dir)
    first = sserving.run_serving_stream(spark, gold_dir, mart.schema, table, ckpt, SPEC,
                                        files_per_trigger=None, buckets=2)
    again = sserving.run_serving_stream(spark, gold_dir, mart.schema, table, ckpt, SPEC,
                                        files_per_trigger=None, buckets=2)
    assert first >= 1 and again == 0
    assert sserving.snapshot_table(spark, table, mart.schema, SPEC).read().count() == mart.count()


def test_a_table_without_a_commit_is_empty(spark):
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    assert t.table.head().number == 0 and t.frame().count() == 0
    t.merge(mart.limit(0), 0)                              # nothing to merge: no version
    assert t.table.head().number == 0
    assert files.create_once(spark, f"{t.table.path}/x", "a") and not files.create_once(spark, f"{t.table.path}/x", "b")
    assert files.read_text(spark, f"{t.table.path}/x") == "a"


def test_merge_rewrites_only_touched_folders_and_counts_stay_per_period(spark):
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    feb = mart.withColumn("usage_date", F.date_add("usage_date", 31))
    t.merge(mart.unionByName(feb), 0, buckets=4)
    before = t.folders()
    org = mart.agg(F.min("org_id")).first()[0]
    fix = mart.filter(F.col("org_id") == org).withColumn("total_cost_usd", F.lit(-1.0))
    # January keeps its 4 buckets although the caller would now start with 16
    t.merge(fix, 1, seq=2, buckets=16)
    after = t.folders()
    bucket = spark.range(1).select(serving.key_bucket(F.lit(org).cast("long"), 4)).first()[0]
    assert set(after) == set(before) and sum(r.rows for r in after.values()) == 2 * mart.count()
    changed = {k for k in before if after[k].folder != before[k].folder}
    assert changed == {("2024-01-01", "4", str(bucket))}   # every other folder is the same
    fixed = t.frame().filter((F.col("org_id") == org) & (F.col("period") == F.lit("2024-01-01").cast("date")))
    assert fixed.count() == fix.count() and fixed.filter("total_cost_usd <> -1").count() == 0
    # a new period takes the new count; lookups find both
    later = mart.withColumn("usage_date", F.date_add("usage_date", 400))
    t.merge(later, 2, buckets=16)
    assert all(t.folders()[k].folder == r.folder for k, r in after.items())
    assert {r[0] for r in t.frame().select("bucket_count").distinct().collect()} == {4, 16}
    assert serving.lookup(t.frame(), org).count() == 3 * fix.count()


def test_questions_open_only_folders_that_may_answer(spark):
    """Bucket, period and the manifest's ranges of org and service prune folders."""
    mart = _mart(spark)
    t = Table(spark, mart.schema)
    far = mart.withColumn("usage_date", F.date_add("usage_date", 31)).withColumn("service", F.lit("zz"))
    t.merge(mart.unionByName(far), 0, buckets=8)
    org = mart.agg(F.min("org_id")).first()[0]
    whole = t.frame()

    def opened(df):
        return len({f.rsplit("/", 1)[0] for f in df.inputFiles()})

    some = sserving.ask(t.table, SPEC, org)
    assert opened(some) <= 2 < opened(whole)
    assert serving.lookup(some, org).count() == serving.lookup(whole, org).count() > 0
    for service in ("zz", "s1"):
        named = sserving.ask(t.table, SPEC, org, service=service)
        assert opened(named) <= 1
        assert (serving.lookup(named, org).where(F.col("service") == service).count()
                == serving.lookup(whole, org).where(F.col("service") == service).count() > 0)
    none = sserving.ask(t.table, SPEC, org, date_from="2031-01-01")
    assert none.count() == 0 and opened(none) == 0


def test_periods_take_buckets_by_their_own_bytes(spark, monkeypatch):
    """One large period among small ones; re-bucketing keeps every answer."""
    mart = gold.build(Lake(spark, SF_MID).usage_features(None), gold.DAILY_USAGE)
    small = [mart.limit(3).withColumn("usage_date", F.add_months(F.lit("2030-01-01").cast("date"), k)) for k in range(12)]
    rows = mart
    for s in small:
        rows = rows.unionByName(s)
    t = Table(spark, mart.schema)
    t.merge(rows.dropDuplicates(list(SPEC.primary_key)), 0, buckets=4)
    sizes = [r.bytes for r in t.folders().values()]
    monkeypatch.setattr(serving, "BUCKET_BYTES", max(sizes) // 3)
    want = t.rows()
    first = t.table.head()
    changed = sserving.compact(t.table, SPEC)
    assert len(changed) == 13 and sserving.compact(t.table, SPEC) == []
    assert t.rows() == want == t.rows(first)
    by_period = {}
    for (period, _, _), r in t.folders().items():
        by_period.setdefault(period, []).append(r.bytes)
    large = by_period.pop("2024-01-01")
    assert len(large) > 4 and all(len(b) == 1 for b in by_period.values())
    assert all(b >= serving.BUCKET_BYTES // 8 for b in large)
    # the batch layout deals buckets by the periods' rows, too
    gold_path = writers.write_parquet(rows, run_dir(spark, "t_gold"))
    table = serving.serve(gold_path, rows, run_dir(spark, "t_serving"), SPEC)
    counts = {str(r[0]): r[1] for r in table.select("period", "bucket_count").distinct().collect()}
    assert counts.pop("2024-01-01") > 1 and set(counts.values()) == {1}


def test_buckets_have_no_ceiling():
    one = serving.BUCKET_BYTES
    assert [serving.buckets_for(x) for x in (0, one, one + 1, 1000 * one)] == [1, 1, 2, 1024]
    assert serving.buckets_for(1000 * one, periods=10) == 128
