"""Late rows to the marts: partial aggregates merged, late periods refreshed."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.catalog import UsageMarts
from ledgerlake.plans import gold, partials, serving, silver
from ledgerlake.plans.assemble import Lake
from ledgerlake.session import run_dir
from ledgerlake.sources import readers, writers
from ledgerlake.sources.snapshots import SnapshotTable
from ledgerlake.streaming import bronze as sbronze

from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _silver_of(lake, mart):
    if mart.name == "revenue_month":
        return silver.revenue_amounts(lake.billing()), "month"
    if mart.name == "tickets_day":
        return lake.silver_tickets(), "ticket_date"
    return lake.usage_features((0.5, 1.5)), "usage_date"


@pytest.mark.parametrize("mart", [gold.DAILY_USAGE, gold.REVENUE_MONTH, gold.TICKETS_DAY, gold.cost_anomaly(0.5, 1.5)],
                         ids=lambda m: m.name)
def test_merged_partials_equal_one_build(spark, mart):
    """Every kind of measure, whatever the number and order of loads."""
    rows, day = _silver_of(Lake(spark, SF_SMALL), mart)
    store = partials.PartialStore(spark, run_dir(spark, "t_partials"), mart, day, "month")
    assert store.loads() == [] and store.build(rows.schema).count() == 0
    part = F.pmod(F.hash(*[c for c, t in rows.dtypes if t in ("bigint", "string")]), F.lit(3))
    for k in (2, 0, 1):
        store.add(rows.where(part == k), f"l{k}")
    store.add(rows, "l1")                                  # a load that is there stays
    want = gold.build(rows, mart)
    got = store.build(rows.schema)
    assert got.columns == want.columns and _rows(got) == _rows(want) and want.count() > 0


@pytest.mark.parametrize("mart", [gold.DAILY_USAGE, gold.REVENUE_MONTH, gold.TICKETS_DAY, gold.cost_anomaly(0.5, 1.5)],
                         ids=lambda m: m.name)
def test_compacted_partials_equal_one_build(spark, mart):
    """Loads merged, loads added afterwards, merged again: one row per key in
    the folder read, the same mart at every step."""
    rows, day = _silver_of(Lake(spark, SF_SMALL), mart)
    store = partials.PartialStore(spark, run_dir(spark, "t_partials"), mart, day, "month")
    assert store.compact(rows.schema) is None
    part = F.pmod(F.hash(*[c for c, t in rows.dtypes if t in ("bigint", "string")]), F.lit(3))
    store.add(rows.where(part == 0), "b")
    assert store.compact(rows.schema) is None              # one folder is merged already
    store.add(rows.where(part == 1), "c")
    first = store.compact(rows.schema)
    assert store.folders() == [first] and store.loads() == ["b", "c"]
    store.add(rows.where(part == 1), "c")                  # merged, but still there
    store.add(rows.where(part == 2), "a")
    want = _rows(gold.build(rows, mart))
    assert store.folders() == [first, "a"] and _rows(store.build(rows.schema)) == want
    second = store.compact(rows.schema)
    assert store.folders() == [second] and _rows(store.build(rows.schema)) == want and want
    assert store.read(store._schema(rows.schema)).count() == len(want)
    with pytest.raises(ValueError, match="may not begin"):
        store.add(rows, first)


def test_compaction_that_stops_or_comes_second_changes_nothing(spark, monkeypatch):
    mart = gold.TICKETS_DAY
    rows, day = _silver_of(Lake(spark, SF_SMALL), mart)
    store = partials.PartialStore(spark, run_dir(spark, "t_partials"), mart, day, "month")
    part = F.pmod(F.hash("ticket_date", "severity"), F.lit(2))
    for k in (0, 1):
        store.add(rows.where(part == k), f"l{k}")
    want, listed = _rows(gold.build(rows, mart)), store.folders()
    reader = store.build(rows.schema)                      # planned before
    with monkeypatch.context() as m:
        m.setattr(partials.files, "create_once", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            store.compact(rows.schema)
    assert store.folders() == listed and store.loads() == ["l0", "l1"]
    assert _rows(store.build(rows.schema)) == want
    real = store._write

    def beaten(parts, folder):                             # another compaction commits while this one writes
        monkeypatch.setattr(store, "_write", real)
        assert store.compact(rows.schema) is not None
        real(parts, folder)
    monkeypatch.setattr(store, "_write", beaten)
    assert store.compact(rows.schema) is None
    assert len(store.folders()) == 1 and _rows(store.build(rows.schema)) == want
    assert _rows(reader) == want


def test_compacted_marts_take_late_loads(spark):
    """The serving tables go on from merged partials."""
    lake = Lake(spark, SF_SMALL)
    events = lake.bronze_events()
    marts = UsageMarts(spark, lake, run_dir(spark, "t_marts"))
    old = F.pmod(F.hash("event_id"), F.lit(3))
    marts.load(events.where(old == 0), "0")
    marts.load(events.where(old == 1), "1")
    marts.compact()
    marts.load(events.where((old == 2) | old.isNull()), "2")
    for n, rows in UsageMarts._silver(events).items():
        mart = marts.stores[n].mart
        assert len(marts.stores[n].folders()) == 2
        want = serving.null_policy(gold.with_org_attrs(gold.build(rows, mart), lake.orgs(), mart), serving.SERVING[n])
        assert _rows(marts.table(n).read().select(*want.columns)) == _rows(want)


def _event(i, day, cost, org=11, metric="requests", value="2"):
    return (i, f"2024-{day}T01:00:00.000000Z", org, "s1", metric, value, "u", cost)


SCHEMA = "event_id long, timestamp string, org_id long, service string, metric string, value string, unit string, cost_usd_increment double"


def _land(spark, landing, feed_schema, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.mode("append").json(landing)


def test_late_rows_reach_their_periods_only(spark, monkeypatch):
    """Rows of January come when the stream is in May: backfill reads new files
    only, the marts read and rewrite January only, and a stopped load is done
    again."""
    lake = Lake(spark, SF_SMALL)
    feed = lake.bronze_events().schema
    landing, out, ckpt, late = (run_dir(spark, f"t_{x}") for x in ("land", "bronze", "ckpt", "late"))
    runs = [[_event(1, "01-05", 1.0), _event(2, "01-06", 2.0)], [_event(3, "03-01", 4.0)], [_event(4, "05-01", 8.0)]]
    for rows in runs:
        _land(spark, landing, feed, rows)

    def stream():
        return sbronze.run_bronze_stream(spark, landing, feed, out, ckpt, state_partitions=2, files_per_trigger=1)

    stream()
    schema = readers.with_lineage(readers.read_jsonl(spark, landing, feed)).schema
    marts = UsageMarts(spark, lake, run_dir(spark, "t_marts"))
    marts.load(readers.read_parquet(spark, out, schema), "0-stream")
    assert sbronze.backfill_late(spark, landing, feed, out, late) is not None
    assert marts.absorb_late(late, schema) != [] and marts.absorb_late(late, schema) == []
    before = {r.period: r.folder for r in
              marts.table("daily_usage").manifest(marts.table("daily_usage").head()).collect()}

    # late rows, one of them delivered before, and one too far behind for the watermark
    _land(spark, landing, feed, [_event(5, "01-05", 16.0), _event(1, "01-05", 1.0), _event(6, "01-20", 32.0, org=None)])
    run = stream()
    assert run.rows_dropped_late == 3
    read = []
    real = readers.read_jsonl
    monkeypatch.setattr(readers, "read_jsonl", lambda s, p, *a, **k: read.append(p) or real(s, p, *a, **k))
    name = sbronze.backfill_late(spark, landing, feed, out, late)
    assert len(read) == 1 and len(read[0]) == 1            # the new file
    assert sbronze.backfill_late(spark, landing, feed, out, late) is None
    assert sorted(r.event_id for r in sbronze.read_late(spark, late, schema, [name]).collect()) == [5, 6]

    with monkeypatch.context() as m:                       # stopped before the serving rows are committed
        m.setattr(SnapshotTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            marts.absorb_late(late, schema)
    assert marts.absorb_late(late, schema) == [name]
    store = marts.stores["daily_usage"]
    assert store.periods(f"late-{name}") == ["2024-01-01"]
    plan = marts.mart("daily_usage", ["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "partials" in x)
    assert "PartitionFilters" in scan and "2024-01-01" in scan[scan.index("PartitionFilters"):].split("PushedFilters")[0]
    after = {r.period: r.folder for r in
             marts.table("daily_usage").manifest(marts.table("daily_usage").head()).collect()}
    assert {str(p) for p in after if after[p] != before[p]} == {"2024-01-01"} and set(after) == set(before)

    # equal to a rebuild from every landed row
    every = sbronze.read_bronze(spark, out, late, schema)
    assert sorted(r.event_id for r in every.collect()) == [1, 2, 3, 4, 5, 6]
    for n, rows in UsageMarts._silver(every).items():
        mart = marts.stores[n].mart
        want = serving.null_policy(gold.with_org_attrs(gold.build(rows, mart), lake.orgs(), mart), serving.SERVING[n])
        got = marts.table(n).read().select(*want.columns)
        assert _rows(got) == _rows(want)


def test_backfill_that_stopped_before_its_ledger_adds_nothing_twice(spark, monkeypatch):
    lake = Lake(spark, SF_SMALL)
    feed = lake.bronze_events().schema
    landing, bronze, late = (run_dir(spark, f"t_{x}") for x in ("land", "bronze", "late"))
    _land(spark, landing, feed, [_event(1, "01-05", 1.0), _event(2, "01-06", 2.0)])
    schema = readers.with_lineage(readers.read_jsonl(spark, landing, feed)).schema
    held = readers.with_lineage(readers.read_jsonl(spark, landing, feed)).where("event_id = 1")
    writers.write_parquet(held, bronze)
    sbronze.backfill_late(spark, landing, feed, bronze, late)
    with monkeypatch.context() as m:
        m.setattr(sbronze, "unseen_files", lambda s, landing, ledger: [f for f in spark.read.json(landing).inputFiles()])
        sbronze.backfill_late(spark, landing, feed, bronze, late)
    assert [r.event_id for r in sbronze.read_late(spark, late, schema).collect()] == [2]
    assert len(sbronze.late_runs(spark, late)) == 2
