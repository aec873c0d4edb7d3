"""Physical-plan properties: pushdown, pruning, hash aggregation, broadcast."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.catalog import REGISTRY
from ledgerlake.operators.enrich import left_enrich
from ledgerlake.operators.merge import KeyedTable
from ledgerlake.plans import serving
from ledgerlake.plans.assemble import Lake
from ledgerlake.session import run_dir
from ledgerlake.sources import readers

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(REGISTRY["scan_parquet_pruned"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,view), GreaterThan(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_marts_use_hash_aggregation_and_broadcast_dims(spark):
    lake = Lake(spark, SF_SMALL)
    for df in (lake.gold_daily_usage(), lake.gold_tokens_day(), lake.gold_daily_usage_v1()):
        p = plan(df)
        assert "SortAggregate" not in p
        assert "BroadcastHashJoin" in p


QUESTIONS = {
    "serve_usage_range": True, "serve_top_services": True, "serve_critical_tickets": True,
    "serve_revenue_history": False, "serve_tokens_by_day": True, "serve_key_lookup": True,
    "serve_service_cost_trend": True}


@pytest.mark.parametrize("name", QUESTIONS)
def test_question_reads_pruned_serving_table_only(spark, name):
    """The org prunes bucket folders, dates prune period folders, and neither
    events, orders nor lineitem is read when the question is asked."""
    p = plan(REGISTRY[name](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "/serving_" in scans[0]
    part = scans[0][scans[0].index("PartitionFilters"):scans[0].index("PushedFilters")]
    assert "key_bucket" in part and "bucket_count" in part
    assert ("period" in part) == QUESTIONS[name]
    assert "EqualTo(org_id,11)" in scans[0]


def _serving(spark, mart):
    path = serving.write_serving(mart, run_dir(spark, "t_serving"), serving.SERVING["daily_usage"], 4)
    return readers.read_parquet(spark, path)


def test_serving_questions_on_serving_table_equal_mart(spark):
    """The questions answer the same over the bucketed serving table (with
    bucket and period pruning) as over the mart."""
    mart = Lake(spark, SF_SMALL).gold_daily_usage()
    org = mart.groupBy("org_id").count().orderBy(F.desc("count"), "org_id").first()[0]
    table = _serving(spark, mart)
    for q in (lambda df: serving.usage_range(df, org, "2024-01-01", "2024-01-15"),
              lambda df: serving.top_services(df, org, "2024-01-05", "2024-01-18"),
              lambda df: serving.lookup(df, org).select(*mart.columns)):
        want = sorted((tuple(r) for r in
                       q(serving.null_policy(mart, serving.SERVING["daily_usage"])).collect()), key=repr)
        assert want
        assert sorted((tuple(r) for r in q(table).collect()), key=repr) == want


@pytest.fixture()
def no_broadcast(spark):
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_upsert_shuffles_the_updates_only(spark, no_broadcast):
    """The table's side is read in its buckets: no exchange above its scan, and
    none before the merged rows are written."""
    p = plan(REGISTRY["upsert_by_key"](spark, SF_SMALL))
    assert sum("FileScan" in line and "events.parquet" in line for line in p.splitlines()) == 1
    held = next(line for line in p.splitlines() if "FileScan" in line and "keyed_" in line)
    assert "Bucketed: true" in held
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "FullOuter" in line)
    table = lines.index(held)
    assert not any("Exchange" in line for line in lines[join:table + 1]) and join < table
    assert sum("Exchange hashpartitioning(_new_key" in line for line in lines) == 1


def test_keyed_merge_writes_without_a_shuffle(spark, no_broadcast):
    rows = [(k, None if k % 5 == 0 else f"a{k % 7}", float(k)) for k in range(200)]
    table = KeyedTable.create(spark.createDataFrame(rows, "k long, s string, v double"),
                              run_dir(spark, "t_keyed"), ["k", "s"], 4)
    new = [(k, s, -v) for k, s, v in rows if k % 3 == 0] + [(1000, None, 1.0), (None, None, 2.0), (None, "", 3.0)]
    updates = spark.createDataFrame(new, "k long, s string, v double")
    merged = table.merge(updates, run_dir(spark, "t_keyed"))
    again = merged.merge(updates, run_dir(spark, "t_keyed"))
    want = {(k, s): v for k, s, v in rows} | {(k, s): v for k, s, v in new}
    for t in (merged, again):
        got = t.frame().collect()
        assert len(got) == len(want) and {(r.k, r.s): r.v for r in got} == want
    assert len(merged.frame().inputFiles()) == 4           # one file a bucket
    last = [(5, None, 1.0, 1), (5, None, 2.0, 2)]
    t2 = KeyedTable.create(spark.createDataFrame([(5, None, 0.0, 0)], "k long, s string, v double, o int"),
                           run_dir(spark, "t_keyed"), ["k", "s"], 2)
    assert [r.v for r in t2.upserted(spark.createDataFrame(last, "k long, s string, v double, o int"), ["o"]).collect()] == [2.0]


def test_dedupe_reads_its_input_once_and_limits_before_the_shuffle(spark):
    p = plan(REGISTRY["dedupe_composite_key"](spark, SF_SMALL))
    assert p.count("FileScan") == 1
    assert "WindowGroupLimit" in p and p.count("Exchange hashpartitioning") == 1


def test_control_totals_parse_the_feed_once(spark):
    p = plan(REGISTRY["gold_control_totals"](spark, SF_SMALL))
    assert not any("FileScan" in line and "events.parquet" in line for line in p.splitlines())


def test_dimension_is_broadcast_by_known_bytes_only(spark):
    fact, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).selectExpr("id AS k", "id AS v")
    with_size = left_enrich(fact, dim, ["k"], ["v"], dim_bytes=1000)
    assert "ResolvedHint" in with_size._jdf.queryExecution().analyzed().toString()
    for size in (None, 10 ** 12):
        out = left_enrich(fact, dim, ["k"], ["v"], dim_bytes=size)
        assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
