"""Property tests: quantile, dedupe, upsert."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.functions.columns import money_sum, whole_sum
from ledgerlake.operators import quality
from ledgerlake.operators.dedupe import dedupe_by_key
from ledgerlake.operators.enrich import check_unique
from ledgerlake.operators.merge import upsert
from ledgerlake.operators.quantiles import (exact_quantile, exact_quantiles, method_label,
                                            quantile_name)
from ledgerlake.plans import gold, silver
from ledgerlake.plans.assemble import ANOMALY_SPIKE, Lake
from ledgerlake.session import lake_root, run_dir
from ledgerlake.sources import standins


def disc(values, q):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    return v[max(1, math.ceil(q * len(v))) - 1]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantile_matches_sorted(spark, seed):
    rnd = random.Random(seed)
    vals = ([round(rnd.uniform(-50, 500), 2) for _ in range(3000)] + [7.0] * 1000
            + [None] * 50 + [rnd.lognormvariate(0, 4) for _ in range(500)])
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.0, 0.01, 0.5, 0.9, 0.99, 1.0):
        assert exact_quantile(df, "x", q) == disc(vals, q), q


def test_exact_quantiles_together_match_sorted(spark):
    rnd = random.Random(7)
    vals = ([round(rnd.uniform(-50, 500), 2) for _ in range(2000)] + [3.0] * 500
            + [rnd.lognormvariate(0, 5) for _ in range(300)] + [None] * 10)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.5, 0.9, 0.99, 1.0]
    assert exact_quantiles(df, "x", qs) == [disc(vals, q) for q in qs]
    assert exact_quantiles(df.filter("x IS NULL"), "x", [0.5, 0.9]) == [None, None]


def test_exact_quantile_edges(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None
    assert exact_quantile(spark.createDataFrame([(3.5,)], "x double"), "x", 0.99) == 3.5
    same = spark.createDataFrame([(2.0,)] * 10, "x double")
    assert exact_quantile(same, "x", 0.3) == 2.0


def test_exact_quantile_full_double_range(spark):
    """Values spanning the whole double range (no overflow of hi - lo, no
    stall on subnormals) still give the exact order statistic."""
    vals = ([-1.7e308, 1.7e308, 5e-324, -5e-324, 1e-300, 2e-300, 0.0, -0.0] * 3
            + [1.0 + i * 2.0 ** -52 for i in range(20)] + [1e200] * 5)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.0, 0.3, 0.5, 0.8, 1.0):
        assert exact_quantile(df, "x", q) == disc(vals, q), q


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [5, 6])
def test_dedupe_deterministic_and_idempotent(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 30), rnd.choice(["a", "b", None]), rnd.randint(0, 5)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    once = dedupe_by_key(df, ["k"], order=["v"])
    best = {}
    for k, s, v in rows:
        cand = (v, s)
        cur = best.get(k)
        # total order: v first, then s with NULL lowest
        if cur is None or (cand[0], cand[1] is not None, cand[1] or "") > (cur[0], cur[1] is not None, cur[1] or ""):
            best[k] = cand
    assert _rows(once) == sorted((k, s, v) for k, (v, s) in best.items())
    assert _rows(dedupe_by_key(once, ["k"], order=["v"])) == _rows(once)
    shuffled = df.orderBy(F.rand(seed)).repartition(7)
    assert _rows(dedupe_by_key(shuffled, ["k"], order=["v"])) == _rows(once)


def test_upsert_last_write_wins_and_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, s string, v double")
    new = spark.createDataFrame([(2, "B", 20.0), (4, "D", 40.0)], "k int, s string, v double")
    merged = upsert(old, new, ["k"])
    assert _rows(merged) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0), (4, "D", 40.0)]
    assert _rows(upsert(merged, new, ["k"])) == _rows(merged)
    two = spark.createDataFrame([(2, "x", 1.0, 1), (2, "y", 2.0, 2)], "k int, s string, v double, seq int")
    merged2 = upsert(old.withColumn("seq", F.lit(0)), two, ["k"], order=["seq"])
    assert (2, "y", 2.0, 2) in _rows(merged2)


def test_quantile_ends_on_non_finite_values(spark):
    rows = [1.0, 2.0, 3.0, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in rows], "x double")
    assert exact_quantiles(df, "x", [0.5, 1.0]) == [2.0, 3.0]
    only = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    assert exact_quantile(only, "x", 0.5) is None


def test_quantile_names_are_distinct():
    assert [quantile_name(q) for q in (0.5, 0.99, 0.995, 0.999, 1.0)] == ["p50", "p99", "p99.5", "p99.9", "p100"]
    assert method_label(0.995, 3.0) == "p99.5_x3" and method_label(0.9, 2.5) == "p90_x2.5"


def test_thresholds_follow_files_under_the_same_path(spark):
    path = run_dir(spark, "t_sf")
    feed = standins.table(spark, SF_SMALL, "events")
    feed.filter("event_id < 500").write.parquet(f"{path}/events.parquet")
    first = Lake(spark, path).labelled(spike=ANOMALY_SPIKE).count()
    feed.filter("event_id >= 500").write.mode("append").parquet(f"{path}/events.parquet")
    both = Lake(spark, path).labelled(spike=ANOMALY_SPIKE)
    want = Lake(spark, SF_SMALL).labelled(spike=ANOMALY_SPIKE)
    assert first < both.count() == want.count()
    assert both.filter("cost_spike_flag").count() == want.filter("cost_spike_flag").count()


def test_upsert_and_dedupe_take_null_as_a_key(spark):
    old = spark.createDataFrame([(None, "a", 1.0), (2, None, 2.0)], "k int, s string, v double")
    new = spark.createDataFrame([(None, "a", 9.0), (2, None, 8.0), (3, None, 7.0)], "k int, s string, v double")
    merged = upsert(old, new, ["k", "s"])
    got = sorted((tuple(r) for r in merged.collect()), key=repr)
    assert got == sorted((tuple(r) for r in new.collect()), key=repr)
    again = sorted((tuple(r) for r in upsert(merged, new, ["k", "s"]).collect()), key=repr)
    assert again == got
    twice = dedupe_by_key(old.unionByName(new), ["k", "s"], ["v"], null_is_value=True)
    assert sorted((tuple(r) for r in twice.collect()), key=repr) == got
    assert dedupe_by_key(old.unionByName(new), ["k", "s"], ["v"]).count() == 5


def test_money_sums_have_no_value_cap(spark):
    def total(values, scale=3):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
        return df.agg(money_sum("x", scale).alias("s"), whole_sum("x").alias("w")).first()
    assert total([4e-9] * 100_000, 6).s == 0.0004
    assert total([2e10, 1e14, 0.001]).s == 100020000000000.001
    assert total([1e14] * 3).w == 3 * 10 ** 14


def test_whole_sums_end_no_job(spark):
    """Rows that pass the quarantine bound may add up to more than BIGINT holds."""
    df = spark.range(10_000).select((F.col("id") % 2).alias("k"), F.lit(9.9e14).alias("x"))
    df = df.unionByName(spark.createDataFrame([(2, None), (3, 1.5), (4, -9.9e14)], "k long, x double"))
    df = df.unionByName(spark.range(10_000).select(F.lit(5).cast("long").alias("k"), F.lit(-9.9e14).alias("x")))
    got = {r.k: r.w for r in df.groupBy("k").agg(whole_sum("x").alias("w")).collect()}
    top = (1 << 63) - 1
    assert got == {0: 4_950_000_000_000_000_000, 1: 4_950_000_000_000_000_000, 2: None, 3: 1,
                   4: -990_000_000_000_000, 5: -top - 1}
    assert df.where("k < 2").agg(whole_sum("x").alias("w")).first().w == top
    usage = spark.createDataFrame([(1, "d", "s", "requests", 9.9e14)] * 10_000,
                                  "org_id long, usage_date string, service string, metric string, value_num double")
    usage = usage.withColumns({"usage_date": F.lit("2024-01-01").cast("date"), "cost_usd_increment": F.lit(1.0),
                               "cpu_hours": F.lit(0.0), "storage_gb_hours": F.lit(0.0),
                               "genai_tokens": F.lit(1).cast("long"), "carbon_kg": F.lit(0.0)})
    assert gold.build(usage, gold.DAILY_USAGE).first().total_requests == top


def test_invoice_products_out_of_range_are_quarantined(spark):
    rows = [(1e14, None, None, 1e13), (1.0, 1e14, None, 1e13), (1.0, 0.0, 1e14, 1e13), (9e14, 9e14, 9e14, 1.0),
            (1e5, None, None, 9e9)]
    lab = silver.labelled_billing(spark.createDataFrame(
        rows, "subtotal double, credits double, taxes double, exchange_rate_to_usd double"))
    clean, bad = quality.split(lab)
    assert bad.count() == 3
    total = silver.revenue_amounts(clean).agg(F.sum("revenue_usd_d").alias("s")).first().s
    assert float(total) == 9e14 + 9e14


def test_rate_is_not_cut(spark):
    b = spark.createDataFrame([(1e8, None, None, 0.0000392)],
                              "subtotal double, credits double, taxes double, exchange_rate_to_usd double")
    assert float(silver.revenue_amounts(b).first().revenue_usd_d) == 3920.0


def test_amounts_out_of_range_are_quarantined(spark):
    rows = [(1.0, None, 2.0, 1.0), (float("nan"), 0.0, 0.0, 1.0), (1.0, 1e16, 0.0, 1.0),
            (1.0, 0.0, 0.0, float("inf"))]
    lab = silver.labelled_billing(spark.createDataFrame(
        rows, "subtotal double, credits double, taxes double, exchange_rate_to_usd double"))
    clean, bad = quality.split(lab)
    assert (clean.count(), bad.count()) == (1, 3)


def test_check_unique(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (None, "a")], "k int, s string")
    assert check_unique(ok, ["k"]) is ok
    with pytest.raises(ValueError, match="repeated keys"):
        check_unique(ok, ["s"])


def test_no_scratch_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lake_root(Session())
