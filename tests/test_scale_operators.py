"""Sketches, fingerprints, the salted join and the split written once."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.catalog import REGISTRY
from ledgerlake.operators import fingerprint, quality, sketches, skew
from ledgerlake.plans import jobs
from ledgerlake.plans.assemble import Lake
from ledgerlake.session import run_dir
from ledgerlake.sources import readers, writers

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantile_sketches_merge_within_their_bound(spark):
    rng = random.Random(4)
    rows = [(k % 10, rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 9), 7.0])) for k in range(60_000)]
    rows += [(3, None), (3, float("nan")), (4, float("inf")), (99, None)]
    df = spark.createDataFrame(rows, "day int, x double")
    path = writers.write_parquet(sketches.sketches(df, "day", "x", "x"), run_dir(spark, "t_sketch"))
    daily = readers.read_parquet(spark, path)
    qs = (0.0, 0.01, 0.5, 0.9, 0.99, 1.0)
    for days in (set(range(10)), {2, 3, 4}, {7}):
        values = sorted(x for d, x in rows if d in days and x is not None and abs(x) < float("inf"))
        got = sketches.quantiles(daily.where(F.col("day").isin(days)), qs).first()
        assert got.n == len(values)
        for i, q in enumerate(qs):
            v = got[f"q{i}"]
            less, upto = sum(x < v for x in values), sum(x <= v for x in values)
            assert less <= (q + sketches.RANK_ERROR) * got.n and upto >= (q - sketches.RANK_ERROR) * got.n
    empty = sketches.quantiles(daily.where("day = 99"), qs).first()
    assert empty.n == 0 and empty.q2 is None
    # one pass: a partial and a final aggregate over one scan
    p = plan(sketches.sketches(readers.read_parquet(spark, writers.write_parquet(df, run_dir(spark, "t_x"))), "day", "x"))
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1


def test_distinct_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 9000).alias("k"))
    daily = sketches.sketches(df.unionByName(df.where("day = 1")), "day", ident="k")
    assert abs(sketches.distinct(daily).first()[0] - 9000) <= sketches.DISTINCT_ERROR * 9000


def test_layer_counts_shuffle_each_id_once(spark):
    p = plan(REGISTRY["layer_counts"](spark, SF_SMALL))
    assert "Expand" not in p and p.count("Exchange hashpartitioning(event_id") == 1


@pytest.mark.parametrize("by", [None, "d"])
def test_fingerprints_tell_multisets(spark, by):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), ("b", 2, None), (None, 3, "z"), (None, 3, "z")]
    schema = "d string, n int, s string"

    def df(r):
        return spark.createDataFrame(r, schema).repartition(3)
    base = df(rows)
    assert fingerprint.differing_parts(base, df(rows[::-1]), by) == []
    assert fingerprint.differing_rows(base, df(rows[::-1]), by).count() == 0
    for other, want in (
            (rows[1:], {("a", 1, "x", 1)}),                # one copy less
            (rows + [("c", 1, "x")], {("c", 1, "x", -1)}),
            ([("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), ("b", None, "2"), *rows[4:]],
             {("b", 2, None, 1), ("b", None, "2", -1)}),   # a NULL in another place
            (rows[:4] + [(None, 3, "z"), (None, 4, "z")], {(None, 3, "z", 1), (None, 4, "z", -1)})):
        got = {tuple(r) for r in fingerprint.differing_rows(base, df(other), by).collect()}
        assert got == want
        if by:
            assert set(fingerprint.differing_parts(base, df(other), by)) == {w[0] for w in want}


def test_salted_join_spreads_a_hot_key(spark):
    """A third of all rows on one key, exact copies among them: no task holds
    three times the median, and the rows are those of a plain join."""
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in confs}
    hot = spark.range(30_000).selectExpr("7L AS k", "id % 5 AS v")
    rest = spark.range(60_000).selectExpr("id % 3000 AS k", "id AS v")
    large = hot.unionByName(rest).unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    small = spark.range(2500).selectExpr("id AS k", "id * 2 AS w")
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        assert skew.heavy_keys(large, "k", 0.02) == {7: 30_020}
        joined = skew.skew_join(large, small, "k", "left")

        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        spread, plain = sizes(joined), sizes(large.join(small, "k", "left"))
        assert spread[-1] < 3 * spread[len(spread) // 2] < plain[-1]
        for how in ("left", "inner"):
            want = large.join(small, "k", how).groupBy("k", "v", "w").count()
            got = skew.skew_join(large, small, "k", how).groupBy("k", "v", "w").count()
            assert fingerprint.differing_parts(want, got) == []
        assert skew.heavy_keys(rest, "k", 0.02) == {}
        with pytest.raises(ValueError):
            skew.skew_join(large, small, "k", "full")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_split_is_written_once(spark):
    labelled = Lake(spark, SF_SMALL).labelled(spike=None)
    (_, clean), (path, bad) = jobs.split_once(labelled, run_dir(spark, "t_split"))
    want = quality.split(labelled)
    for got, w in zip((clean, bad), want):
        assert got.columns == w.columns
        assert fingerprint.differing_parts(got.drop("timestamp"), w.drop("timestamp")) == []
        assert plan(got).count("FileScan") == 1 and "events.parquet" not in plan(got)
    none = labelled.where("dq_rule IS NULL")
    (_, clean), (_, bad) = jobs.split_once(none, run_dir(spark, "t_split"))
    assert bad.count() == 0 and clean.count() == none.count()
