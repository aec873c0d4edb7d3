"""Work done once: re-exported rows, quantiles at the ends, merges, comparisons; landed text is small."""

import datetime
from unittest import mock

from pyspark.sql import functions as F

from ledgerlake import catalog
from ledgerlake.operators import quantiles
from ledgerlake.operators.fingerprint import compared, differing_rows
from ledgerlake.plans import jobs, serving
from ledgerlake.session import run_dir
from ledgerlake.sources import files, standins, writers
from ledgerlake.streaming import serving as sserving

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_masters_read_their_tables_once(spark):
    _, rows = standins.masters(spark, SF)["billing_monthly"]
    assert plan(rows).count("Relation [") == 2              # orders and lineitem; twice each before
    n = rows.groupBy("invoice_id").count().withColumn("again", F.pmod(F.hash("invoice_id"), F.lit(3)) == 0)
    assert n.where(F.col("count") != F.when(F.col("again"), 2).otherwise(1)).count() == 0
    assert n.where("again").count() and n.where("NOT again").count()


def test_quantiles_at_the_ends_take_one_pass(spark):
    df = spark.createDataFrame([(float(x % 97),) for x in range(500)] + [(None,), (float("inf"),)], "x double")
    with mock.patch.object(quantiles, "_bucket", side_effect=AssertionError("a further pass")):
        assert quantiles.exact_quantiles(df, "x", [1.0, 0.0]) == [96.0, 0.0]
    assert quantiles.exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [0.0, 46.0, 96.0]


def test_compressed_text_lands_in_files_of_some_rows(spark):
    df = spark.range(0, 2500, 1, 1).select(F.concat(F.lit("a line of text "), "id").alias("value"))
    path = run_dir(spark, "text")
    with mock.patch.object(writers, "FILE_ROWS", 1000):
        writers.write_text(df, path, compression=jobs.LANDING)
    names = [n for n in files.names(spark, path) if n.startswith("part-")]
    assert len(names) == 3 and all(n.endswith(".gz") for n in names)
    assert spark.read.text(path).exceptAll(df).count() == 0 and spark.read.text(path).count() == 2500


def test_compared_totals_and_parts(spark):
    a = spark.createDataFrame([("x", 1.25), ("x", 1.25), ("y", None), (None, 3.0)], "d string, v double")
    b = spark.createDataFrame([("x", 1.25), ("y", None), (None, 3.0), ("z", 0.5)], "d string, v double")
    got = compared(a, b, "d", "v")
    assert (got["rows"], got["n"], float(got["total"]), float(got["total_b"])) == (4, 4, 5.5, 4.75)
    assert sorted(got["parts"]) == ["x", "z"]
    assert differing_rows(a, b, "d", got["parts"]).count() == 2
    assert compared(a, b.where("d = 'x'"), None)["parts"] == [None]
    none = compared(a.limit(0), b.limit(0), "d", "v")
    assert (none["rows"], none["n"], none["total"], none["parts"]) == (0, 0, None, [])


def test_a_merge_asks_its_batch_for_folders_only(spark):
    spec = serving.SERVING["tokens_day"]
    day = datetime.date(2024, 1, 3)
    batch = spark.createDataFrame([(1, "o", day, 5, 1.0, 1), (None, None, None, None, None, 1)],
                                  "org_id long, org_name string, usage_date date, total_tokens long,"
                                  " estimated_cost_usd double, load_seq long")
    rows = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b
    table = sserving.snapshot_table(spark, run_dir(spark, "merge_once"), batch.schema, spec)
    sserving.merge_batch(table, batch.mapInArrow(seen, batch.schema), 0, "w", spec)
    assert rows.value == 2 * 2                              # once for the folders, once to write; 3 passes before
    assert sserving.merge_batch(table, batch.limit(0), 1, "w", spec).number == 1
    assert table.read().count() == 2


def test_all_marts_label_the_feed_once(spark):
    with mock.patch.object(catalog.silver, "labelled_events", wraps=catalog.silver.labelled_events) as made:
        rows = {r.mart: r.rows for r in catalog.stream_serving_all_marts(spark, SF).collect()}
    assert made.call_count == 1 and rows["cost_anomaly"] == 0 and rows["daily_usage"] > 0
