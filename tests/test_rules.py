"""Rule truth table: labels, first-match order, and the total split."""

import itertools

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerlake.operators import quality
from ledgerlake.operators.dedupe import dedupe_by_key
from ledgerlake.plans.silver import typed_events

SCHEMA = StructType([StructField("event_id", StringType()), StructField("cost_usd_increment", DoubleType()),
                     StructField("value", StringType()), StructField("unit", StringType()),
                     StructField("timestamp", StringType()), StructField("schema_version", StringType()),
                     StructField("carbon_kg", DoubleType()), StructField("genai_tokens", StringType())])


def frame(spark, rows):
    full = [r + ("2024-01-01 00:00:00", None, None, None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return typed_events(df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
                        .withColumn("schema_version", F.col("schema_version").cast("int"))
                        .withColumn("genai_tokens", F.col("genai_tokens").cast("long")))


def expected_label(eid, cost, value, unit):
    try:
        num = float(value) if value is not None else None
    except ValueError:
        num = None
    if eid is None:
        return quality.R1_LABEL
    if cost is not None and cost < -0.01:
        return quality.R2_LABEL
    if num is not None and unit is None:
        return quality.R3_LABEL
    return None


def test_fixture_cases(spark):
    rows = [("e1", 1.0, "2", "h"), (None, -5.0, "2", None), ("e2", -0.02, "2", None),
            ("e3", -0.01, "2", "h"), ("e4", 1.0, "2", None), ("e5", 1.0, "n/a", None),
            ("e6", None, "2", "h"), ("e7", None, "2", None), (None, 1.0, "2", "h"),
            (None, 1.0, "2", "h")]
    want = [None, "R1", "R2", None, "R3", None, None, "R3", "R1", "R1"]
    lab = quality.label(frame(spark, rows), quality.usage_rules())
    got = {(r.event_id, r.cost_usd_increment, r.value, r.unit): r.dq_rule for r in lab.collect()}
    for row, w in zip(rows, want):
        g = got[row]
        assert (g[:2] if g else None) == w, (row, g)


def test_full_truth_table_and_total_split(spark):
    ids, costs, values, units = [None, "x"], [None, -5.0, 1.0], ["2", "n/a"], [None, "h"]
    rows = [(i if i is None else f"{i}{n}", c, v, u)
            for n, (i, c, v, u) in enumerate(itertools.product(ids, costs, values, units))]
    lab = quality.label(frame(spark, rows), quality.usage_rules()).cache()
    for r in lab.collect():
        assert r.dq_rule == expected_label(r.event_id, r.cost_usd_increment, r.value, r.unit)
    clean, quarantine = quality.split(lab)
    assert clean.count() + quarantine.count() == len(rows)
    report = {(r.side, r.dq_rule): r.rows for r in quality.split_report(lab).collect()}
    assert report[("input", None)] == len(rows)
    assert sum(v for (side, _), v in report.items() if side != "input") == len(rows)


def test_numbers_and_times_that_no_mart_can_hold(spark):
    """Clean + quarantine = input, each such row under its label."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", 1.0, "2", "h"), ("b", inf, "2", "h"), ("c", nan, "2", "h"), ("d", 2e10, "2", "h"),
            ("e", 4e-9, "2e10", "h"), ("f", 1.0, "Infinity", "h"), ("g", 1.0, "NaN", "h"),
            ("h", 1e15, "2", "h"), ("i", -inf, "2", "h"), (None, nan, "2", "h")]
    lab = quality.label(frame(spark, rows).withColumn(
        "timestamp", F.when(F.col("event_id") != "a", F.col("timestamp"))), quality.usage_rules())
    got = {r.event_id: r.dq_rule for r in lab.collect()}
    assert got == {"a": quality.TIME_LABEL, "b": quality.RANGE_LABEL, "c": quality.RANGE_LABEL,
                   "d": None, "e": None, "f": quality.RANGE_LABEL, "g": quality.RANGE_LABEL,
                   "h": quality.RANGE_LABEL, "i": quality.R2_LABEL, None: quality.R1_LABEL}
    clean, bad = quality.split(lab)
    assert clean.count() + bad.count() == len(rows)


def test_null_keys_are_not_duplicates(spark):
    rows = [(None, 1.0, "2", "h"), (None, 1.0, "2", "h"), ("a", 1.0, "2", "h"), ("a", 2.0, "2", "h")]
    df = frame(spark, rows).select("event_id", "cost_usd_increment")
    out = dedupe_by_key(df, ["event_id"], order=["cost_usd_increment"]).collect()
    assert sorted((r.event_id or "", r.cost_usd_increment) for r in out) == [
        ("", 1.0), ("", 1.0), ("a", 2.0)]
