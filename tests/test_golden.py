"""Expected values at sf0.01, computed independently during the survey."""

from pyspark.sql import functions as F

from ledgerlake.catalog import REGISTRY
from ledgerlake.operators import quality
from ledgerlake.plans.assemble import Lake

from conftest import SF_MID


def test_rule_counts(spark):
    """The three fixed rules reject what the survey counted; R4 and R5 the rest."""
    lab = Lake(spark, SF_MID).labelled(spike=None)
    counts = {r.dq_rule: r["count"] for r in lab.groupBy("dq_rule").count().collect()}
    assert counts[quality.R1_LABEL] == 104 and counts[quality.R2_LABEL] == 118
    assert counts[quality.R3_LABEL] == 136
    assert counts[quality.RANGE_LABEL] > 100 and counts[quality.TIME_LABEL] > 50
    assert sum(counts.values()) == 10000


def test_mart_sizes(spark):
    assert REGISTRY["mart_revenue_month"](spark, SF_MID).agg(
        F.count_distinct("org_id", "month")).first()[0] == 14060
    assert REGISTRY["mart_tickets_day"](spark, SF_MID).count() == 14989
    assert REGISTRY["dedupe_composite_key"](spark, SF_MID).count() == 45832


def test_every_order_is_an_invoice_and_every_customer_an_org(spark):
    assert REGISTRY["silver_revenue_usd"](spark, SF_MID).count() == 15000
    assert REGISTRY["scan_csv_roundtrip"](spark, SF_MID).count() == 1500


def test_upsert_equals_full_rebuild(spark):
    merged = REGISTRY["upsert_by_key"](spark, SF_MID)
    full = REGISTRY["mart_daily_usage"](spark, SF_MID)
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0
