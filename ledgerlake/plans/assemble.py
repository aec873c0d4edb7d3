"""Lazy end-to-end plans over the stand-in domain tables of one ``sf_dir``.

These wire sources → silver → gold for the registered queries and the bench.
The stand-in usage feed plays the bronze layer (its ids are unique by
construction, so bronze deduplication is exercised by its own queries).
Nothing is remembered between calls: plans, thresholds and sizes are those of
the files as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import standins
from . import gold, silver

# Spike marking of the silver layer (q, multiplier); of the anomaly mart, whose
# lower quantile flags a handful of events; and one above the greatest cost,
# which flags none (the empty mart).
REFERENCE_SPIKE = (0.99, 3.0)
ANOMALY_SPIKE = (0.90, 3.0)
EMPTY_SPIKE = (1.0, 3.0)


@dataclass
class Lake:
    spark: SparkSession
    sf_dir: str

    # ---------------------------------------------------------- sources
    def orgs(self) -> DataFrame:
        return standins.orgs(self.spark, self.sf_dir)

    def orgs_with_region(self) -> DataFrame:
        return standins.orgs_with_region(self.spark, self.sf_dir)

    def bronze_events(self) -> DataFrame:
        return standins.usage_events(self.spark, self.sf_dir)

    def resources(self) -> DataFrame:
        return standins.resources(self.spark, self.sf_dir)

    def billing(self) -> DataFrame:
        return standins.billing_monthly(self.spark, self.sf_dir)

    def tickets(self) -> DataFrame:
        return standins.support_tickets(self.spark, self.sf_dir)

    # ---------------------------------------------------------- silver
    def labelled(self, spike=REFERENCE_SPIKE, fit_on: str = "all") -> DataFrame:
        q, m = spike if spike else (None, 3.0)
        return silver.labelled_events(self.bronze_events(), spike_q=q, spike_multiplier=m,
                                      fit_on=fit_on)

    def clean_and_quarantine(self, spike=REFERENCE_SPIKE) -> tuple[DataFrame, DataFrame]:
        return quality.split(self.labelled(spike))

    def silver_usage(self, spike=REFERENCE_SPIKE, with_resources: bool = True) -> DataFrame:
        clean, _ = self.clean_and_quarantine(spike)
        return silver.silver_usage(clean, self.orgs(), self.resources() if with_resources else None)

    def silver_tickets(self) -> DataFrame:
        return silver.ticket_features(self.tickets())

    def silver_billing(self) -> DataFrame:
        return silver.revenue_usd(self.billing(), self.orgs())

    # ---------------------------------------------------------- gold
    # Marts are aggregated by key over events that have not been joined to
    # the org master; the attributes are joined onto the (far smaller)
    # aggregate.  The result equals grouping the enriched silver by key +
    # attributes, because the attributes depend on org_id alone.
    def mart(self, silver_frame: DataFrame, mart: gold.Mart) -> DataFrame:
        return gold.with_org_attrs(gold.build(silver_frame, mart), self.orgs(), mart)

    def usage_features(self, spike=None) -> DataFrame:
        """Clean events with the metric pivot, not yet enriched."""
        clean, _ = self.clean_and_quarantine(spike)
        return silver.metric_features(clean)

    def daily_usage_mart(self, features: DataFrame) -> DataFrame:
        return self.mart(features, gold.DAILY_USAGE)

    def gold_daily_usage(self) -> DataFrame:
        # neither the resource join nor the spike flag feeds this mart
        return self.daily_usage_mart(self.usage_features(None))

    def gold_daily_usage_v1(self) -> DataFrame:
        clean, _ = quality.split(silver.labelled_events(self.bronze_events(), spike_q=None,
                                                        defaults=False))
        return self.mart(clean, gold.DAILY_USAGE_V1)

    def gold_revenue_month(self) -> DataFrame:
        clean, _ = quality.split(silver.labelled_billing(self.billing()))
        return self.mart(silver.revenue_amounts(clean), gold.REVENUE_MONTH)

    def gold_cost_anomaly(self, spike=ANOMALY_SPIKE) -> DataFrame:
        return self.mart(self.usage_features(spike), gold.cost_anomaly(*spike))

    def gold_tickets_day(self) -> DataFrame:
        return self.mart(self.silver_tickets(), gold.TICKETS_DAY)

    def gold_tokens_day(self) -> DataFrame:
        return self.mart(self.usage_features(None), gold.tokens_day(standins.GENAI_SERVICE))


def to_ntz(df: DataFrame, cols=("timestamp",)) -> DataFrame:
    """Event times back to TIMESTAMP_NTZ for output (wall clock, UTC session)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols if c in df.columns})
