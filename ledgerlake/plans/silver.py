"""Silver layer: typing, defaults, quality rules, spike flag, enrichment.

All steps are column expressions or joins on one lazy plan; the only eager
work is the spike threshold (a handful of small aggregates, see
``operators.quantiles``), which enters the plan as a literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, to_money, try_double
from ..operators import quality
from ..operators.enrich import left_enrich, left_flag
from ..operators.quantiles import spike_flag, spike_threshold
from ..specs import CORRUPT, SILVER_USAGE_COLUMNS

# ---- fixed values: schema-evolution defaults for v1 events ----------------
DEFAULT_SCHEMA_VERSION = 1
DEFAULT_CARBON_KG = 0.0
DEFAULT_GENAI_TOKENS = 0
# metrics pivoted to their own measure columns
CPU_METRIC = "cpu_hours"
STORAGE_METRIC = "storage_gb_hours"
# ticket severities counted as critical
CRITICAL_SEVERITIES = ("critical", "high")
# ---------------------------------------------------------------------------


def typed_events(bronze: DataFrame, *, defaults: bool = True) -> DataFrame:
    """value text → value_num (unparsable → NULL), event day, v1 defaults."""
    cols = {
        "value_num": try_double("value"),
        "usage_date": F.to_date("timestamp"),
    }
    if defaults:
        cols.update({
            "schema_version": F.coalesce("schema_version", F.lit(DEFAULT_SCHEMA_VERSION)),
            "carbon_kg": F.coalesce("carbon_kg", F.lit(DEFAULT_CARBON_KG)),
            "genai_tokens": F.coalesce("genai_tokens", F.lit(DEFAULT_GENAI_TOKENS).cast("long")),
        })
    return bronze.withColumns(cols)


def labelled_events(bronze: DataFrame, *, spike_q: float | None = 0.99,
                    spike_multiplier: float = 3.0, fit_on: str = "all",
                    defaults: bool = True) -> DataFrame:
    """Typed events with ``dq_rule`` and (unless ``spike_q`` is None) ``cost_spike_flag``.

    ``fit_on='all'`` fits the cost quantile on every event, rejected ones
    included (the reference's behaviour); ``'clean'`` fits it on rows that pass
    the rules.
    """
    typed = typed_events(bronze, defaults=defaults)
    corrupt = CORRUPT if CORRUPT in bronze.columns else None
    out = quality.label(typed, quality.usage_rules(corrupt_col=corrupt))
    if spike_q is not None:
        fit = out if fit_on == "all" else out.filter(F.col("dq_rule").isNull())
        thr = spike_threshold(fit, "cost_usd_increment", spike_q, spike_multiplier)
        out = out.withColumn("cost_spike_flag", spike_flag(thr))
    return out


def metric_features(df: DataFrame) -> DataFrame:
    """cpu_hours / storage_gb_hours = value when the metric matches, else 0.0."""
    return df.withColumns({
        "cpu_hours": F.when(F.col("metric") == CPU_METRIC, F.col("value_num")).otherwise(F.lit(0.0)),
        "storage_gb_hours": F.when(F.col("metric") == STORAGE_METRIC, F.col("value_num"))
                             .otherwise(F.lit(0.0)),
    })


def silver_usage(clean: DataFrame, orgs: DataFrame, resources: DataFrame | None = None,
                 *, orgs_bytes: int | None = None,
                 resources_bytes: int | None = None) -> DataFrame:
    """Clean events ⟕ orgs (name, plan) [⟕ resources], metric pivot, fixed columns."""
    out = left_enrich(clean, orgs, ["org_id"], ["org_name", "plan_tier"], dim_bytes=orgs_bytes)
    # without a spike threshold (marts that do not use it) the flag is absent
    cols = [c for c in SILVER_USAGE_COLUMNS
            if c != "cost_spike_flag" or "cost_spike_flag" in clean.columns]
    if resources is not None:
        out = left_flag(out, resources, ["resource_id", "org_id"], "resource_known",
                        dim_bytes=resources_bytes)
    return metric_features(out).select(*cols)


def ticket_features(tickets: DataFrame) -> DataFrame:
    return tickets.withColumns({
        "ticket_date": F.to_date("created_at"),
        "is_critical": F.coalesce(F.col("severity").isin(*CRITICAL_SEVERITIES), F.lit(False)),
    })


def revenue_amounts(billing: DataFrame) -> DataFrame:
    """(subtotal − credits + taxes) × rate, plus credits/taxes in USD.

    The difference is exact; the product with the whole rate is one double
    multiplication per invoice, so its value does not depend on the order of
    anything, and it is summed as DECIMAL.  Credits and taxes stay in invoice
    currency; ``credits_usd_d`` / ``taxes_usd_d`` are the converted amounts.
    """
    zero = F.lit(0).cast(MONEY)
    cred, tax = (F.coalesce(to_money(c), zero) for c in ("credits", "taxes"))
    net = to_money("subtotal") - cred + tax
    return billing.withColumns({
        name: (amount.cast("double") * F.col("exchange_rate_to_usd")).cast(MONEY)
        for name, amount in (("revenue_usd_d", net), ("credits_usd_d", cred), ("taxes_usd_d", tax))})


def labelled_billing(billing: DataFrame) -> DataFrame:
    """Invoices with ``dq_rule`` for amounts or rates no sum can hold, each alone
    or an amount times the rate."""
    amounts, rate = ["subtotal", "credits", "taxes"], "exchange_rate_to_usd"
    return quality.label(billing, quality.amount_rules(
        [*amounts, rate, *[F.col(a).cast("double") * F.col(rate) for a in amounts]]))


def revenue_usd(billing: DataFrame, orgs: DataFrame, *, orgs_bytes: int | None = None) -> DataFrame:
    """Silver billing: clean invoices' revenue amounts ⟕ orgs (name, plan)."""
    clean, _ = quality.split(labelled_billing(billing))
    return left_enrich(revenue_amounts(clean.drop("dq_rule")), orgs, ["org_id"],
                       ["org_name", "plan_tier"], dim_bytes=orgs_bytes)
