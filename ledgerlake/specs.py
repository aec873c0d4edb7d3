"""Declared schemas and table specs.

Schemas are declared, never inferred.  Every layer is read back with its
declared schema, so an empty partitioned layer (no Parquet file at all) reads
as zero rows instead of failing schema inference, and partition columns keep
their declared type instead of the type Spark would guess from the path.

Two families live here:

* the landing/source tables of the usage-analytics domain (CSV masters and the
  JSON-lines event feed), with the column names and types of the domain;
* the layer tables the pipeline produces (silver, gold, serving).

Identifier columns are typed by the caller: the domain files carry text ids,
while the stand-in tables derived from the benchmark data carry numeric ids.
The functions in this package never depend on the id type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _schema(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class TableSpec:
    """A table: declared schema, natural key and (optional) partition column."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def with_id_type(spec: TableSpec, id_type: DataType, id_cols: tuple[str, ...]) -> TableSpec:
    """Same table with the given identifier columns retyped."""
    schema = StructType([StructField(f.name, id_type if f.name in id_cols else f.dataType, True)
                         for f in spec.schema.fields])
    return TableSpec(spec.name, schema, spec.key, spec.partition_by)


S, B, D, T, DBL, I, L = (StringType(), BooleanType(), DateType(), TimestampType(),
                         DoubleType(), IntegerType(), LongType())

# Column that keeps the text of a record the reader could not parse.
CORRUPT = "_corrupt_record"

# ---------------------------------------------------------------- landing
# ---- fixed values: names, types, keys and partition columns of the landing files
CUSTOMERS_ORGS = TableSpec("customers_orgs", _schema(
    ("org_id", S), ("org_name", S), ("industry", S), ("hq_region", S), ("plan_tier", S),
    ("is_enterprise", B), ("signup_date", D), ("sales_rep", S), ("lifecycle_stage", S),
    ("marketing_source", S), ("nps_score", DBL)), ("org_id",), ("hq_region",))

USERS = TableSpec("users", _schema(
    ("user_id", S), ("org_id", S), ("email", S), ("role", S), ("active", B),
    ("created_at", D), ("last_login", D)), ("user_id",))

BILLING_MONTHLY = TableSpec("billing_monthly", _schema(
    ("invoice_id", S), ("org_id", S), ("month", D), ("subtotal", DBL), ("credits", DBL),
    ("taxes", DBL), ("currency", S), ("exchange_rate_to_usd", DBL)), ("invoice_id",), ("month",))

RESOURCES = TableSpec("resources", _schema(
    ("resource_id", S), ("org_id", S), ("service", S), ("region", S), ("created_at", D),
    ("state", S), ("tags_json", S)), ("resource_id",), ("service",))

SUPPORT_TICKETS = TableSpec("support_tickets", _schema(
    ("ticket_id", S), ("org_id", S), ("category", S), ("severity", S), ("created_at", T),
    ("resolved_at", T), ("csat", DBL), ("sla_breached", B)), ("ticket_id",), ("severity",))

MARKETING_TOUCHES = TableSpec("marketing_touches", _schema(
    ("touch_id", S), ("org_id", S), ("campaign", S), ("channel", S), ("timestamp", T),
    ("clicked", B), ("converted", B)), ("touch_id",), ("channel",))

NPS_SURVEYS = TableSpec("nps_surveys", _schema(
    ("org_id", S), ("survey_date", D), ("nps_score", DBL), ("comment", S)),
    ("org_id", "survey_date"))

# One superset schema covers both event versions: v2 adds carbon_kg and
# genai_tokens; v1 rows simply carry NULL there.
USAGE_EVENTS = TableSpec("usage_events", _schema(
    ("event_id", S), ("timestamp", T), ("org_id", S), ("resource_id", S), ("service", S),
    ("region", S), ("metric", S), ("value", S), ("unit", S), ("cost_usd_increment", DBL),
    ("schema_version", I), ("carbon_kg", DBL), ("genai_tokens", L)), ("event_id",))

LANDING_TABLES = {t.name: t for t in (CUSTOMERS_ORGS, USERS, BILLING_MONTHLY, RESOURCES,
                                      SUPPORT_TICKETS, MARKETING_TOUCHES, NPS_SURVEYS)}

# ---------------------------------------------------------------- layers
# ---- fixed values: the silver column list and the marts' keys
SILVER_USAGE_COLUMNS = [
    "event_id", "timestamp", "usage_date", "org_id", "org_name", "plan_tier",
    "service", "region", "metric", "value_num", "unit",
    "cost_usd_increment", "schema_version", "carbon_kg", "genai_tokens",
    "cpu_hours", "storage_gb_hours", "cost_spike_flag",
]

GOLD_KEYS = {
    "daily_usage": ("org_id", "usage_date", "service"),
    "daily_usage_v1": ("org_id", "usage_date", "service"),
    "revenue_month": ("org_id", "month"),
    "cost_anomaly": ("org_id", "usage_date", "service"),
    "tickets_day": ("org_id", "ticket_date", "severity"),
    "tokens_day": ("org_id", "usage_date"),
}
