"""Serving layer: key-addressed tables over Parquet and the user questions.

A wide-column store addresses rows by a partition key plus ordered
clustering columns.  The Parquet equivalent used here is a folder layout plus
sorted files:

* ``period`` = the mart's date column truncated to a coarse grain (month for
  daily marts, year for monthly or sparse ones), then ``bucket_count`` and
  ``key_bucket = pmod(xxhash64(org_id), bucket_count)`` (a folder per org would
  explode into millions of folders at scale).  The count comes from bytes, one
  bucket per ``BUCKET_BYTES``, without a ceiling; it is a folder level of each
  period, so a new period may take a new count while old ones keep theirs, and
  a lookup needs no outside parameter: it compares each folder's bucket with
  the org's bucket for that folder's count;
* rows sorted inside each file by the full primary key, so Parquet row-group
  min/max statistics prune on ``org_id`` and the clustering columns.

A lookup adds the bucket predicate and, when the question has date bounds,
the period range (both partition pruning) to the key and date predicates
(row-group pruning).  An incremental load touches the recent periods only,
so a key-merge rewrites those (period, bucket) folders and leaves the
history alone (see ``streaming.serving``).

Every row carries ``load_seq``, the number of the load that brought it: of two
rows with one key the later load's stays.

The questions (V1–V7) are plain DataFrame queries over a serving table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from ..functions.columns import money_sum
from ..sources import readers
from ..sources.files import bytes_of
from ..sources.writers import write_partitioned

# Parquet bytes of one (period, bucket) folder, about
BUCKET_BYTES = 256 * 1024 * 1024
LOAD_SEQ = "load_seq"
PERIOD = "period"
BUCKET_COUNT = "bucket_count"
BUCKET = "key_bucket"


@dataclass(frozen=True)
class ServingSpec:
    name: str
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...]
    # measures mapped NULL → 0 at the serving edge (others keep NULL)
    zero_if_null: tuple[str, ...] = ()
    # the mart's date column and the folder grain it is truncated to
    time_col: str | None = None
    period_grain: str = "month"

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering

    @property
    def layout(self) -> tuple[str, ...]:
        """Partition folders, outermost first."""
        return ((PERIOD,) if self.time_col else ()) + (BUCKET_COUNT, BUCKET)


# ---- fixed values: names and keys of the serving tables
SERVING = {
    "daily_usage": ServingSpec("org_daily_usage_by_service", ("org_id", "usage_date"), ("service",),
                               ("total_cost_usd", "total_requests", "total_cpu_hours",
                                "total_storage_gb_hours", "total_genai_tokens",
                                "total_carbon_kg", "event_count"), "usage_date", "month"),
    "revenue_month": ServingSpec("revenue_by_org_month", ("org_id",), ("month",),
                                 ("revenue_usd", "total_credits", "total_taxes"), "month", "year"),
    "cost_anomaly": ServingSpec("cost_anomaly_mart", ("org_id", "usage_date"), ("service",),
                                ("spike_event_count", "max_cost_usd", "avg_cost_usd"),
                                "usage_date", "month"),
    "tickets_day": ServingSpec("tickets_by_org_date", ("org_id",), ("ticket_date", "severity"),
                               ("ticket_count", "critical_count", "sla_breach_rate"),
                               "ticket_date", "year"),
    "tokens_day": ServingSpec("genai_tokens_by_org_date", ("org_id",), ("usage_date",),
                              ("total_tokens", "estimated_cost_usd"), "usage_date", "month"),
    "daily_usage_v1": ServingSpec("examen_daily_usage", ("org_id", "usage_date"), ("service",),
                                  ("total_cost_usd", "total_requests", "total_genai_tokens",
                                   "total_carbon_kg", "event_count"), "usage_date", "month"),
}


def key_bucket(org: Column | str, buckets: int | Column) -> Column:
    c = F.col(org) if isinstance(org, str) else org
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(F.xxhash64(c), n).cast("int")


def period_of(day: Column | str, grain: str) -> Column:
    c = F.col(day) if isinstance(day, str) else day
    return F.trunc(c.cast("date"), grain)


def serving_schema(mart_schema: StructType, spec: ServingSpec) -> StructType:
    """The mart's columns, the load number and the layout columns, declared (an
    empty table reads as 0 rows)."""
    extra = [StructField(PERIOD, DateType(), True)] if spec.time_col else []
    fields = [f for f in mart_schema.fields if f.name != LOAD_SEQ]
    return StructType(fields + [StructField(LOAD_SEQ, LongType(), True)] + extra
                      + [StructField(BUCKET_COUNT, IntegerType(), True),
                         StructField(BUCKET, IntegerType(), True)])


def with_layout(df: DataFrame, spec: ServingSpec, buckets: int | Column) -> DataFrame:
    """Layout columns; ``buckets`` may be an expression over ``period``."""
    if spec.time_col:
        df = df.withColumn(PERIOD, period_of(spec.time_col, spec.period_grain))
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    df = df.withColumn(BUCKET_COUNT, n.cast("int"))
    return df.withColumn(BUCKET, key_bucket(spec.partition_key[0], F.col(BUCKET_COUNT)))


def buckets_for(size: int, periods: int = 1) -> int:
    """Org buckets of a period for ``size`` Parquet bytes over ``periods``: a power of two."""
    b = 1
    while b * BUCKET_BYTES * max(1, periods) < size:
        b *= 2
    return b


def null_policy(df: DataFrame, spec: ServingSpec) -> DataFrame:
    """NULL measures → 0 for the listed columns, typed as before; others untouched."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(types[c]))
                           for c in spec.zero_if_null if c in types})


def write_serving(df: DataFrame, path: str, spec: ServingSpec, buckets: int | Column = 1, *,
                  load_seq: int = 0, dynamic: bool = False) -> str:
    """Write a serving table with ``buckets`` org buckets a period (a number, or an
    expression over ``period``)."""
    out = with_layout(null_policy(df, spec).withColumn(LOAD_SEQ, F.lit(load_seq).cast("long")),
                      spec, buckets)
    return write_partitioned(out, path, list(spec.layout), dynamic=dynamic,
                             sort_by=list(spec.primary_key))


def period_buckets(gold: DataFrame, spec: ServingSpec, size: int) -> int | Column:
    """Buckets of each period for ``size`` bytes of gold, dealt to the periods by
    their rows (a count over the date column; no job where one bucket will do)."""
    if not spec.time_col or size <= BUCKET_BYTES:
        return buckets_for(size)
    rows = gold.groupBy(period_of(spec.time_col, spec.period_grain).alias(PERIOD)).count().collect()
    total = sum(r["count"] for r in rows) or 1
    out = F.lit(1)
    for r in rows:                                         # months or years: few
        n = buckets_for(size * r["count"] // total)
        if n > 1:
            out = F.when(F.col(PERIOD).eqNullSafe(F.lit(r[PERIOD])), F.lit(n)).otherwise(out)
    return out


def serve(gold_path: str, mart: DataFrame, path: str, spec: ServingSpec) -> DataFrame:
    """The serving table of a written gold mart, written to ``path`` and opened.

    Buckets come from the bytes of the gold files and the rows of each period.
    ``mart`` gives the schema only.
    """
    spark = mart.sparkSession
    gold = readers.read_parquet(spark, gold_path, mart.schema)
    write_serving(gold, path, spec, period_buckets(gold, spec, bytes_of(spark, gold_path)))
    return readers.read_parquet(spark, path, serving_schema(mart.schema, spec))


def lookup(serving: DataFrame, org_value, org_col: str = "org_id", *,
           date_from: str | None = None, date_to: str | None = None,
           grain: str | None = None) -> DataFrame:
    """Rows of one org; on a serving table the bucket predicate prunes folders,
    and date bounds (with the table's period grain) prune period folders."""
    # the literal takes the column's type: the bucket hash of an INT 11 differs
    # from that of the BIGINT 11 the table was bucketed by
    org = F.lit(org_value).cast(dict(serving.dtypes)[org_col])
    cond = F.col(org_col) == org
    if BUCKET in serving.columns and BUCKET_COUNT in serving.columns:
        bucket = F.pmod(F.xxhash64(org), F.col(BUCKET_COUNT)).cast("int")
        cond = (F.col(BUCKET) == bucket) & cond
    if grain and PERIOD in serving.columns:
        if date_from:
            cond = cond & (F.col(PERIOD) >= period_of(F.lit(date_from), grain))
        if date_to:
            cond = cond & (F.col(PERIOD) <= period_of(F.lit(date_to), grain))
    return serving.filter(cond)


# ------------------------------------------------------------- questions V1–V7
def usage_range(usage: DataFrame, org, date_from: str, date_to: str) -> DataFrame:
    """V1: cost and requests per day and service for one org in [from, to]."""
    return (lookup(usage, org, date_from=date_from, date_to=date_to,
                   grain=SERVING["daily_usage"].period_grain)
            .filter(F.col("usage_date").between(F.lit(date_from).cast("date"),
                                                F.lit(date_to).cast("date")))
            .select("usage_date", "service", "total_cost_usd", "total_requests", "event_count")
            .orderBy("usage_date", "service"))


def top_services(usage: DataFrame, org, date_from: str, date_to: str, n: int = 5) -> DataFrame:
    """V2: the n services with the highest cost for one org in [from, to]."""
    return (lookup(usage, org, date_from=date_from, date_to=date_to,
                   grain=SERVING["daily_usage"].period_grain)
            .filter(F.col("usage_date").between(F.lit(date_from).cast("date"),
                                                F.lit(date_to).cast("date")))
            .groupBy("service")
            .agg(money_sum("total_cost_usd", 4).alias("total_cost_usd"))
            .orderBy(F.desc("total_cost_usd"), F.asc("service"))
            .limit(n))


def critical_tickets(tickets: DataFrame, org, date_from: str, date_to: str,
                     severities=("critical", "high")) -> DataFrame:
    """V3: critical/high ticket counts and SLA breach rate for one org in [from, to]."""
    return (lookup(tickets, org, date_from=date_from, date_to=date_to,
                   grain=SERVING["tickets_day"].period_grain)
            .filter(F.col("severity").isin(*severities))
            .filter(F.col("ticket_date").between(F.lit(date_from).cast("date"),
                                                 F.lit(date_to).cast("date")))
            .select("ticket_date", "severity", "ticket_count", "critical_count", "sla_breach_rate")
            .orderBy("ticket_date", "severity"))


def revenue_history(revenue: DataFrame, org) -> DataFrame:
    """V4: monthly revenue in USD for one org."""
    return (lookup(revenue, org)
            .select("month", "revenue_usd", "total_credits", "total_taxes", "currency")
            .orderBy("month"))


def tokens_by_day(tokens: DataFrame, org, date_from: str) -> DataFrame:
    """V5: GenAI tokens and cost per day for one org from a date on."""
    return (lookup(tokens, org, date_from=date_from, grain=SERVING["tokens_day"].period_grain)
            .filter(F.col("usage_date") >= F.lit(date_from).cast("date"))
            .select("usage_date", "total_tokens", "estimated_cost_usd")
            .orderBy("usage_date"))


def key_lookup(usage_v1: DataFrame, org, day: str) -> DataFrame:
    """V6: every service of one org on one day (full partition key)."""
    return (lookup(usage_v1, org, date_from=day, date_to=day,
                   grain=SERVING["daily_usage_v1"].period_grain)
            .filter(F.col("usage_date") == F.lit(day).cast("date"))
            .select("service", "total_cost_usd", "total_requests", "total_genai_tokens",
                    "event_count")
            .orderBy("service"))


def service_cost_trend(usage_v1: DataFrame, org, service: str, date_from: str,
                       date_to: str) -> DataFrame:
    """V7: daily cost of one service of one org in [from, to] (non-key predicate)."""
    return (lookup(usage_v1, org, date_from=date_from, date_to=date_to,
                   grain=SERVING["daily_usage_v1"].period_grain)
            .filter(F.col("service") == F.lit(service))
            .filter(F.col("usage_date").between(F.lit(date_from).cast("date"),
                                                F.lit(date_to).cast("date")))
            .select("usage_date", "service", "total_cost_usd", "event_count")
            .orderBy("usage_date"))
