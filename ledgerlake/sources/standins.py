"""Domain tables derived from the benchmark parquet tables.

The landing files of the usage-analytics domain (org master, usage events,
resources, invoices, tickets) are not available at scale, so each one is
derived, deterministically and with plain column expressions, from the
benchmark tables in ``sf_dir``.  Every derivation reads its whole source
table; the modulus tests below do not select subsets, they inject the dirty
rows (missing ids, times, services and units; negative, missing, tiny, huge and
non-finite numbers; text values; unknown orgs) that the quality rules exist
for.

The same derivations are written in SQL in ``ledgerlake.oracle`` for the
independent DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .. import specs
from ..specs import TableSpec, with_id_type

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# ---- fixed values of the derivation (must equal the oracle's) -------------
# event_type -> metric name
METRIC_OF_EVENT_TYPE = {"view": "requests", "click": "cpu_hours", "purchase": "storage_gb_hours"}
# metric -> unit
UNIT_OF_METRIC = {"requests": "count", "cpu_hours": "h", "storage_gb_hours": "gb_h"}
DEFAULT_UNIT = "unit"
# service number k % 4 -> name 's<k%4>'; 's0' plays the GenAI service
GENAI_SERVICE = "s0"
# events before this day carry no schema_version (v1 feed)
SCHEMA_V2_FROM = "2024-01-15"
# order status -> (currency, exchange rate to USD)
CURRENCY_OF_STATUS = {"F": ("USD", "1.00"), "O": ("EUR", "1.10"), "P": ("ARS", "0.0015")}
# order priority -> ticket severity
SEVERITY_OF_PRIORITY = {"1-URGENT": "critical", "2-HIGH": "high", "3-MEDIUM": "medium",
                        "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
# dirty-row injection moduli (on the source row id)
NULL_EVENT_ID_MOD = 97
NULL_COST_MOD = 89
NEGATIVE_COST_MOD = 83
NULL_UNIT_MOD = 71
TEXT_VALUE_MOD = 53
NULL_SERVICE_MOD = 61
NULL_TIME_MOD = 103
INFINITE_VALUE_MOD = 107
NAN_COST_MOD = 109
TINY_COST_MOD = 127
HUGE_COST_MOD = 4001
TINY_COST, HUGE_COST = 4e-9, 2e10
# events whose org the master does not know carry the negated org id
UNKNOWN_ORG_MOD = 29
# landing lines that are cut short, and those with a time that is no time
CUT_LINE_MOD, BAD_TIME_MOD = 101, 113
# events whose id % 10 = 0 are delivered a second time, one day later
REPLAY_MOD = 10
# first day of the event feed; landing files are cut from here
FEED_START = "2024-01-01"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict, default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(default) if default is not None else out


def orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_orgs (enrichment columns): one row per org from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("org_id"), F.col("c_name").alias("org_name"),
                    F.col("c_mktsegment").alias("plan_tier"),
                    (F.col("c_acctbal") >= 5000).alias("is_enterprise"))


def orgs_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_orgs with ``hq_region`` (customer ⋈ nation ⋈ region).

    nation and region are fixed 25- and 5-row tables, so broadcasting them is
    bounded by construction.
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    c = table(spark, sf_dir, "customer")
    return (c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("c_custkey").alias("org_id"), F.col("c_name").alias("org_name"),
                    F.col("c_mktsegment").alias("plan_tier"), F.col("r_name").alias("hq_region"),
                    (F.col("c_acctbal") >= 5000).alias("is_enterprise")))


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """usage_events landing feed from ``events`` (dirty rows injected)."""
    # the JSON field is parsed once (json_tuple: one parse per row), in its
    # own projection, and reused by the derived columns
    e = (table(spark, sf_dir, "events")
         .select("event_id", "ts", "user_id", "event_type", "value",
                 F.json_tuple("props", "k").alias("k_text"))
         .withColumn("k", F.col("k_text").cast("int")))
    rid, k = F.col("event_id"), F.col("k")

    def every(mod: int) -> Column:
        return rid % mod == 0

    metric = _case(F.col("event_type"), METRIC_OF_EVENT_TYPE, F.col("event_type"))
    unit = _case(metric, UNIT_OF_METRIC, F.lit(DEFAULT_UNIT))
    return e.select(
        F.when(~every(NULL_EVENT_ID_MOD), rid).alias("event_id"),
        F.when(~every(NULL_TIME_MOD), F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(every(UNKNOWN_ORG_MOD), -F.col("user_id")).otherwise(F.col("user_id")).alias("org_id"),
        F.col("event_type").alias("resource_id"),
        F.when(~every(NULL_SERVICE_MOD), F.concat(F.lit("s"), (k % 4).cast("string"))).alias("service"),
        F.concat(F.lit("r"), (k % 3).cast("string")).alias("region"),
        metric.alias("metric"),
        F.when(every(TEXT_VALUE_MOD), F.lit("n/a")).when(every(INFINITE_VALUE_MOD), F.lit("Infinity"))
         .otherwise(F.col("value").cast("string")).alias("value"),
        F.when(~every(NULL_UNIT_MOD), unit).alias("unit"),
        F.when(every(NULL_COST_MOD), F.lit(None).cast("double"))
         .when(every(NEGATIVE_COST_MOD), -F.col("value"))
         .when(every(NAN_COST_MOD), F.lit(float("nan")))
         .when(every(TINY_COST_MOD), F.lit(TINY_COST))
         .when(every(HUGE_COST_MOD), F.lit(HUGE_COST))
         .otherwise(F.col("value")).alias("cost_usd_increment"),
        F.when(F.col("ts") >= F.lit(SCHEMA_V2_FROM).cast("timestamp_ntz"), F.lit(2)).alias("schema_version"),
        F.when(k % 5 != 0, k / 1000).alias("carbon_kg"),
        F.when(k % 3 != 0, k.cast("long")).alias("genai_tokens"),
    )


def landing_lines(events: DataFrame, timestamp_format: str) -> DataFrame:
    """The feed as JSON text, with lines cut short and times that are no times."""
    line = F.to_json(F.struct(*events.columns), {"timestampFormat": timestamp_format})
    rid = F.col("event_id")
    return events.select(
        F.when(rid % CUT_LINE_MOD == 0, F.substring(line, 1, 30))
         .when(rid % BAD_TIME_MOD == 0, F.regexp_replace(line, '"timestamp":"[^"]*"',
                                                         '"timestamp":"not a time"'))
         .otherwise(line).alias("value"))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource registry keyed by (resource_id, org_id).

    A (user, event type) pair is a registered resource once it has an event
    with value > 100; created_at is the day of the first such event.  Pairs
    without one stay unregistered, so the composite-key join matches
    partially.
    """
    e = table(spark, sf_dir, "events")
    return (e.filter(F.col("value") > 100)
            .groupBy(F.col("event_type").alias("resource_id"), F.col("user_id").alias("org_id"))
            .agg(F.to_date(F.min("ts")).alias("created_at"))
            .withColumn("state", F.lit("active")))


def billing_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices: one per order, line amounts summed exactly.

    credits = Σ price × discount (NULL when zero), taxes = Σ price × tax,
    month = first day of the order month, currency and rate by order status.
    An order without lines is an invoice of zero.
    The line-item aggregate is partial/final hash aggregation on l_orderkey,
    then joined to orders on the same key.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    # Line amounts are summed as exact integers: prices in cents, discount and
    # tax rates in hundredths, so price × rate is in 1e-4 currency units.
    # Long sums run in Spark's fixed-width hash-aggregation fast path.
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    lines = li.groupBy("l_orderkey").agg(
        F.sum(cents).alias("subtotal_c"),
        F.sum(cents * F.round(F.col("l_discount") * 100).cast("long")).alias("credits_u"),
        F.sum(cents * F.round(F.col("l_tax") * 100).cast("long")).alias("taxes_u"))
    status = F.col("o_orderstatus")
    currency = _case(status, {s: c for s, (c, _) in CURRENCY_OF_STATUS.items()})
    rate = _case(status, {s: r for s, (_, r) in CURRENCY_OF_STATUS.items()}).cast("double")
    return (o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(F.col("o_orderkey").alias("invoice_id"),
                    F.col("o_custkey").alias("org_id"),
                    F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
                    (F.coalesce("subtotal_c", F.lit(0)) / 100).alias("subtotal"),
                    F.when(F.col("credits_u") != 0, F.col("credits_u") / 10000).alias("credits"),
                    (F.coalesce("taxes_u", F.lit(0)) / 10000).alias("taxes"),
                    currency.alias("currency"),
                    rate.alias("exchange_rate_to_usd")))


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets: one per order; severity from priority, SLA and CSAT from status."""
    o = table(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_custkey").alias("org_id"),
        F.col("o_orderstatus").alias("category"),
        _case(F.col("o_orderpriority"), SEVERITY_OF_PRIORITY).alias("severity"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.when(pending, F.lit(None).cast("boolean"))
         .otherwise(F.col("o_orderstatus") == "F").alias("sla_breached"),
        F.when(pending, F.lit(None).cast("double"))
         .otherwise((F.col("o_orderkey") % 5 + 1).cast("double")).alias("csat"),
    )


def customers_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Org master as a raw CSV load would deliver it: every customer once,
    plus a second, differing copy of every third customer (a re-export)."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    copies = (c.filter(F.col("c_custkey") % 3 == 0)
              .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0)))
    return c.unionByName(copies)


def replayed_feed(bronze: DataFrame) -> DataFrame:
    """The usage feed as delivered: every event once, plus a second delivery
    of every event with id % 10 = 0 one day later (``_deliver_at``)."""
    first = bronze.withColumn("_deliver_at", F.col("timestamp"))
    again = (bronze.filter((F.col("event_id") % REPLAY_MOD == 0) & F.col("timestamp").isNotNull())
             .withColumn("_deliver_at", F.col("timestamp") + F.expr("INTERVAL 1 DAY")))
    return first.unionByName(again)


# ------------------------------------------------------------ the seven masters
def _ids(spec: TableSpec) -> TableSpec:
    """The benchmark tables carry numeric ids."""
    return with_id_type(spec, LongType(), tuple(
        c for c in spec.columns if c.endswith("_id") and c != "resource_id"))


def masters(spark: SparkSession, sf_dir: str) -> dict[str, tuple[TableSpec, DataFrame]]:
    """Landing table name → (declared table, rows as an export delivers them)."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    day = F.to_date(F.lit("2020-01-01"))
    none = F.lit(None)
    key = F.col("org_id")
    org = orgs_with_region(spark, sf_dir)
    orgs_ = org.select(
        "org_id", "org_name", F.concat(F.lit("i"), key % 9).alias("industry"), "hq_region",
        "plan_tier", "is_enterprise", F.date_add(day, (key % 900).cast("int")).alias("signup_date"),
        F.concat(F.lit("rep"), key % 20).alias("sales_rep"),
        F.when(key % 4 == 0, "lead").otherwise("customer").alias("lifecycle_stage"),
        F.when(key % 6 != 0, F.concat(F.lit("m"), key % 6)).alias("marketing_source"),
        (key % 11).cast("double").alias("nps_score"))
    ckey = F.col("c_custkey")
    users = c.select(
        ckey.alias("user_id"), ckey.alias("org_id"), F.concat(F.col("c_name"), F.lit("@x")).alias("email"),
        F.when(ckey % 5 == 0, "admin").otherwise("member").alias("role"), (ckey % 3 != 0).alias("active"),
        F.date_add(day, (ckey % 700).cast("int")).alias("created_at"),
        F.when(ckey % 8 != 0, F.date_add(day, (ckey % 1400).cast("int"))).alias("last_login"))
    tickets = support_tickets(spark, sf_dir)
    tickets = tickets.select(
        "ticket_id", "org_id", "category", "severity", "created_at",
        F.when(F.col("sla_breached").isNotNull(), F.col("created_at") + F.expr("INTERVAL 2 DAYS"))
         .alias("resolved_at"), "csat", "sla_breached")
    res = resources(spark, sf_dir).select(
        "resource_id", "org_id", F.concat(F.lit("s"), key % 4).alias("service"),
        F.concat(F.lit("r"), key % 3).alias("region"), "created_at", "state",
        none.cast("string").alias("tags_json"))
    okey = F.col("o_orderkey")
    touches = o.select(
        okey.alias("touch_id"), F.col("o_custkey").alias("org_id"),
        F.concat(F.lit("c"), okey % 12).alias("campaign"),
        F.element_at(F.array(*map(F.lit, ("email", "ads", "event"))), (okey % 3 + 1).cast("int"))
         .alias("channel"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), (okey % 2 == 0).alias("clicked"),
        (okey % 10 == 0).alias("converted"))
    rounds = F.array(*[F.lit(d).cast("date") for d in ("2024-01-15", "2024-02-15")])
    surveys = org.select(
        "org_id", F.explode(rounds).alias("survey_date"), (key % 11).cast("double").alias("nps_score"),
        F.when(key % 2 == 0, "fine").alias("comment"))
    frames = {"customers_orgs": orgs_, "users": users, "billing_monthly": billing_monthly(spark, sf_dir),
              "resources": res, "support_tickets": tickets, "marketing_touches": touches,
              "nps_surveys": surveys}
    out = {}
    for name, df in frames.items():
        spec = _ids(specs.LANDING_TABLES[name])
        if name == "resources":      # the registry is keyed by resource and org
            spec = TableSpec(name, spec.schema, ("resource_id", "org_id"), spec.partition_by)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema])
        # a re-export repeats every third row of a master (each row made once)
        times = F.when(F.pmod(F.hash(*spec.key), F.lit(3)) == 0, 2).otherwise(1)
        out[name] = (spec, df.select("*", F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy"))
    return out
