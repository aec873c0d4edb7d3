"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the benchmark tables of ``sf_dir`` in full (through the
stand-in derivations) and builds its answer with the library.  Queries that
write (sinks, round trips, streams) write under the session's lake root into
a fresh run folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import money_sum, try_double
from .operators import quality, sketches
from .operators.dedupe import dedupe_by_key
from .operators.enrich import left_enrich, left_flag
from .operators.fingerprint import compared, differing_rows
from .operators.merge import KeyedTable
from .operators.quantiles import exact_quantiles, quantile_name
from .operators.skew import skew_join
from .plans import gold, jobs, partials, serving, silver
from .plans.assemble import ANOMALY_SPIKE, EMPTY_SPIKE, REFERENCE_SPIKE, Lake, to_ntz
from .session import run_dir
from .sources import readers, standins, writers
from .sources.snapshots import SnapshotTable
from .specs import CORRUPT, GOLD_KEYS, USAGE_EVENTS
from .streaming import bronze as sbronze
from .streaming import serving as sserving
from .streaming.landing import file_number, land_files

# ---- fixed query parameters ----------------------------------------------
ORG = 11
V1_RANGE = ("2024-01-01", "2024-01-15")
V2_RANGE = ("2024-01-05", "2024-01-18")
TOP_N = 5
V3_RANGE = ("1995-01-01", "1997-12-31")
V5_FROM = "2024-01-10"
V6_DAY = "2024-01-08"
V7 = ("s2", "2024-01-01", "2024-01-31")
PREVIEW_ROWS = 20
QUANTILES = (0.5, 0.9, 0.99)
# incremental serving load: first load up to (excl.) LOAD1_END, second from LOAD2_START
LOAD1_END = "2024-01-20"
LOAD2_START = "2024-01-15"
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ================================================================= scans / sinks
@query
def scan_parquet_pruned(spark, sf_dir):
    """Only four columns are read and both predicates reach the Parquet scan."""
    return (standins.table(spark, sf_dir, "events")
            .filter((F.col("event_type") == "view") & (F.col("value") > 100))
            .select("event_id", "ts", "user_id", "value"))


@query
def scan_csv_roundtrip(spark, sf_dir):
    """Org master written as CSV with header, read back with declared schema
    and header check (names must match the schema)."""
    orgs = Lake(spark, sf_dir).orgs_with_region()
    path = writers.write_csv(orgs, run_dir(spark, "csv_orgs"))
    return readers.read_csv(spark, path, orgs.schema, check_header=True, mode="FAILFAST")


@query
def scan_jsonl_roundtrip(spark, sf_dir):
    """Usage feed written as JSON lines, read back with the declared schema."""
    ev = Lake(spark, sf_dir).bronze_events()
    path = writers.write_jsonl(ev, run_dir(spark, "jsonl_events"))
    return to_ntz(readers.read_jsonl(spark, path, ev.schema))


@query
def sink_parquet_overwrite(spark, sf_dir):
    """Quarantine written (overwrite, unpartitioned) and read back."""
    _, quarantine = quality.split(Lake(spark, sf_dir).labelled(spike=None))
    path = writers.write_parquet(quarantine, run_dir(spark, "quarantine"))
    return to_ntz(readers.read_parquet(spark, path, quarantine.schema))


@query
def sink_partitioned_overwrite(spark, sf_dir):
    """Daily-usage mart written partitioned by day, read back declared."""
    mart = Lake(spark, sf_dir).gold_daily_usage()
    path = writers.write_partitioned(mart, run_dir(spark, "gold_usage"), "usage_date")
    return readers.read_parquet(spark, path, mart.schema)


@query
def lineage_columns(spark, sf_dir):
    """Ingestion time and source file on every bronze row."""
    bronze = readers.with_lineage(standins.table(spark, sf_dir, "customer"))
    return bronze.select(
        "c_custkey", "c_name",
        F.regexp_extract("source_file", r"([^/]+)$", 1).alias("source_name"),
        F.col("ingest_ts").isNotNull().alias("has_ingest_ts"))


@query
def layer_size_report(spark, sf_dir):
    """Bytes and MB per layer, from the file listing (no content read).
    The layers are written as uncompressed text, so the bytes are known."""
    lake = Lake(spark, sf_dir)
    _, quarantine = quality.split(lake.labelled(spike=None))
    layers = {
        "bronze": F.concat_ws("|", "event_id", "org_id", "service", "metric", "value", "unit")
                   .alias("line"),
        "quarantine": F.concat_ws("|", "dq_rule", "event_id", "org_id", "value").alias("line"),
        "gold": F.concat_ws("|", "org_id", "usage_date", "service", "event_count").alias("line"),
    }
    frames = {"bronze": lake.bronze_events(), "quarantine": quarantine,
              "gold": lake.gold_daily_usage()}
    return writers.layer_sizes(spark, {
        name: writers.write_text(frames[name].select(line), run_dir(spark, name))
        for name, line in layers.items()})


@query
def empty_mart_safe(spark, sf_dir):
    """No cost passes three times the greatest, so this anomaly mart is
    empty; writing and reading it back with its declared schema gives zero rows,
    not an error."""
    mart = Lake(spark, sf_dir).gold_cost_anomaly(EMPTY_SPIKE)
    path = writers.write_partitioned(mart, run_dir(spark, "gold_anomaly"), "usage_date")
    return readers.read_parquet(spark, path, mart.schema)


# ================================================================= projections / rules
@query
def value_try_cast(spark, sf_dir):
    ev = Lake(spark, sf_dir).bronze_events()
    return ev.select("event_id", "value", try_double("value").alias("value_num"))


@query
def schema_defaults(spark, sf_dir):
    typed = silver.typed_events(Lake(spark, sf_dir).bronze_events())
    return typed.select("event_id", "schema_version", "carbon_kg", "genai_tokens")


@query
def silver_usage_features(spark, sf_dir):
    s = Lake(spark, sf_dir).silver_usage(spike=None, with_resources=False)
    return to_ntz(s.select("event_id", "timestamp", "usage_date",
                           F.date_format("usage_date", "yyyy-MM-dd").alias("usage_day"),
                           "metric", "value_num", "cpu_hours", "storage_gb_hours"))


@query
def project_silver_columns(spark, sf_dir):
    """The full silver projection (p99 × 3 flag, resource join)."""
    return to_ntz(Lake(spark, sf_dir).silver_usage(REFERENCE_SPIKE, with_resources=True))


@query
def dq_rule_label(spark, sf_dir):
    lab = Lake(spark, sf_dir).labelled(spike=None)
    return lab.select("event_id", "cost_usd_increment", "value", "unit", "dq_rule")


@query
def dq_split_total(spark, sf_dir):
    return quality.split_report(Lake(spark, sf_dir).labelled(spike=None))


@query
def quarantine_preview(spark, sf_dir):
    """T4: first rows of the quarantine under a total order."""
    _, quarantine = quality.split(Lake(spark, sf_dir).labelled(spike=None))
    cols = ["dq_rule", "timestamp", "org_id", "resource_id", "event_id", "value", "unit",
            "cost_usd_increment"]
    return to_ntz(quarantine.select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols])
                  .limit(PREVIEW_ROWS))


@query
def cost_quantiles(spark, sf_dir):
    """Exact p50/p90/p99 of the finite costs of every event, with count/min/max."""
    typed = silver.typed_events(Lake(spark, sf_dir).bronze_events())
    values = exact_quantiles(typed, "cost_usd_increment", QUANTILES)
    qs = {quantile_name(q): v for q, v in zip(QUANTILES, values)}
    finite = typed.filter(F.abs("cost_usd_increment") < F.lit(float("inf")))
    return finite.agg(F.count("cost_usd_increment").alias("n"),
                     F.min("cost_usd_increment").alias("min_cost"),
                     F.max("cost_usd_increment").alias("max_cost")).select(
        "n", "min_cost", "max_cost",
        *[F.lit(v).cast("double").alias(k) for k, v in qs.items()])


# a range of days whose sketches are merged, next to all of them
SKETCH_RANGE = ("2024-01-08", "2024-01-21")


@query
def cost_quantiles_sketch(spark, sf_dir):
    """p50/p90/p99 of all days and of a range of days from one sketch a day,
    written in one pass and merged; each value's true rank is counted and must lie
    within the sketch's bound."""
    typed = silver.typed_events(Lake(spark, sf_dir).bronze_events()).select("usage_date", "cost_usd_increment")
    path = writers.write_parquet(sketches.sketches(typed, "usage_date", "cost_usd_increment"),
                                 run_dir(spark, "cost_sketches"))
    daily = readers.read_parquet(spark, path)
    first, last = (F.lit(d).cast("date") for d in SKETCH_RANGE)
    scopes = {"all": F.lit(True), "range": F.col("usage_date").between(first, last)}
    x, out = sketches.finite("cost_usd_increment"), None
    for scope, days in scopes.items():
        got = sketches.quantiles(daily.where(days), QUANTILES).first()
        ranks = typed.where(days).agg(
            F.count(x).alias("n"),
            *[F.count_if(x < F.lit(got[f"q{i}"])).alias(f"less{i}") for i in range(len(QUANTILES))],
            *[F.count_if(x <= F.lit(got[f"q{i}"])).alias(f"upto{i}") for i in range(len(QUANTILES))])
        err = sketches.RANK_ERROR
        rows = F.explode(F.array(*[F.struct(
            F.lit(quantile_name(q)).alias("quantile"),
            ((F.col(f"less{i}") <= (q + err) * F.col("n")) & (F.col(f"upto{i}") >= (q - err) * F.col("n"))).alias("within_bound"))
            for i, q in enumerate(QUANTILES)]))
        one = ranks.select(F.lit(scope).alias("scope"), "n", rows.alias("r")).select(
            "scope", "r.quantile", F.col("n"), F.lit(got["n"]).cast("long").alias("sketch_n"), "r.within_bound")
        out = one if out is None else out.unionByName(one)
    return out


@query
def distinct_ids_sketch(spark, sf_dir):
    """K3/Q10: distinct event ids of all days and of a range of days from one
    sketch a day, merged, against the exact count."""
    typed = silver.typed_events(Lake(spark, sf_dir).bronze_events()).select("usage_date", "event_id")
    path = writers.write_parquet(sketches.sketches(typed, "usage_date", ident="event_id"), run_dir(spark, "id_sketches"))
    daily = readers.read_parquet(spark, path)
    first, last = (F.lit(d).cast("date") for d in SKETCH_RANGE)
    out = None
    for scope, days in {"all": F.lit(True), "range": F.col("usage_date").between(first, last)}.items():
        got = sketches.distinct(daily.where(days)).first().distinct_ids or 0
        one = typed.where(days).agg(F.count_distinct("event_id").alias("distinct_ids")).select(
            F.lit(scope).alias("scope"), "distinct_ids",
            (F.abs(F.lit(got) - F.col("distinct_ids")) <= sketches.DISTINCT_ERROR * F.col("distinct_ids")).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def cost_spike_flag(spark, sf_dir):
    lab = Lake(spark, sf_dir).labelled(spike=ANOMALY_SPIKE)
    return lab.select("event_id", "cost_usd_increment", "dq_rule", "cost_spike_flag")


@query
def cost_spike_flag_clean_fit(spark, sf_dir):
    """Q3: the threshold fitted on rows that pass the rules only."""
    lab = Lake(spark, sf_dir).labelled(spike=ANOMALY_SPIKE, fit_on="clean")
    return lab.select("event_id", "dq_rule", "cost_spike_flag")


@query
def corrupt_rows_quarantine(spark, sf_dir):
    """Landing lines cut short or with a time that is no time reach the
    quarantine with their text; rows and characters per label."""
    lake = Lake(spark, sf_dir)
    schema = lake.bronze_events().schema
    landing = writers.write_text(
        standins.landing_lines(lake.bronze_events(), writers.JSON_TIMESTAMP_FORMAT),
        run_dir(spark, "landing_lines"))
    bronze = jobs.bronze_lines(spark, landing, schema, run_dir(spark, "bronze_lines"))
    lab = silver.labelled_events(bronze, spike_q=None)
    return lab.groupBy("dq_rule").agg(F.count("*").alias("rows"),
                                      F.sum(F.length(CORRUPT)).alias("corrupt_chars"))


# ================================================================= joins
@query
def enrich_left_join(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    clean, _ = quality.split(lake.labelled(spike=None))
    out = left_enrich(clean, lake.orgs(), ["org_id"], ["org_name", "plan_tier"])
    return to_ntz(out.select("event_id", "timestamp", "org_id", "org_name", "plan_tier"))


@query
def enrich_skew_join(spark, sf_dir):
    """J1 on a shuffled join: orgs that hold more than a set share of the events
    are salted, whatever the size of the org master."""
    lake = Lake(spark, sf_dir)
    orgs = lake.orgs().select("org_id", "org_name", "plan_tier")
    events = lake.bronze_events().select("event_id", "org_id", "service", "cost_usd_increment")
    return skew_join(events, orgs, "org_id", "left", share=SKEW_SHARE)


@query
def enrich_composite_key(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    out = left_flag(lake.bronze_events(), lake.resources(), ["resource_id", "org_id"],
                    "resource_known")
    return to_ntz(out.select("event_id", "timestamp", "org_id", "resource_id", "resource_known"))


@query
def silver_revenue_usd(spark, sf_dir):
    b = Lake(spark, sf_dir).silver_billing()
    return b.select("invoice_id", "org_id", "month", "org_name", "plan_tier", "currency",
                    "subtotal", "credits", "taxes", "exchange_rate_to_usd",
                    F.round("revenue_usd_d", 8).cast("double").alias("revenue_usd"))


@query
def ticket_features(spark, sf_dir):
    t = Lake(spark, sf_dir).silver_tickets()
    return to_ntz(t.select("ticket_id", "org_id", "severity", "created_at", "ticket_date",
                           "is_critical", "sla_breached", "csat"), ("created_at",))


def _two_loads(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """The daily usage mart of the first and of the (overlapping) second load."""
    ev = lake.usage_features(None)
    return (lake.daily_usage_mart(ev.filter(F.col("timestamp") < F.lit(LOAD1_END).cast("timestamp"))),
            lake.daily_usage_mart(ev.filter(F.col("timestamp") >= F.lit(LOAD2_START).cast("timestamp"))))


# an org with more than this share of the events is salted
SKEW_SHARE = 0.002
# buckets of the stand-in mart's keyed table (one per 256 MB of the mart at scale)
KEYED_BUCKETS = 4


@query
def upsert_by_key(spark, sf_dir):
    """Second load replaces the first by primary key; untouched keys stay.
    The first lies bucketed by its key, so only the second is shuffled."""
    first, second = _two_loads(Lake(spark, sf_dir))
    held = KeyedTable.create(first, run_dir(spark, "keyed_usage"), GOLD_KEYS["daily_usage"], KEYED_BUCKETS)
    return held.upserted(second)


# ================================================================= dedupe
@query
def dedupe_natural_key(spark, sf_dir):
    raw = standins.customers_with_copies(spark, sf_dir)
    return dedupe_by_key(raw, ["c_custkey"], order=["c_acctbal"])


@query
def dedupe_composite_key(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    return dedupe_by_key(li, ["l_orderkey", "l_linenumber"])


# ================================================================= marts
@query
def mart_daily_usage(spark, sf_dir):
    return Lake(spark, sf_dir).gold_daily_usage()


@query
def mart_daily_usage_v1(spark, sf_dir):
    return Lake(spark, sf_dir).gold_daily_usage_v1()


@query
def mart_revenue_month(spark, sf_dir):
    return Lake(spark, sf_dir).gold_revenue_month()


@query
def mart_cost_anomaly(spark, sf_dir):
    return Lake(spark, sf_dir).gold_cost_anomaly(ANOMALY_SPIKE)


@query
def mart_tickets_day(spark, sf_dir):
    return Lake(spark, sf_dir).gold_tickets_day()


@query
def mart_tokens_by_day(spark, sf_dir):
    return Lake(spark, sf_dir).gold_tokens_day()


# ================================================================= checks
@query
def layer_counts(spark, sf_dir):
    """Rows and distinct ids per layer: one aggregate by id over the
    labelled feed (each id is shuffled once, with its rows on either side), and one
    over the mart."""
    lake = Lake(spark, sf_dir)
    good = F.col("dq_rule").isNull()
    ids = lake.labelled(spike=None).groupBy("event_id").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    known = F.col("event_id").isNotNull()
    totals = ids.agg(F.sum("good").alias("g"), F.sum("bad").alias("b"), F.count("event_id").alias("ids"),
                     F.count_if(known & (F.col("good") > 0)).alias("g_ids"),
                     F.count_if(known & (F.col("bad") > 0)).alias("b_ids"))

    def row(layer, rows, distinct):
        return F.struct(F.lit(layer).alias("layer"), rows.alias("rows"), distinct.alias("distinct_ids"))
    none = F.lit(0).cast("long")
    g, b = F.coalesce("g", none), F.coalesce("b", none)
    feed = totals.select(F.explode(F.array(row("bronze", g + b, F.col("ids")), row("silver", g, F.col("g_ids")),
                                           row("quarantine", b, F.col("b_ids")))).alias("r")).select("r.*")
    mart = lake.gold_daily_usage().agg(F.count("*").alias("rows")).select(
        F.lit("gold_usage").alias("layer"), "rows", F.lit(None).cast("long").alias("distinct_ids"))
    return feed.unionByName(mart)


# the columns of clean events that the usage marts read
USAGE_MART_COLUMNS = ["org_id", "usage_date", "service", "metric", "value_num", "cost_usd_increment",
                      "carbon_kg", "genai_tokens"]


def _with_defaults(v1: DataFrame) -> DataFrame:
    """Clean events without defaults, as the final's marts read them."""
    return silver.metric_features(v1.withColumns(
        {"carbon_kg": F.coalesce("carbon_kg", F.lit(silver.DEFAULT_CARBON_KG)),
         "genai_tokens": F.coalesce("genai_tokens", F.lit(silver.DEFAULT_GENAI_TOKENS).cast("long"))}))


def _usage_marts(spark, lake: Lake) -> dict[str, DataFrame]:
    """The three usage marts (no flag) of one labelled pass: clean events are
    written once and read by each."""
    clean, _ = quality.split(silver.labelled_events(lake.bronze_events(), spike_q=None,
                                                    defaults=False))
    cols = USAGE_MART_COLUMNS
    path = writers.write_parquet(clean.select(*cols), run_dir(spark, "usage_clean"))
    v1 = readers.read_parquet(spark, path, clean.select(*cols).schema)
    v2 = _with_defaults(v1)
    return {"daily_usage": lake.mart(v2, gold.DAILY_USAGE),
            "daily_usage_v1": lake.mart(v1, gold.DAILY_USAGE_V1),
            "tokens_day": lake.mart(v2, gold.tokens_day(standins.GENAI_SERVICE))}


# the measure each mart is reconciled on
CONTROL_MEASURE = {m.name: m.control for m in (
    gold.DAILY_USAGE, gold.DAILY_USAGE_V1, gold.REVENUE_MONTH, gold.TICKETS_DAY,
    gold.cost_anomaly(*REFERENCE_SPIKE), gold.tokens_day(standins.GENAI_SERVICE))}


@query
def gold_control_totals(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    marts = {**_usage_marts(spark, lake), "revenue_month": lake.gold_revenue_month(),
             "tickets_day": lake.gold_tickets_day()}
    return gold.control_totals({n: (df, CONTROL_MEASURE[n]) for n, df in marts.items()})


@query
def gold_reproducibility(spark, sf_dir):
    """Q9: gold built twice from one silver into two folders: rows and control
    total of each build, and the rows in which they differ, per mart."""
    layers = jobs.build_layers(spark, Lake(spark, sf_dir), run_dir(spark, "lake"))
    marts = jobs.build_gold(spark, layers, prefix="gold_again")
    out = None
    for name, mart in marts.items():
        a, b = (layers.read(spark, f"{p}/{name}") for p in ("gold", "gold_again"))

        # fingerprints per partition, with the totals in the same pass; rows are
        # compared only where fingerprints differ
        by = GOLD_PARTITION.get(name)
        both = compared(a, b, by, mart.control)
        totals = spark.createDataFrame([("first", both["rows"], both["total"]), ("second", both["n"], both["total_b"])],
                                       "side string, rows long, total decimal(38,12)") \
            .withColumn("total", F.round("total", 2).cast("double"))
        differ = (differing_rows(a, b, by, both["parts"]).agg(F.count("*").alias("rows"))
                  .withColumn("side", F.lit("differing")))
        sides = totals.unionByName(differ, allowMissingColumns=True)
        one = sides.select(F.lit(name).alias("mart"), "side", "rows", "total")
        out = one if out is None else out.unionByName(one)
    return out


# ================================================================= serving
def serving_table(spark, mart: DataFrame, name: str) -> DataFrame:
    """The mart written to gold, its serving table built from that and opened.
    Questions read this table only."""
    gold_path = writers.write_parquet(mart, run_dir(spark, f"gold_{name}"))
    return serving.serve(gold_path, mart, run_dir(spark, f"serving_{name}"), serving.SERVING[name])


@query
def serve_usage_range(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_daily_usage(), "daily_usage")
    return serving.usage_range(table, ORG, *V1_RANGE)


@query
def serve_top_services(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_daily_usage(), "daily_usage")
    return serving.top_services(table, ORG, *V2_RANGE, n=TOP_N)


@query
def serve_critical_tickets(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_tickets_day(), "tickets_day")
    return serving.critical_tickets(table, ORG, *V3_RANGE)


@query
def serve_revenue_history(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_revenue_month(), "revenue_month")
    return serving.revenue_history(table, ORG)


@query
def serve_tokens_by_day(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_tokens_day(), "tokens_day")
    return serving.tokens_by_day(table, ORG, V5_FROM)


@query
def serve_key_lookup(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_daily_usage_v1(), "daily_usage_v1")
    return serving.key_lookup(table, ORG, V6_DAY)


@query
def serve_service_cost_trend(spark, sf_dir):
    table = serving_table(spark, Lake(spark, sf_dir).gold_daily_usage_v1(), "daily_usage_v1")
    return serving.service_cost_trend(table, ORG, *V7)


@query
def serving_null_policy(spark, sf_dir):
    """NULL measures → 0 at the serving edge (the mart keeps them NULL)."""
    return serving.null_policy(Lake(spark, sf_dir).gold_daily_usage(),
                               serving.SERVING["daily_usage"])


@query
def serving_layout_sorted(spark, sf_dir):
    """Gold written, then the serving table built from it (period and
    org-bucket folders, sorted by primary key) and read back."""
    mart = Lake(spark, sf_dir).gold_daily_usage()
    return serving_table(spark, mart, "daily_usage").select(*mart.columns)


# ================================================================= streaming
LATE_DAYS_PER_FILE = 5
# the group of days 11-15 arrives last, when the feed has moved past it
LATE_GROUP = 2
# state-store partitions of the stream queries' checkpoints, which hold a month
# of the stand-in feed at most
STATE_PARTITIONS = 8


def _event_schema(lake: Lake):
    return lake.bronze_events().schema


def _land_replayed_feed(spark, lake: Lake) -> str:
    """Daily JSON-lines files (plus next-day re-deliveries), oldest first."""
    landing = run_dir(spark, "landing_events")
    feed = standins.replayed_feed(lake.bronze_events())
    land_files(feed, landing, file_number("_deliver_at", standins.FEED_START, 1),
               drop=("_deliver_at",))
    return landing


def _bronze_schema(lake: Lake):
    from pyspark.sql.types import StringType, StructField, StructType, TimestampType
    return StructType(list(_event_schema(lake).fields) + [
        StructField("ingest_ts", TimestampType(), True),
        StructField("source_file", StringType(), True)])


def _stream_to_bronze(spark, lake: Lake, landing: str, out: str | None = None,
                      ckpt: str | None = None, **kw) -> sbronze.StreamRun:
    out = out or run_dir(spark, "bronze_events")
    ckpt = ckpt or run_dir(spark, "ckpt_bronze")
    return sbronze.run_bronze_stream(spark, landing, _event_schema(lake), out, ckpt,
                                     state_partitions=STATE_PARTITIONS, **kw)


@query
def stream_bronze_dedupe(spark, sf_dir):
    """File stream (10 files a trigger), lineage, 2-day watermark,
    bounded-state dedupe by id, Parquet append; re-deliveries removed."""
    lake = Lake(spark, sf_dir)
    run = _stream_to_bronze(spark, lake, _land_replayed_feed(spark, lake))
    bronze = readers.read_parquet(spark, run.output, _bronze_schema(lake))
    return to_ntz(bronze.select(*USAGE_EVENTS.columns))


@query
def stream_rerun_idempotent(spark, sf_dir):
    """A second run on the same checkpoint reads no file and adds no row."""
    lake = Lake(spark, sf_dir)
    landing = _land_replayed_feed(spark, lake)
    first = _stream_to_bronze(spark, lake, landing)
    rows_first = readers.read_parquet(spark, first.output, _bronze_schema(lake)).count()
    again = _stream_to_bronze(spark, lake, landing, first.output, first.checkpoint)
    bronze = readers.read_parquet(spark, first.output, _bronze_schema(lake))
    return bronze.agg(F.count("*").alias("rows_after_rerun"),
                      F.count_distinct("event_id").alias("distinct_ids")).select(
        "rows_after_rerun", "distinct_ids",
        F.lit(rows_first).cast("long").alias("rows_after_first"),
        F.lit(again.batches).cast("long").alias("rerun_batches"))


@query
def stream_rebuild_equals_batch(spark, sf_dir):
    """A rebuild into a fresh output + checkpoint equals the batch dedupe."""
    lake = Lake(spark, sf_dir)
    landing = _land_replayed_feed(spark, lake)
    run = _stream_to_bronze(spark, lake, landing)
    stream = readers.read_parquet(spark, run.output, _bronze_schema(lake))
    batch = dedupe_by_key(readers.read_jsonl(spark, landing, _event_schema(lake)), ["event_id"])

    def per_day(df, tag):
        return (df.groupBy(F.to_date("timestamp").alias("usage_date"))
                .agg(F.count("*").alias(f"{tag}_rows"),
                     F.count_distinct("event_id").alias(f"{tag}_ids"),
                     money_sum(F.nanvl("cost_usd_increment", F.lit(None).cast("double")), 2)
                      .alias(f"{tag}_cost"))
                .withColumnRenamed("usage_date", f"{tag}_date"))
    return (per_day(stream, "stream")
            .join(per_day(batch, "batch"), F.col("stream_date").eqNullSafe(F.col("batch_date")), "full")
            .withColumn("usage_date", F.coalesce("stream_date", "batch_date"))
            .drop("stream_date", "batch_date"))


@query
def stream_serving_upsert(spark, sf_dir):
    """The gold files of two overlapping loads streamed into the
    serving table by foreachBatch key-merge; the later load's rows stay."""
    gold_dir = run_dir(spark, "gold_loads")
    loads = _two_loads(Lake(spark, sf_dir))
    for n, mart in enumerate(loads, start=1):
        (mart.withColumn(serving.LOAD_SEQ, F.lit(n).cast("long")).coalesce(4)
         .write.mode("append").parquet(gold_dir))
    path, spec, schema = run_dir(spark, "serving_usage"), serving.SERVING["daily_usage"], loads[0].schema
    sserving.run_serving_stream(spark, gold_dir, schema, path, run_dir(spark, "ckpt_serving"), spec,
                                files_per_trigger=3)
    table = sserving.snapshot_table(spark, path, schema, spec)
    sserving.compact(table, spec)                         # bucket counts that the periods' bytes ask for
    return table.read().select(*schema.fieldNames())


# gold partition column per mart, as the materialised build writes them
GOLD_PARTITION = {"daily_usage": "usage_date", "revenue_month": "month",
                  "cost_anomaly": "usage_date", "tokens_day": "usage_date"}
SERVING_FILES_PER_TRIGGER = 100
# what the usage marts read of silver
USAGE_FEATURES = ("org_id", "usage_date", "service", "metric", "value_num", "cost_usd_increment", "cpu_hours",
                  "storage_gb_hours", "genai_tokens", "carbon_kg", "cost_spike_flag")


@query
def stream_serving_all_marts(spark, sf_dir):
    """The five gold marts, written partitioned by date and each
    streamed into its own serving table by ``foreachBatch`` key-merge, one
    checkpoint per target, the five streams running at once.  The anomaly mart
    is empty: its stream merges nothing and its table reads back as zero rows.
    Rows and a control total per serving table."""
    lake = Lake(spark, sf_dir)
    root = run_dir(spark, "serving_all")
    # the feed is read and labelled once for the three marts built from it
    clean = lake.usage_features(EMPTY_SPIKE).select(*USAGE_FEATURES)
    writers.write_parquet(clean, f"{root}/silver")
    usage = readers.read_parquet(spark, f"{root}/silver", clean.schema)
    marts = {"daily_usage": lake.daily_usage_mart(usage),
             "revenue_month": lake.gold_revenue_month(),
             "cost_anomaly": lake.mart(usage, gold.cost_anomaly(*EMPTY_SPIKE)),
             "tickets_day": lake.gold_tickets_day(),
             "tokens_day": lake.mart(usage, gold.tokens_day(standins.GENAI_SERVICE))}
    running = []
    for name, mart in marts.items():
        gold_dir, rows = f"{root}/gold/{name}", mart.withColumn(serving.LOAD_SEQ, F.lit(1).cast("long"))
        if name in GOLD_PARTITION:
            writers.write_partitioned(rows, gold_dir, GOLD_PARTITION[name])
        else:
            writers.write_parquet(rows, gold_dir)
        q, _ = sserving.start_serving_stream(
            spark, gold_dir, mart.schema, f"{root}/serving/{name}", f"{root}/ckpt/{name}",
            serving.SERVING[name], files_per_trigger=SERVING_FILES_PER_TRIGGER)
        running.append(q)
    for q in running:
        q.awaitTermination()
    return gold.control_totals({
        name: (sserving.snapshot_table(spark, f"{root}/serving/{name}", mart.schema, serving.SERVING[name]).read(),
               CONTROL_MEASURE[name])
        for name, mart in marts.items()})


def _late_stream(spark, lake: Lake):
    """5-day files, one a trigger, the third group delivered last; bronze of the
    stream, its landing folder and the file number of a row."""
    fno = file_number("timestamp", standins.FEED_START, LATE_DAYS_PER_FILE)
    landing = run_dir(spark, "landing_late")
    land_files(lake.bronze_events(), landing, fno, last=(LATE_GROUP,))
    return _stream_to_bronze(spark, lake, landing, files_per_trigger=1), landing, fno


@query
def late_rows_report(spark, sf_dir):
    """Rows behind the 2-day watermark are dropped, and counted per file.

    The order keeps the answer independent of whether Spark filters late rows
    with the current or the previous batch's watermark: the only late file
    is older than both.
    """
    lake = Lake(spark, sf_dir)
    run, _, fno = _late_stream(spark, lake)
    kept = readers.read_parquet(spark, run.output, _bronze_schema(lake)).select(
        fno.alias("file_no"), F.lit(0).alias("rows_in"), F.lit(1).alias("rows_kept"))
    fed = lake.bronze_events().select(fno.alias("file_no"), F.lit(1).alias("rows_in"),
                                      F.lit(0).alias("rows_kept"))
    # input and output reconciled per file, files without a number included
    return (fed.unionByName(kept).groupBy("file_no")
            .agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_kept").alias("rows_kept"))
            .withColumn("rows_late", F.col("rows_in") - F.col("rows_kept")))


@query
def late_rows_backfill(spark, sf_dir):
    """Late rows dropped by the stream and brought back from the landing
    files: bronze then equals the batch dedupe, row for row."""
    lake = Lake(spark, sf_dir)
    run, landing, _ = _late_stream(spark, lake)
    late = run_dir(spark, "bronze_events_late")
    sbronze.backfill_late(spark, landing, _event_schema(lake), run.output, late)
    bronze = sbronze.read_bronze(spark, run.output, late, _bronze_schema(lake))
    return to_ntz(bronze.select(*USAGE_EVENTS.columns))


class UsageMarts:
    """The three usage marts as partial aggregates, and their serving tables."""

    MARTS = (gold.DAILY_USAGE, gold.DAILY_USAGE_V1, gold.tokens_day(standins.GENAI_SERVICE))

    def __init__(self, spark, lake: Lake, root: str):
        self.spark, self.lake, self.root = spark, lake, root
        self.stores = {m.name: partials.PartialStore(spark, f"{root}/partials/{m.name}", m, "usage_date")
                       for m in self.MARTS}
        self.silver = {n: self._silver(lake.bronze_events().limit(0))[n].schema for n in self.stores}

    @staticmethod
    def _silver(events: DataFrame) -> dict[str, DataFrame]:
        clean, _ = quality.split(silver.labelled_events(events, spike_q=None, defaults=False))
        v1 = clean.select(*USAGE_MART_COLUMNS)
        v2 = _with_defaults(v1)
        return {"daily_usage": v2, "daily_usage_v1": v1, "tokens_day": v2}

    def mart(self, name: str, periods: list | None = None) -> DataFrame:
        store = self.stores[name]
        return gold.with_org_attrs(store.build(self.silver[name], periods), self.lake.orgs(), store.mart)

    def table(self, name: str) -> SnapshotTable:
        spec = serving.SERVING[name]
        return sserving.snapshot_table(self.spark, f"{self.root}/serving/{name}", self.mart(name).schema, spec)

    def load(self, events: DataFrame, load: str) -> dict[str, list]:
        """Adds a load of new bronze rows to the marts and refreshes the serving
        rows of the periods it touches; returns those.  A load may be repeated."""
        path, touched = f"{self.root}/clean/{load}", {}
        clean = self._silver(events)["daily_usage_v1"]
        writers.write_parquet(clean, path)
        v1 = readers.read_parquet(self.spark, path, clean.schema)
        rows = {"daily_usage": _with_defaults(v1), "daily_usage_v1": v1, "tokens_day": _with_defaults(v1)}
        for name, store in self.stores.items():
            store.add(rows[name], load)
            touched[name] = store.periods(load)
            table, seq = self.table(name), store.loads().index(load)
            head = table.head()
            if not touched[name] and head.batches.get("loads", -1) < seq:
                table.commit(head, None, F.lit(False), writer="loads", batch=seq)   # nothing new: noted
            fresh = self.mart(name, touched[name]).withColumn(serving.LOAD_SEQ, F.lit(seq).cast("long"))
            fresh = fresh.persist(StorageLevel.DISK_ONLY)      # its folders are asked for, then it is written
            try:
                sserving.merge_batch(table, fresh, seq, "loads", serving.SERVING[name])
            finally:
                fresh.unpersist()
        return touched

    def compact(self) -> None:
        """Merges the loads of each mart's partial aggregates."""
        for name, store in self.stores.items():
            store.compact(self.silver[name])

    def absorb_late(self, late: str, schema) -> list[str]:
        """Loads every backfill run that the marts do not have yet (the log of the
        table that is refreshed last tells)."""
        last = self.MARTS[-1].name
        done = self.table(last).head().batches.get("loads", -1)
        have = set(self.stores[last].loads()[:done + 1])
        runs = [r for r in sbronze.late_runs(self.spark, late) if f"late-{r}" not in have]
        for r in runs:
            self.load(sbronze.read_late(self.spark, late, schema, [r]), f"late-{r}")
        return runs


@query
def mart_partials_compacted(spark, sf_dir):
    """The revenue mart from partial aggregates of four loads, the first
    three merged by a compaction before the last one comes."""
    lake = Lake(spark, sf_dir)
    clean, _ = quality.split(silver.labelled_billing(lake.billing()))
    path = run_dir(spark, "clean_billing")
    writers.write_parquet(silver.revenue_amounts(clean), path)
    rows = readers.read_parquet(spark, path, silver.revenue_amounts(clean).schema)
    store = partials.PartialStore(spark, run_dir(spark, "revenue_partials"), gold.REVENUE_MONTH, "month")
    for k in range(4):
        store.add(rows.where(F.pmod(F.xxhash64("invoice_id"), F.lit(4)) == k), f"load-{k}")
        if k == 2:
            store.compact(rows.schema)
    return gold.with_org_attrs(store.build(rows.schema), lake.orgs(), store.mart)


@query
def late_rows_to_marts(spark, sf_dir):
    """The marts of the stream's bronze, then of the rows that the
    watermark dropped: an aggregate over the late rows alone is merged in, and
    the serving rows of their periods refreshed.  Rows of the serving tables."""
    lake = Lake(spark, sf_dir)
    run, landing, _ = _late_stream(spark, lake)
    late, schema = run_dir(spark, "bronze_events_late"), _bronze_schema(lake)
    marts = UsageMarts(spark, lake, run_dir(spark, "late_marts"))
    marts.load(readers.read_parquet(spark, run.output, schema), "0-stream")
    sbronze.backfill_late(spark, landing, _event_schema(lake), run.output, late)
    marts.absorb_late(late, schema)

    def rows(name, cost, quantity, service=F.lit(None).cast("string")):
        return marts.table(name).read().select(
            F.lit(name).alias("mart"), "org_id", "org_name", "usage_date", service.alias("service"),
            F.col(cost).alias("cost"), F.col(quantity).alias("quantity"))
    return (rows("daily_usage", "total_cost_usd", "total_requests", F.col("service"))
            .unionByName(rows("daily_usage_v1", "total_carbon_kg", "event_count", F.col("service")))
            .unionByName(rows("tokens_day", "estimated_cost_usd", "total_tokens")))


# ================================================================= materialised layers
@query
def bronze_csv_table(spark, sf_dir):
    """Org master re-export landed as CSV; bronze reads it with the
    header checked, adds lineage, keeps one row per org (highest balance) and
    writes Parquet partitioned by plan tier."""
    raw = standins.customers_with_copies(spark, sf_dir).select(
        F.col("c_custkey").alias("org_id"), F.col("c_name").alias("org_name"),
        F.col("c_mktsegment").alias("plan_tier"), F.col("c_acctbal").alias("acctbal"))
    landing = writers.write_csv(raw, run_dir(spark, "landing_orgs_csv"))
    bronze = jobs.bronze_csv_table(spark, landing, raw.schema, run_dir(spark, "bronze_orgs"),
                                   ["org_id"], order=["acctbal"], partition_by="plan_tier")
    return bronze.select("org_id", "org_name", "plan_tier", "acctbal")


@query
def bronze_masters_counts(spark, sf_dir):
    """The seven masters landed as CSV (with a re-export of a third of
    their rows) and loaded to bronze: rows and distinct keys per table."""
    out = None
    for name, (spec, path) in jobs.bronze_masters(spark, sf_dir, run_dir(spark, "masters")).items():
        bronze = readers.read_parquet(spark, path, readers.with_corrupt(spec))
        one = bronze.agg(F.count("*").alias("rows"), F.count_distinct(*spec.key).alias("distinct_keys"),
                         F.count(CORRUPT).alias("corrupt_rows")) \
            .select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query
def lake_build_counts(spark, sf_dir):
    """End to end: every layer written (bronze → silver + quarantine → gold →
    serving) and read back; rows per layer."""
    layers = jobs.build_layers(spark, Lake(spark, sf_dir), run_dir(spark, "lake"))
    return jobs.layer_counts(spark, layers)
