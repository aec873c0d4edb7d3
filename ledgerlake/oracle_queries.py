"""DuckDB SQL for each registered query that SQL can express.

Streaming queries are checked against the batch SQL of what the stream must
produce.
"""

from __future__ import annotations

from . import catalog as C
from .oracle import (BRONZE, GOLD_REVENUE, GOLD_TICKETS, GOLD_TOKENS, GOLD_USAGE,
                     GOLD_USAGE_V1, ORGS, R0, TICKETS, gold_anomaly, labelled,
                     msum, silver, silver_v1, silver_v1_ctes, typed, with_)
from .sources import standins as S

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


def _d(s: str) -> str:
    return f"DATE '{s}'"


# ---------------------------------------------------------------- scans / sinks
sql("scan_parquet_pruned", """
SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'view' AND value > 100""")

sql("scan_csv_roundtrip", with_(ORGS) + "SELECT * FROM orgs")

sql("scan_jsonl_roundtrip", with_(BRONZE) + "SELECT * FROM bronze")

sql("sink_parquet_overwrite", with_(BRONZE, labelled(None)) +
    "SELECT * FROM labelled WHERE dq_rule IS NOT NULL")

USAGE_MART = with_(silver(None), GOLD_USAGE)
sql("sink_partitioned_overwrite", USAGE_MART + "SELECT * FROM gold_usage")

sql("lineage_columns", """
SELECT c_custkey, c_name, 'customer.parquet' AS source_name, TRUE AS has_ingest_ts FROM customer""")

_line_bytes = "CAST(COALESCE(SUM(octet_length(encode(concat_ws('|', {cols}))) + 1), 0) AS BIGINT)"


def _layer_bytes(layer: str, cols: str, frm: str) -> str:
    b = _line_bytes.format(cols=cols)
    return f"SELECT '{layer}' AS layer, {b} AS bytes, ROUND({b} / (1024 * 1024), 2) AS mb FROM {frm}"


sql("layer_size_report", with_(silver(None), GOLD_USAGE) + "\nUNION ALL\n".join([
    _layer_bytes("bronze", "event_id, org_id, service, metric, value, unit", "bronze"),
    _layer_bytes("quarantine", "dq_rule, event_id, org_id, value", "labelled WHERE dq_rule IS NOT NULL"),
    _layer_bytes("gold", "org_id, usage_date, service, event_count", "gold_usage")]))

sql("empty_mart_safe", with_(silver(*C.EMPTY_SPIKE), gold_anomaly(*C.EMPTY_SPIKE)) +
    "SELECT * FROM gold_anomaly")

# ---------------------------------------------------------------- projections / rules
sql("value_try_cast", with_(BRONZE) +
    "SELECT event_id, value, TRY_CAST(value AS DOUBLE) AS value_num FROM bronze")

sql("schema_defaults", with_(BRONZE, typed(True)) +
    "SELECT event_id, schema_version, carbon_kg, genai_tokens FROM typed")

sql("silver_usage_features", with_(silver(None)) + """
SELECT event_id, "timestamp", usage_date, strftime(usage_date, '%Y-%m-%d') AS usage_day,
       metric, value_num, cpu_hours, storage_gb_hours FROM silver""")

sql("project_silver_columns", with_(silver(0.99, 3.0)) + "SELECT * FROM silver")

sql("dq_rule_label", with_(BRONZE, labelled(None)) +
    "SELECT event_id, cost_usd_increment, value, unit, dq_rule FROM labelled")

sql("dq_split_total", with_(BRONZE, labelled(None)) + """
SELECT CASE WHEN dq_rule IS NULL THEN 'clean' ELSE 'quarantine' END AS side, dq_rule,
       COUNT(*) AS rows
FROM labelled GROUP BY dq_rule
UNION ALL
SELECT 'input' AS side, NULL AS dq_rule, COUNT(*) AS rows FROM labelled""")

sql("quarantine_preview", with_(BRONZE, labelled(None)) + f"""
SELECT dq_rule, "timestamp", org_id, resource_id, event_id, value, unit, cost_usd_increment
FROM labelled WHERE dq_rule IS NOT NULL
ORDER BY {', '.join(c + ' NULLS FIRST' for c in ('dq_rule', '"timestamp"', 'org_id', 'resource_id',
          'event_id', 'value', 'unit', 'cost_usd_increment'))} LIMIT {C.PREVIEW_ROWS}""")

_qcols = ", ".join(
    f"(SELECT percentile_disc({q}) WITHIN GROUP (ORDER BY cost_usd_increment) FROM typed "
    f"WHERE isfinite(cost_usd_increment)) AS p{q * 100:g}" for q in C.QUANTILES)
sql("cost_quantiles", with_(BRONZE, typed(True)) + f"""
SELECT COUNT(cost_usd_increment) AS n, MIN(cost_usd_increment) AS min_cost,
       MAX(cost_usd_increment) AS max_cost, {_qcols}
FROM typed WHERE isfinite(cost_usd_increment)""")

_SCOPES = {"all": "TRUE", "range": f"usage_date BETWEEN {_d(C.SKETCH_RANGE[0])} AND {_d(C.SKETCH_RANGE[1])}"}
sql("cost_quantiles_sketch", with_(BRONZE, typed(True)) + "\nUNION ALL\n".join(
    f"SELECT '{scope}' AS scope, '{C.quantile_name(q)}' AS quantile, COUNT(*) AS n, COUNT(*) AS sketch_n, "
    f"TRUE AS within_bound FROM typed WHERE isfinite(cost_usd_increment) AND {days}"
    for scope, days in _SCOPES.items() for q in C.QUANTILES))
sql("distinct_ids_sketch", with_(BRONZE, typed(True)) + "\nUNION ALL\n".join(
    f"SELECT '{scope}' AS scope, COUNT(DISTINCT event_id) AS distinct_ids, TRUE AS within_bound "
    f"FROM typed WHERE {days}" for scope, days in _SCOPES.items()))

sql("cost_spike_flag", with_(BRONZE, labelled(*C.ANOMALY_SPIKE)) +
    "SELECT event_id, cost_usd_increment, dq_rule, cost_spike_flag FROM labelled")

sql("cost_spike_flag_clean_fit", with_(BRONZE, labelled(*C.ANOMALY_SPIKE, fit_on="clean")) +
    "SELECT event_id, dq_rule, cost_spike_flag FROM labelled")

# a cut line keeps its first 30 characters; a line whose time is no time keeps
# all of it, {"event_id":N,"timestamp":"not a time", ...}
_ts = """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"""
sql("corrupt_rows_quarantine", with_(BRONZE, labelled(None)) + f""",
lines AS (
  SELECT *, CASE WHEN event_id % {S.CUT_LINE_MOD} = 0 THEN 'cut'
                 WHEN event_id % {S.BAD_TIME_MOD} = 0 AND "timestamp" IS NOT NULL THEN 'time' END AS broken
  FROM labelled)
SELECT CASE WHEN broken IS NOT NULL THEN '{R0}' ELSE dq_rule END AS dq_rule, COUNT(*) AS rows,
       SUM(CASE WHEN broken = 'cut' THEN 30
                WHEN broken = 'time' THEN length(concat('{{', concat_ws(',',
                  '"event_id":' || event_id, '"timestamp":"not a time"', '"org_id":' || org_id,
                  '"resource_id":"' || resource_id || '"', '"service":"' || service || '"',
                  '"region":"' || region || '"', '"metric":"' || metric || '"',
                  '"value":"' || value || '"', '"unit":"' || unit || '"',
                  '"cost_usd_increment":' || CASE WHEN isnan(cost_usd_increment) THEN '"NaN"'
                    WHEN cost_usd_increment = {S.TINY_COST!r} THEN '4.0E-9'
                    WHEN cost_usd_increment = {S.HUGE_COST!r} THEN '2.0E10'
                    ELSE CAST(cost_usd_increment AS VARCHAR) END,
                  '"schema_version":' || raw_version,
                  '"carbon_kg":' || CAST(raw_carbon AS VARCHAR),
                  '"genai_tokens":' || raw_tokens), '}}')) END) AS corrupt_chars
FROM (SELECT l.*, b.schema_version AS raw_version, b.carbon_kg AS raw_carbon, b.genai_tokens AS raw_tokens
      FROM lines l LEFT JOIN bronze b ON l.event_id = b.event_id)
GROUP BY 1""")

# ---------------------------------------------------------------- joins
sql("enrich_left_join", with_(ORGS, BRONZE, labelled(None)) + """
SELECT l.event_id, l."timestamp", l.org_id, o.org_name, o.plan_tier
FROM labelled l LEFT JOIN orgs o ON l.org_id = o.org_id WHERE l.dq_rule IS NULL""")

sql("enrich_skew_join", with_(ORGS, BRONZE) + """
SELECT b.event_id, b.org_id, b.service, b.cost_usd_increment, o.org_name, o.plan_tier
FROM bronze b LEFT JOIN orgs o ON b.org_id = o.org_id""")

sql("enrich_composite_key", with_(BRONZE) + """, reg AS (
  SELECT event_type AS resource_id, user_id AS org_id FROM events WHERE value > 100
  GROUP BY event_type, user_id)
SELECT b.event_id, b."timestamp", b.org_id, b.resource_id, r.org_id IS NOT NULL AS resource_known
FROM bronze b LEFT JOIN reg r ON b.resource_id = r.resource_id AND b.org_id = r.org_id""")

_BILLING_ONLY = GOLD_REVENUE[:GOLD_REVENUE.index(",\ngold_revenue AS")]
sql("silver_revenue_usd", with_(_BILLING_ONLY) + """
SELECT invoice_id, org_id, month, org_name, plan_tier, currency, subtotal, credits, taxes,
       exchange_rate_to_usd, ROUND(revenue_usd_d, 8) AS revenue_usd
FROM billing_silver""")

sql("ticket_features", with_(TICKETS) + """
SELECT ticket_id, org_id, severity, created_at, ticket_date, is_critical, sla_breached, csat
FROM tickets_silver""")

_usage_between = GOLD_USAGE.replace("gold_usage AS (", "{name} AS (").replace(
    "FROM silver GROUP BY", "FROM silver WHERE {cond} GROUP BY")
sql("upsert_by_key", with_(
    silver(None),
    _usage_between.format(name="first_load", cond=f"\"timestamp\" < TIMESTAMP '{C.LOAD1_END}'"),
    _usage_between.format(name="second_load",
                          cond=f"\"timestamp\" >= TIMESTAMP '{C.LOAD2_START}'")) + """
SELECT * FROM second_load
UNION ALL
SELECT f.* FROM first_load f ANTI JOIN second_load s
  ON f.org_id IS NOT DISTINCT FROM s.org_id AND f.usage_date IS NOT DISTINCT FROM s.usage_date
     AND f.service IS NOT DISTINCT FROM s.service""")

# ---------------------------------------------------------------- dedupe
sql("dedupe_natural_key", f"""
WITH raw AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1.0, c_mktsegment FROM customer
  WHERE c_custkey % 3 = 0)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal DESC NULLS LAST,
    c_name DESC NULLS LAST, c_nationkey DESC NULLS LAST, c_mktsegment DESC NULLS LAST) AS rn
  FROM raw WHERE c_custkey IS NOT NULL)
WHERE rn = 1
UNION ALL SELECT * FROM raw WHERE c_custkey IS NULL""")

_li = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
       "l_returnflag", "l_linestatus", "l_shipdate"]
sql("dedupe_composite_key", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    {', '.join(c + ' DESC NULLS LAST' for c in _li)}) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
WHERE rn = 1
UNION ALL
SELECT * FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL""")

# ---------------------------------------------------------------- marts
sql("mart_daily_usage", USAGE_MART + "SELECT * FROM gold_usage")
sql("mart_daily_usage_v1", with_(silver_v1(), GOLD_USAGE_V1) + "SELECT * FROM gold_v1")
sql("mart_revenue_month", with_(GOLD_REVENUE) + "SELECT * FROM gold_revenue")
sql("mart_partials_compacted", ORACLE["mart_revenue_month"])
sql("mart_cost_anomaly", with_(silver(*C.ANOMALY_SPIKE), gold_anomaly(*C.ANOMALY_SPIKE)) +
    "SELECT * FROM gold_anomaly")
sql("mart_tickets_day", with_(GOLD_TICKETS) + "SELECT * FROM gold_tickets")
sql("mart_tokens_by_day", with_(silver(None), GOLD_TOKENS) + "SELECT * FROM gold_tokens")

# ---------------------------------------------------------------- checks
sql("layer_counts", with_(ORGS, BRONZE, labelled(None)) + f""",
sil AS (
  SELECT l.*, o.org_name, o.plan_tier,
         CASE WHEN l.metric = 'cpu_hours' THEN l.value_num ELSE 0.0 END AS cpu_hours,
         CASE WHEN l.metric = 'storage_gb_hours' THEN l.value_num ELSE 0.0 END AS storage_gb_hours
  FROM labelled l LEFT JOIN orgs o ON l.org_id = o.org_id WHERE l.dq_rule IS NULL),
{GOLD_USAGE.replace('FROM silver', 'FROM sil')}
SELECT 'bronze' AS layer, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS distinct_ids FROM bronze
UNION ALL SELECT 'quarantine', COUNT(*), COUNT(DISTINCT event_id) FROM labelled
  WHERE dq_rule IS NOT NULL
UNION ALL SELECT 'silver', COUNT(*), COUNT(DISTINCT event_id) FROM sil
UNION ALL SELECT 'gold_usage', COUNT(*), CAST(NULL AS BIGINT) FROM gold_usage""")

sql("gold_control_totals", with_(silver(None), GOLD_USAGE, silver_v1_ctes(), GOLD_USAGE_V1,
                                 GOLD_REVENUE.replace(ORGS + ",", ""), GOLD_TICKETS,
                                 GOLD_TOKENS) + f"""
SELECT 'daily_usage' AS mart, COUNT(*) AS rows, {msum('total_cost_usd', 2)} AS total FROM gold_usage
UNION ALL SELECT 'daily_usage_v1', COUNT(*), {msum('total_cost_usd', 2)} FROM gold_v1
UNION ALL SELECT 'revenue_month', COUNT(*), {msum('revenue_usd', 2)} FROM gold_revenue
UNION ALL SELECT 'tickets_day', COUNT(*), {msum('ticket_count', 2)} FROM gold_tickets
UNION ALL SELECT 'tokens_day', COUNT(*), {msum('estimated_cost_usd', 2)} FROM gold_tokens""")

# ---------------------------------------------------------------- serving
sql("serve_usage_range", USAGE_MART + f"""
SELECT usage_date, service, COALESCE(total_cost_usd, 0) AS total_cost_usd, total_requests,
       event_count FROM gold_usage
WHERE org_id = {C.ORG} AND usage_date BETWEEN {_d(C.V1_RANGE[0])} AND {_d(C.V1_RANGE[1])}
ORDER BY usage_date, service""")

sql("serve_top_services", USAGE_MART + f"""
SELECT service, {msum('total_cost_usd', 4)} AS total_cost_usd FROM gold_usage
WHERE org_id = {C.ORG} AND usage_date BETWEEN {_d(C.V2_RANGE[0])} AND {_d(C.V2_RANGE[1])}
GROUP BY service ORDER BY total_cost_usd DESC, service LIMIT {C.TOP_N}""")

sql("serve_critical_tickets", with_(GOLD_TICKETS) + f"""
SELECT ticket_date, severity, ticket_count, critical_count, sla_breach_rate FROM gold_tickets
WHERE org_id = {C.ORG} AND severity IN ('critical', 'high')
  AND ticket_date BETWEEN {_d(C.V3_RANGE[0])} AND {_d(C.V3_RANGE[1])}
ORDER BY ticket_date, severity""")

sql("serve_revenue_history", with_(GOLD_REVENUE) + f"""
SELECT month, revenue_usd, total_credits, total_taxes, currency FROM gold_revenue
WHERE org_id = {C.ORG} ORDER BY month""")

sql("serve_tokens_by_day", with_(silver(None), GOLD_TOKENS) + f"""
SELECT usage_date, total_tokens, estimated_cost_usd FROM gold_tokens
WHERE org_id = {C.ORG} AND usage_date >= {_d(C.V5_FROM)} ORDER BY usage_date""")

V1_MART = with_(silver_v1(), GOLD_USAGE_V1)
sql("serve_key_lookup", V1_MART + f"""
SELECT service, total_cost_usd, total_requests, total_genai_tokens, event_count FROM gold_v1
WHERE org_id = {C.ORG} AND usage_date = {_d(C.V6_DAY)} ORDER BY service""")

sql("serve_service_cost_trend", V1_MART + f"""
SELECT usage_date, service, total_cost_usd, event_count FROM gold_v1
WHERE org_id = {C.ORG} AND service = '{C.V7[0]}'
  AND usage_date BETWEEN {_d(C.V7[1])} AND {_d(C.V7[2])} ORDER BY usage_date""")

_NULL_POLICY = """SELECT * REPLACE (
  COALESCE(total_cost_usd, 0) AS total_cost_usd, COALESCE(total_requests, 0) AS total_requests,
  COALESCE(total_cpu_hours, 0) AS total_cpu_hours,
  COALESCE(total_storage_gb_hours, 0) AS total_storage_gb_hours,
  COALESCE(total_genai_tokens, 0) AS total_genai_tokens,
  COALESCE(total_carbon_kg, 0) AS total_carbon_kg, COALESCE(event_count, 0) AS event_count)
FROM gold_usage"""
sql("serving_null_policy", USAGE_MART + _NULL_POLICY)
sql("serving_layout_sorted", USAGE_MART + _NULL_POLICY)

# ---------------------------------------------------------------- streaming
# In-order feed with next-day re-deliveries: the stream must give back the
# feed exactly once per id (rows without id kept as they are) = bronze.
_EVENT_COLS = ("event_id, \"timestamp\", org_id, resource_id, service, region, metric, value, "
               "unit, cost_usd_increment, schema_version, carbon_kg, genai_tokens")
sql("stream_bronze_dedupe", with_(BRONZE) + f"SELECT {_EVENT_COLS} FROM bronze")

sql("stream_rerun_idempotent", with_(BRONZE) + """
SELECT COUNT(*) AS rows_after_rerun, COUNT(DISTINCT event_id) AS distinct_ids,
       COUNT(*) AS rows_after_first, CAST(0 AS BIGINT) AS rerun_batches FROM bronze""")

sql("stream_rebuild_equals_batch", with_(BRONZE) + f"""
SELECT CAST("timestamp" AS DATE) AS usage_date,
       COUNT(*) AS stream_rows, COUNT(DISTINCT event_id) AS stream_ids,
       {msum('CASE WHEN NOT isnan(cost_usd_increment) THEN cost_usd_increment END', 2)} AS stream_cost,
       COUNT(*) AS batch_rows, COUNT(DISTINCT event_id) AS batch_ids,
       {msum('CASE WHEN NOT isnan(cost_usd_increment) THEN cost_usd_increment END', 2)} AS batch_cost
FROM bronze GROUP BY 1""")

# the serving load applies the serving null policy to what it merges
sql("late_rows_to_marts", f"""
SELECT 'daily_usage' AS mart, org_id, org_name, usage_date, service,
       COALESCE(total_cost_usd, 0) AS cost, COALESCE(total_requests, 0) AS quantity
FROM ({ORACLE["mart_daily_usage"]})
UNION ALL
SELECT 'daily_usage_v1', org_id, org_name, usage_date, service, COALESCE(total_carbon_kg, 0), event_count
FROM ({ORACLE["mart_daily_usage_v1"]})
UNION ALL
SELECT 'tokens_day', org_id, org_name, usage_date, NULL, COALESCE(estimated_cost_usd, 0), COALESCE(total_tokens, 0)
FROM ({ORACLE["mart_tokens_by_day"]})""")

sql("stream_serving_upsert",
    _NULL_POLICY.replace("FROM gold_usage", f"FROM ({ORACLE['upsert_by_key']}) AS upserted"))

sql("stream_serving_all_marts", with_(silver(*C.EMPTY_SPIKE), GOLD_USAGE,
                                      gold_anomaly(*C.EMPTY_SPIKE), GOLD_TOKENS,
                                      GOLD_REVENUE.replace(ORGS + ",", ""), GOLD_TICKETS) + f"""
SELECT 'daily_usage' AS mart, COUNT(*) AS rows, {msum('total_cost_usd', 2)} AS total FROM gold_usage
UNION ALL SELECT 'revenue_month', COUNT(*), {msum('revenue_usd', 2)} FROM gold_revenue
UNION ALL SELECT 'cost_anomaly', COUNT(*), {msum('max_cost_usd', 2)} FROM gold_anomaly
UNION ALL SELECT 'tickets_day', COUNT(*), {msum('ticket_count', 2)} FROM gold_tickets
UNION ALL SELECT 'tokens_day', COUNT(*), {msum('estimated_cost_usd', 2)} FROM gold_tokens""")

# Groups of 5 days (NULL: rows without a time), one per trigger, in order but
# for LATE_GROUP, which comes last.  The watermark of batch b is the latest
# event time of batches before b minus 2 days; rows with id and time that are
# older are dropped.
sql("late_rows_report", with_(BRONZE) + f""",
f AS (SELECT *, CAST(floor(datediff('day', DATE '{S.FEED_START}', CAST("timestamp" AS DATE))
                     / {C.LATE_DAYS_PER_FILE}) AS INTEGER) AS file_no FROM bronze),
mx AS (SELECT file_no, COALESCE(file_no = {C.LATE_GROUP}, FALSE) AS last, MAX("timestamp") AS mx
       FROM f GROUP BY file_no),
wm AS (SELECT file_no, MAX(mx) OVER (ORDER BY last, file_no NULLS FIRST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       - INTERVAL 2 DAY AS wm FROM mx),
t AS (SELECT f.file_no, COALESCE(f.event_id IS NOT NULL AND f."timestamp" < wm.wm, FALSE) AS late
      FROM f JOIN wm ON f.file_no IS NOT DISTINCT FROM wm.file_no)
SELECT file_no, COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE NOT late) AS rows_kept,
       COUNT(*) FILTER (WHERE late) AS rows_late
FROM t GROUP BY file_no""")

sql("late_rows_backfill", with_(BRONZE) + f"SELECT {_EVENT_COLS} FROM bronze")

# ---------------------------------------------------------------- materialised layers
sql("bronze_csv_table", """
WITH raw AS (
  SELECT c_custkey AS org_id, c_name AS org_name, c_mktsegment AS plan_tier, c_acctbal AS acctbal
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal + 1.0 FROM customer WHERE c_custkey % 3 = 0)
SELECT org_id, org_name, plan_tier, acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY acctbal DESC) AS rn FROM raw)
WHERE rn = 1""")

# events whose landing line is broken have no id or time in bronze; they are in
# quarantine under R0
_BROKEN = f"""(COALESCE(event_id % {S.CUT_LINE_MOD} = 0, FALSE) OR
              COALESCE(event_id % {S.BAD_TIME_MOD} = 0 AND "timestamp" IS NOT NULL, FALSE))"""
_MASTERS = {"customers_orgs": "customer", "users": "customer", "billing_monthly": "orders",
            "resources": "(SELECT DISTINCT event_type, user_id FROM events WHERE value > 100)",
            "support_tickets": "orders", "marketing_touches": "orders",
            "nps_surveys": "(SELECT * FROM customer UNION ALL SELECT * FROM customer)"}
sql("bronze_masters_counts", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows, COUNT(*) AS distinct_keys, "
    f"CAST(0 AS BIGINT) AS corrupt_rows FROM {frm}" for name, frm in _MASTERS.items()))


def _built_layers() -> str:
    """CTEs of every layer of the build.  The threshold is fitted on the costs
    that bronze holds: a cut line has none."""
    q, m = C.REFERENCE_SPIKE
    text = silver(q, m)
    text = text.replace("labelled AS (\n", "labelled0 AS (\n")
    text = text.replace("WHERE isfinite(cost_usd_increment)),",
                        f"WHERE isfinite(cost_usd_increment) AND NOT COALESCE(event_id % {S.CUT_LINE_MOD} = 0, FALSE)),")
    head, tail = text.split("silver AS (", 1)
    return (head + f"""labelled AS (SELECT * REPLACE (CASE WHEN {_BROKEN} THEN '{R0}' ELSE dq_rule END AS dq_rule)
             FROM labelled0),
silver AS (""" + tail)


_LAYER_COUNTS = [
    *[(f"bronze/{name}", frm, "") for name, frm in _MASTERS.items()],
    ("bronze/usage_events", "bronze", ""),
    ("silver/quarantine", "labelled", "WHERE dq_rule IS NOT NULL"),
    ("silver/usage_events_clean", "silver", ""),
    ("silver/support_tickets_clean", "tickets_silver", ""),
    ("silver/billing_monthly_clean", "billing_silver", ""),
    *[(f"{layer}/{name}", cte, "") for layer in ("gold", "serving") for name, cte in (
        ("daily_usage", "gold_usage"), ("revenue_month", "gold_revenue"),
        ("cost_anomaly", "gold_anomaly"), ("tickets_day", "gold_tickets"),
        ("tokens_day", "gold_tokens"))],
]
_BUILT = with_(_built_layers(), GOLD_USAGE, gold_anomaly(*C.REFERENCE_SPIKE), GOLD_TOKENS,
               GOLD_REVENUE.replace(ORGS + ",", ""), GOLD_TICKETS)
sql("lake_build_counts", _BUILT + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS layer, COUNT(*) AS rows FROM {cte} {cond}" for name, cte, cond in _LAYER_COUNTS))

_TOTALS = [("daily_usage", "gold_usage", msum("total_cost_usd", 2)),
           ("revenue_month", "gold_revenue", msum("revenue_usd", 2)),
           ("cost_anomaly", "gold_anomaly", msum("max_cost_usd", 2)),
           ("tickets_day", "gold_tickets", "CAST(SUM(ticket_count) AS DOUBLE)"),
           ("tokens_day", "gold_tokens", msum("estimated_cost_usd", 2))]
sql("gold_reproducibility", _BUILT + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS mart, '{side}' AS side, COUNT(*) AS rows, {total} AS total FROM {cte}"
    if side != "differing" else
    f"SELECT '{name}' AS mart, '{side}' AS side, CAST(0 AS BIGINT) AS rows, CAST(NULL AS DOUBLE) AS total"
    for name, cte, total in _TOTALS for side in ("first", "second", "differing")))
