"""Independent SQL definitions of the registered queries (DuckDB dialect).

Each query is written from the definitions (not generated from the Spark
plans): the stand-in derivations, the rules, the marts and the questions as
plain SQL over the benchmark views.  Output column names and types are the
ones the Spark side returns.
"""

from __future__ import annotations

from .sources import standins as S

R1, R2, R3 = "R1_event_id_nulo", "R2_costo_anomalo", "R3_unit_nulo_con_value"
R0, R4, R5 = "R0_registro_corrupto", "R4_numero_fuera_de_rango", "R5_timestamp_nulo"


def _case(expr: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens}" + (f" ELSE {default}" if default else "") + " END"


METRIC = _case("event_type", S.METRIC_OF_EVENT_TYPE, "event_type")

ORGS = f"""orgs AS (
  SELECT c.c_custkey AS org_id, c.c_name AS org_name, c.c_mktsegment AS plan_tier,
         r.r_name AS hq_region, c.c_acctbal >= 5000 AS is_enterprise
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

BRONZE = f"""ev AS (
  SELECT e.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         {METRIC} AS metric0
  FROM events e),
bronze AS (
  SELECT CASE WHEN event_id % {S.NULL_EVENT_ID_MOD} = 0 THEN NULL ELSE event_id END AS event_id,
         CASE WHEN event_id % {S.NULL_TIME_MOD} = 0 THEN NULL ELSE ts END AS "timestamp",
         CASE WHEN event_id % {S.UNKNOWN_ORG_MOD} = 0 THEN -user_id ELSE user_id END AS org_id,
         event_type AS resource_id,
         CASE WHEN event_id % {S.NULL_SERVICE_MOD} = 0 THEN NULL
              ELSE 's' || CAST(k % 4 AS VARCHAR) END AS service,
         'r' || CAST(k % 3 AS VARCHAR) AS region,
         metric0 AS metric,
         CASE WHEN event_id % {S.TEXT_VALUE_MOD} = 0 THEN 'n/a'
              WHEN event_id % {S.INFINITE_VALUE_MOD} = 0 THEN 'Infinity'
              ELSE CAST(value AS VARCHAR) END AS value,
         CASE WHEN event_id % {S.NULL_UNIT_MOD} = 0 THEN NULL
              ELSE {_case("metric0", S.UNIT_OF_METRIC, repr(S.DEFAULT_UNIT))} END AS unit,
         CASE WHEN event_id % {S.NULL_COST_MOD} = 0 THEN NULL
              WHEN event_id % {S.NEGATIVE_COST_MOD} = 0 THEN -value
              WHEN event_id % {S.NAN_COST_MOD} = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN event_id % {S.TINY_COST_MOD} = 0 THEN CAST({S.TINY_COST!r} AS DOUBLE)
              WHEN event_id % {S.HUGE_COST_MOD} = 0 THEN CAST({S.HUGE_COST!r} AS DOUBLE)
              ELSE value END AS cost_usd_increment,
         CASE WHEN ts < TIMESTAMP '{S.SCHEMA_V2_FROM}' THEN NULL ELSE 2 END AS schema_version,
         CASE WHEN k % 5 = 0 THEN NULL ELSE k / 1000 END AS carbon_kg,
         CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS BIGINT) END AS genai_tokens
  FROM ev)"""


def typed(defaults: bool = True, name: str = "typed") -> str:
    repl = ""
    if defaults:
        repl = """ REPLACE (COALESCE(schema_version, 1) AS schema_version,
                    COALESCE(carbon_kg, 0.0) AS carbon_kg,
                    COALESCE(genai_tokens, 0) AS genai_tokens)"""
    return f"""{name} AS (
  SELECT *{repl}, TRY_CAST(value AS DOUBLE) AS value_num, CAST("timestamp" AS DATE) AS usage_date
  FROM bronze)"""


def _beyond(c: str) -> str:
    return f"COALESCE(isnan(CAST({c} AS DOUBLE)) OR abs({c}) >= 1e15, FALSE)"


LABEL = f"""CASE WHEN event_id IS NULL THEN '{R1}'
            WHEN COALESCE(cost_usd_increment < -0.01, FALSE) THEN '{R2}'
            WHEN value_num IS NOT NULL AND unit IS NULL THEN '{R3}'
            WHEN {_beyond('value_num')} OR {_beyond('cost_usd_increment')} OR {_beyond('carbon_kg')}
              THEN '{R4}'
            WHEN "timestamp" IS NULL THEN '{R5}' END"""


def labelled(q: float | None = 0.99, mult: float = 3.0, defaults: bool = True,
             fit_on: str = "all") -> str:
    if q is None:
        return f"""{typed(defaults)},
labelled AS (SELECT *, {LABEL} AS dq_rule FROM typed)"""
    fit = "lab0" if fit_on == "all" else "(SELECT * FROM lab0 WHERE dq_rule IS NULL)"
    return f"""{typed(defaults)},
lab0 AS (SELECT *, {LABEL} AS dq_rule FROM typed),
thr AS (SELECT percentile_disc({q}) WITHIN GROUP (ORDER BY cost_usd_increment) * {mult} AS t
        FROM {fit} f WHERE isfinite(cost_usd_increment)),
labelled AS (
  SELECT lab0.*, COALESCE(lab0.cost_usd_increment > thr.t, FALSE) AS cost_spike_flag
  FROM lab0 CROSS JOIN thr)"""


def silver(q: float | None = 0.99, mult: float = 3.0) -> str:
    flag = ", l.cost_spike_flag" if q is not None else ""
    return f"""{ORGS},
{BRONZE},
{labelled(q, mult)},
silver AS (
  SELECT l.event_id, l."timestamp", l.usage_date, l.org_id, o.org_name, o.plan_tier,
         l.service, l.region, l.metric, l.value_num, l.unit, l.cost_usd_increment,
         l.schema_version, l.carbon_kg, l.genai_tokens,
         CASE WHEN l.metric = 'cpu_hours' THEN l.value_num ELSE 0.0 END AS cpu_hours,
         CASE WHEN l.metric = 'storage_gb_hours' THEN l.value_num ELSE 0.0 END AS storage_gb_hours
         {flag}
  FROM labelled l LEFT JOIN orgs o ON l.org_id = o.org_id
  WHERE l.dq_rule IS NULL)"""


def silver_v1_ctes() -> str:
    """Midterm silver (no defaults) as CTEs ``typed_v1`` → ``silver_v1``;
    expects ``orgs`` and ``bronze``."""
    return f"""{typed(False, "typed_v1")},
silver_v1 AS (
  SELECT l.event_id, l."timestamp", l.usage_date, l.org_id, o.org_name, o.plan_tier,
         l.service, l.region, l.metric, l.value_num, l.unit, l.cost_usd_increment,
         l.schema_version, l.carbon_kg, l.genai_tokens
  FROM (SELECT *, {LABEL} AS dq_rule FROM typed_v1) l
  LEFT JOIN orgs o ON l.org_id = o.org_id
  WHERE l.dq_rule IS NULL)"""


def silver_v1() -> str:
    return f"""{ORGS},
{BRONZE},
{silver_v1_ctes()}"""


def msum(expr: str, scale: int) -> str:
    """``round(sum(x), scale)``: a compensated double sum, rounded.  The Spark
    side sums decimals; both are good to far more digits than are kept."""
    return f"ROUND(fsum({expr}), {scale})"


def tsum(expr: str) -> str:
    """Sum truncated toward zero: whole micro-units summed as integers."""
    return f"CAST(SUM(CAST(ROUND({expr} * 1000000) AS HUGEINT)) // 1000000 AS BIGINT)"


REQ = "CASE WHEN metric = 'requests' THEN value_num ELSE 0.0 END"

GOLD_USAGE = f"""gold_usage AS (
  SELECT org_id, usage_date, service, MAX(org_name) AS org_name, MAX(plan_tier) AS plan_tier,
         {msum('cost_usd_increment', 4)} AS total_cost_usd,
         {tsum(REQ)} AS total_requests,
         {msum('cpu_hours', 4)} AS total_cpu_hours,
         {msum('storage_gb_hours', 4)} AS total_storage_gb_hours,
         CAST(SUM(genai_tokens) AS BIGINT) AS total_genai_tokens,
         {msum('carbon_kg', 6)} AS total_carbon_kg,
         COUNT(*) AS event_count
  FROM silver GROUP BY org_id, usage_date, service)"""

GOLD_USAGE_V1 = f"""gold_v1 AS (
  SELECT org_id, usage_date, service, MAX(org_name) AS org_name, MAX(plan_tier) AS plan_tier,
         {msum('cost_usd_increment', 4)} AS total_cost_usd,
         {tsum(REQ)} AS total_requests,
         CAST(SUM(COALESCE(genai_tokens, 0)) AS BIGINT) AS total_genai_tokens,
         {msum('COALESCE(carbon_kg, 0.0)', 6)} AS total_carbon_kg,
         COUNT(*) AS event_count
  FROM silver_v1 GROUP BY org_id, usage_date, service)"""

_CUR = {s: c for s, (c, _) in S.CURRENCY_OF_STATUS.items()}
_RATE = {s: r for s, (_, r) in S.CURRENCY_OF_STATUS.items()}
RATE_SQL = "CASE " + " ".join(f"WHEN o_orderstatus = '{s}' THEN CAST('{r}' AS DOUBLE)"
                              for s, r in _RATE.items()) + " END"

# amounts in 1e-4 units, as whole numbers; an invoice's amount in USD is one
# double product, and these are summed in whole 1e-8 units
BILLING = f"""lines AS (
  SELECT l_orderkey,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS subtotal_c,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_discount * 100) AS BIGINT)) AS credits_u,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_tax * 100) AS BIGINT)) AS taxes_u
  FROM lineitem GROUP BY l_orderkey),
billing AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS org_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(COALESCE(subtotal_c, 0) AS DOUBLE) / 100 AS subtotal,
         CASE WHEN credits_u <> 0 THEN CAST(credits_u AS DOUBLE) / 10000 END AS credits,
         CAST(COALESCE(taxes_u, 0) AS DOUBLE) / 10000 AS taxes,
         {_case('o_orderstatus', _CUR)} AS currency,
         {RATE_SQL} AS exchange_rate_to_usd,
         COALESCE(subtotal_c, 0) * 100 - COALESCE(credits_u, 0) + COALESCE(taxes_u, 0) AS net_u,
         COALESCE(credits_u, 0) AS cred_u, COALESCE(taxes_u, 0) AS tax_u
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
billing_silver AS (
  SELECT b.*, o.org_name, o.plan_tier,
    CAST(net_u AS DOUBLE) / 10000 * exchange_rate_to_usd AS revenue_usd_d,
    CAST(cred_u AS DOUBLE) / 10000 * exchange_rate_to_usd AS credits_usd_d,
    CAST(tax_u AS DOUBLE) / 10000 * exchange_rate_to_usd AS taxes_usd_d
  FROM billing b LEFT JOIN orgs o ON b.org_id = o.org_id)"""


def usum(expr: str) -> str:
    """Sum in whole 1e-8 units, rounded half away from zero to cents."""
    total = f"SUM(CAST(ROUND({expr} * 100000000) AS HUGEINT))"
    return (f"CAST(sign({total}) * ((abs({total}) + 500000) // 1000000) AS DOUBLE) / 100")


GOLD_REVENUE = f"""{ORGS},
{BILLING},
gold_revenue AS (
  SELECT org_id, month, MAX(org_name) AS org_name, MAX(plan_tier) AS plan_tier,
         {usum('revenue_usd_d')} AS revenue_usd,
         {usum('COALESCE(credits, 0.0)')} AS total_credits,
         {usum('COALESCE(taxes, 0.0)')} AS total_taxes,
         {usum('credits_usd_d')} AS credits_usd,
         {usum('taxes_usd_d')} AS taxes_usd,
         arg_min(currency, invoice_id) AS currency
  FROM billing_silver GROUP BY org_id, month)"""

_SEV = _case("o_orderpriority", S.SEVERITY_OF_PRIORITY)
TICKETS = f"""tickets AS (
  SELECT o_orderkey AS ticket_id, o_custkey AS org_id, o_orderstatus AS category,
         {_SEV} AS severity, o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS sla_breached,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 5 + 1 AS DOUBLE) END AS csat
  FROM orders),
tickets_silver AS (
  SELECT *, CAST(created_at AS DATE) AS ticket_date,
         COALESCE(severity IN ('critical', 'high'), FALSE) AS is_critical
  FROM tickets)"""

GOLD_TICKETS = f"""{TICKETS},
gold_tickets AS (
  SELECT org_id, ticket_date, severity,
         COUNT(*) AS ticket_count,
         COUNT(*) FILTER (WHERE is_critical) AS critical_count,
         ROUND(COUNT(*) FILTER (WHERE sla_breached) / COUNT(*), 4) AS sla_breach_rate,
         ROUND(SUM(CAST(csat AS BIGINT)) / COUNT(csat), 2) AS avg_csat
  FROM tickets_silver GROUP BY org_id, ticket_date, severity)"""

GOLD_TOKENS = f"""gold_tokens AS (
  SELECT org_id, usage_date, MAX(org_name) AS org_name,
         CAST(SUM(genai_tokens) AS BIGINT) AS total_tokens,
         {msum('cost_usd_increment', 4)} AS estimated_cost_usd
  FROM silver WHERE service = '{S.GENAI_SERVICE}' GROUP BY org_id, usage_date)"""


def gold_anomaly(q: float, mult: float) -> str:
    return f"""gold_anomaly AS (
  SELECT org_id, usage_date, service, MAX(org_name) AS org_name,
         COUNT(*) AS spike_event_count,
         ROUND(MAX(cost_usd_increment), 4) AS max_cost_usd,
         ROUND(fsum(cost_usd_increment) / COUNT(cost_usd_increment), 4) AS avg_cost_usd,
         'p{q * 100:g}_x{mult:g}' AS anomaly_method,
         TRUE AS is_anomaly
  FROM silver WHERE cost_spike_flag GROUP BY org_id, usage_date, service)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
