"""Queries for alert rules, states, notifications and inhibition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import alerts as A
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.q_metrics import quantile_sql
from tessera.plans.sqlparts import LOG, with_
from tessera.session import cut_lineage

PUBLIC = ["alertname", "severity", "start_slot", "pending_at", "firing_at", "resolved_at", "fired"]
SLOT = f"((epoch_us(ts) + {A.EVAL_SECONDS * A.US - 1}) // {A.EVAL_SECONDS * A.US})"


def _fmt(slot: str) -> str:
    return f"strftime(make_timestamp(({slot}) * {A.EVAL_SECONDS * A.US}), '%Y-%m-%d %H:%M:%S')"


def _windowed_sql(p: str, window_s: int, sums: dict[str, str]) -> str:
    k = window_s // A.EVAL_SECONDS
    aggs = ", ".join(f"{v} AS {n}" for n, v in sums.items())
    outs = ", ".join(f"coalesce(sum(ps.{n}), 0) AS {n}" for n in sums)
    return f"""
{p}ps AS MATERIALIZED (SELECT {SLOT} AS slot, {aggs} FROM log GROUP BY 1),
{p}grid AS MATERIALIZED (SELECT unnest(range((SELECT min(slot) FROM {p}ps), (SELECT max(slot) FROM {p}ps) + 1)) AS slot),
{p}w AS MATERIALIZED (SELECT g.slot, {outs} FROM {p}grid g
         LEFT JOIN {p}ps ps ON ps.slot BETWEEN g.slot - {k - 1} AND g.slot GROUP BY g.slot)"""


def _cond_sql(rule: A.Rule, p: str) -> str:
    """CTE text defining ``{p}c(slot, cond)`` for one rule."""
    if rule is A.HIGH_ERROR_RATE:
        return _windowed_sql(p, 300, {"errors": "count(*) FILTER (WHERE status = 'error')", "total": "count(*)"}) + f""",
{p}c AS MATERIALIZED (SELECT slot, (errors / 300.0) / greatest(total / 300.0, 0.0001) > 0.05 AS cond FROM {p}w)"""
    if rule is A.LOW_CONFIDENCE:
        return _windowed_sql(p, 900, {"high": "count(*) FILTER (WHERE status = 'success' AND confidence >= 0.7)",
                                      "success": "count(*) FILTER (WHERE status = 'success')"}) + f""",
{p}c AS MATERIALIZED (SELECT slot, (high / 900.0) / greatest(success / 900.0, 0.0001) < 0.4 AS cond FROM {p}w)"""
    if rule is A.HIGH_LATENCY:
        sums = {f"b{i}": f"count(*) FILTER (WHERE latency_ms <= {b})" for i, b in enumerate(A.LATENCY_BUCKETS_MS)}
        sums["total"] = "count(*)"
        cums = "[" + ", ".join(f"b{i}" for i in range(len(A.LATENCY_BUCKETS_MS))) + "]"
        q = quantile_sql(0.95, cums, "total", A.LATENCY_BUCKETS_MS)
        return _windowed_sql(p, 300, sums) + f""",
{p}c AS MATERIALIZED (SELECT slot, coalesce({q} > 5000.0, false) AS cond FROM {p}w)"""
    flag, limit = (("confidence < 0.4", 0.5) if rule is A.HIGH_FALLBACK_RATE else ("missed", 0.3))
    return f"""
{p}g AS MATERIALIZED (SELECT ts, event_id, avg(CAST({flag} AS DOUBLE)) OVER (ORDER BY ts, event_id
         ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gauge FROM log),
{p}ps AS MATERIALIZED (SELECT {SLOT} AS slot, arg_max(gauge, (ts, event_id)) AS gauge FROM {p}g GROUP BY 1),
{p}sp AS (SELECT slot, lead(slot) OVER (ORDER BY slot) AS nxt, gauge FROM {p}ps),
{p}c AS MATERIALIZED (SELECT unnest(range(slot, coalesce(nxt, slot + 1))) AS slot, gauge > {limit} AS cond FROM {p}sp)"""


def _states_sql(rule: A.Rule, p: str) -> str:
    """CTE text defining ``{p}st`` (alert intervals incl. internal slots)."""
    k = -(-rule.for_seconds // A.EVAL_SECONDS)
    return _cond_sql(rule, p) + f""",
{p}r AS (SELECT slot, slot - row_number() OVER (ORDER BY slot) AS grp FROM {p}c WHERE cond),
{p}isl AS (SELECT min(slot) AS a, max(slot) AS b FROM {p}r GROUP BY grp),
{p}lst AS (SELECT max(slot) AS last FROM {p}c),
{p}st AS MATERIALIZED (SELECT '{rule.name}' AS alertname, '{rule.severity}' AS severity, a AS start_slot,
                 {_fmt('a')} AS pending_at, CASE WHEN b - a >= {k} THEN {_fmt(f'a + {k}')} END AS firing_at,
                 CASE WHEN b < last THEN {_fmt('b + 1')} END AS resolved_at, b - a >= {k} AS fired,
                 CASE WHEN b - a >= {k} THEN a + {k} END AS fire_slot, CASE WHEN b < last THEN b + 1 END AS end_slot,
                 last AS last_slot
          FROM {p}isl, {p}lst)"""


RULES = {
    "r1_high_error_rate": (A.HIGH_ERROR_RATE, A.error_rate_condition),
    "r2_high_fallback_rate": (A.HIGH_FALLBACK_RATE, A.fallback_condition),
    "r3_oov_drift": (A.OOV_DRIFT, A.oov_condition),
    "r4_low_confidence": (A.LOW_CONFIDENCE, A.low_confidence_condition),
    "r5_high_latency": (A.HIGH_LATENCY, A.high_latency_condition),
}


def _register(name, rule, cond_fn):
    sql = with_(LOG, _states_sql(rule, "x_")) + "SELECT " + ", ".join(PUBLIC) + " FROM x_st"

    def run(spark, sf):
        return A.alert_states(cond_fn(B.request_log(spark, sf)), rule).select(*PUBLIC)
    run.__doc__ = f"{name[:2].upper()}+R7: states of {rule.name} ({rule.severity}, for {rule.for_seconds}s)."
    return query(name, sql)(run)


for _n, (_r, _f) in RULES.items():
    _register(_n, _r, _f)


def all_states(spark, sf):
    """All five rules evaluated in one pass over the log, states materialised once."""
    log = B.request_log(spark, sf)
    return cut_lineage(A.alert_states_all(A.evaluate_rules(log)))


ALL_STATES_SQL = with_(LOG, *[_states_sql(r, f"p{i}_") for i, (r, _) in enumerate(RULES.values())],
                       "st AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM p{i}_st" for i in range(len(RULES))) + ")")


@query("r7_alert_states", ALL_STATES_SQL + "SELECT " + ", ".join(PUBLIC) + " FROM st")
def r7_alert_states(spark, sf):
    """pending/firing/resolved intervals of all five request-log rules."""
    return all_states(spark, sf).select(*PUBLIC)


@query("r6_heartbeat_gaps", """
WITH s AS (SELECT user_id, ts, epoch_us(ts) AS us,
                  lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS nus FROM events)
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_seen,
       strftime(make_timestamp(nus), '%Y-%m-%d %H:%M:%S.%f') AS seen_again, round((nus - us) / 1000000.0, 6) AS gap_s
FROM s WHERE (nus - us) / 1000000.0 > 86400""")
def r6_heartbeat_gaps(spark, sf):
    """Per-user silences longer than one day (heartbeat rule re-aimed at sources)."""
    return A.heartbeat_gaps(B.request_log(spark, sf), ["user_id"], 86400)


@query("r6_heartbeat_gaps_null_source", """
WITH s AS (SELECT u AS user_id, ts, epoch_us(ts) AS us,
                  lead(epoch_us(ts)) OVER (PARTITION BY u ORDER BY epoch_us(ts), event_id) AS nus
           FROM (SELECT *, nullif(user_id % 10, 0) AS u FROM events))
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_seen,
       strftime(make_timestamp(nus), '%Y-%m-%d %H:%M:%S.%f') AS seen_again, round((nus - us) / 1000000.0, 6) AS gap_s
FROM s WHERE (nus - us) / 1000000.0 > 600""")
def r6_heartbeat_gaps_null_source(spark, sf):
    """Silences over ten minutes of ten sources, one of them unknown."""
    log = B.request_log(spark, sf).withColumn("user_id", F.nullif(F.col("user_id") % 10, F.lit(0)))
    return A.heartbeat_gaps(log, ["user_id"], 600)


def _routes_sql(col: str) -> tuple[str, str, str]:
    rc = "CASE " + " ".join(f"WHEN {col} = '{s}' THEN '{r}'" for s, (r, _, _) in A.ROUTES.items()) + " END"
    gw = "CASE " + " ".join(f"WHEN {col} = '{s}' THEN {g}" for s, (_, g, _) in A.ROUTES.items()) + " END"
    ri = "CASE " + " ".join(f"WHEN {col} = '{s}' THEN {i}" for s, (_, _, i) in A.ROUTES.items()) + " END"
    return rc, gw, ri


_RC, _GW, _RI = _routes_sql("severity")
NOTICES_SQL = ALL_STATES_SQL.rstrip() + f""",
f AS (SELECT alertname, severity, {_RC} AS receiver, {_RI} AS ri, fire_slot * 30 + {_GW} AS t0,
             end_slot, coalesce(end_slot * 30, last_slot * 30 + 1) AS t_stop FROM st WHERE fired),
fire AS (SELECT alertname, severity, receiver, 'firing' AS kind, t0 + i * ri AS t FROM (
           SELECT *, unnest(range(0, CAST(greatest(ceil((t_stop - t0) / ri), 1) AS BIGINT))) AS i FROM f WHERE t0 < t_stop)),
res AS (SELECT alertname, severity, receiver, 'resolved' AS kind, end_slot * 30 AS t FROM f WHERE end_slot IS NOT NULL),
notices AS MATERIALIZED (SELECT alertname, severity, receiver, kind, CAST(t AS BIGINT) AS notify_s,
                   strftime(make_timestamp(CAST(t AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS notify_at
            FROM (SELECT * FROM fire UNION ALL SELECT * FROM res))
"""


@query("r8_notifications", NOTICES_SQL + "SELECT * FROM notices")
def r8_notifications(spark, sf):
    """Notification schedule of the fired alerts (group wait, repeats, resolve)."""
    return A.notifications(all_states(spark, sf))


@query("r9_inhibit", NOTICES_SQL.rstrip() + """,
src AS MATERIALIZED (SELECT s, e, unnest(range(s // 3600, (e - 1) // 3600 + 1)) AS hour FROM (
  SELECT fire_slot * 30 AS s, coalesce(end_slot, last_slot + 1) * 30 AS e FROM st WHERE fired AND severity = 'critical') WHERE s < e)
SELECT n.*, n.severity = 'warning' AND EXISTS (SELECT 1 FROM src WHERE src.hour = n.notify_s // 3600 AND n.notify_s >= src.s AND n.notify_s < src.e) AS inhibited
FROM notices n""")
def r9_inhibit(spark, sf):
    """Warnings inhibited while any critical alert fires (``equal`` labels as a
    parameter; the configured ``equal: [alertname]`` can never match)."""
    states = all_states(spark, sf)
    return A.inhibit(A.notifications(states), states, equal=())


@query("r9_inhibit_same_alert", NOTICES_SQL.rstrip() + """
SELECT n.*, n.severity = 'warning' AND EXISTS (SELECT 1 FROM st WHERE fired AND st.severity = 'critical' AND st.alertname = n.alertname
       AND n.notify_s >= fire_slot * 30 AND n.notify_s < coalesce(end_slot, last_slot + 1) * 30) AS inhibited FROM notices n""")
def r9_inhibit_same_alert(spark, sf):
    """R9 with the configured label: only a critical alert of the same name inhibits."""
    states = all_states(spark, sf)
    return A.inhibit(A.notifications(states), states, equal=("alertname",))
