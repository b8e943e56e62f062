"""Queries that run as streams over the given tables: all rows arrive, the watermark closes what it
passes, and what it has closed is the result.  The oracles restate the watermark: the largest
time, in whole milliseconds, less the delay (and, past a join that waits up to an hour for a
partner, less that hour and the millisecond in which its last partner counts)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import alerts as A
from tessera.operators.matching import tokenise
from tessera.operators.metrics import LATENCY_BUCKETS_MS, SKETCH_K, users_of_sketches
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.q_alerts import _states_sql
from tessera.plans.q_metrics import LIVE_QUALITY_SQL, timed_pairs
from tessera.plans.sqlparts import LEX, LOG, REQUESTS, tokens_of, with_
from tessera.session import ensure_checkpoint_dir, table
from tessera.streaming import drift, jobs

DELAY_MS = 600_000
_WM = f"wm AS (SELECT epoch_ms(max(ts)) - {DELAY_MS} AS w FROM log)"
_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("t1_stream_window_metrics", with_(LOG, _WM) + f"""
SELECT {_TS.format("time_bucket(INTERVAL 5 MINUTES, ts)")} AS window_start, input_type, status, CAST(count(*) AS BIGINT) AS requests,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors, round(sum(latency_ms), 6) AS latency_sum,
       CAST(count(*) FILTER (WHERE confidence >= 0.7) AS BIGINT) AS high_confidence,
       {", ".join(f"CAST(count(*) FILTER (WHERE latency_ms <= {b}) AS BIGINT) AS le_{b}" for b in LATENCY_BUCKETS_MS)}
FROM log GROUP BY time_bucket(INTERVAL 5 MINUTES, ts), input_type, status
HAVING epoch_ms(time_bucket(INTERVAL 5 MINUTES, ts)) + 300000 <= (SELECT w FROM wm)""")
def t1_stream_window_metrics(spark, sf):
    """Closed five-minute windows of the request stream."""
    out = jobs.stream_window_metrics(jobs.landing(B.request_log(spark, sf)))
    return jobs.available_now(out).select(_text(F.col("window_start")).alias("window_start"), "input_type", "status", "requests", "errors",
                                          "latency_sum", "high_confidence", *[f"le_{b}" for b in LATENCY_BUCKETS_MS])


@query("t2_stream_rolling_oov", with_(LOG, _WM) + """
SELECT event_id, CAST(user_id AS VARCHAR) AS key, round(avg(CAST(missed AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS rate
FROM log WHERE missed IS NOT NULL QUALIFY (epoch_us(ts) // 60000000 + 1) * 60000 < (SELECT w FROM wm)""")
def t2_stream_rolling_oov(spark, sf):
    """Share of missed requests among the last hundred of each user, in the order of time."""
    stream = jobs.landing(B.request_log(spark, sf).repartition("user_id"))
    return jobs.available_now(jobs.stream_rolling_n(stream, "user_id", F.col("missed")))


WINDOWED = [A.HIGH_ERROR_RATE, A.LOW_CONFIDENCE, A.HIGH_LATENCY]


@query("t3_live_alerts", with_(LOG, *[_states_sql(r, f"p{i}_") for i, r in enumerate(WINDOWED)],
                               "st AS (" + " UNION ALL ".join(f"SELECT * FROM p{i}_st" for i in range(len(WINDOWED))) + ")",
                               f"lastslot AS (SELECT ((epoch_us(max(ts)) - 1) // 1000 - {DELAY_MS}) // 30000 AS s FROM log)") + """
SELECT * FROM (SELECT alertname, 'pending' AS state, start_slot AS slot FROM st
               UNION ALL SELECT alertname, 'firing', fire_slot FROM st WHERE fired
               UNION ALL SELECT alertname, CASE WHEN fired THEN 'resolved' ELSE 'inactive' END, end_slot FROM st WHERE end_slot IS NOT NULL)
WHERE slot <= (SELECT s FROM lastslot)""")
def t3_live_alerts(spark, sf):
    """Alert transitions straight from the request stream (T1 slots, R1/R4/R5, state machine)."""
    return jobs.available_now(jobs.stream_live_alerts(jobs.landing(B.request_log(spark, sf))))


@query("t3_stream_alert_states", with_(LOG, *[_states_sql(r, f"p{i}_") for i, r in enumerate([A.HIGH_FALLBACK_RATE, A.OOV_DRIFT])],
                                       "st AS (SELECT * FROM p0_st UNION ALL SELECT * FROM p1_st)") + """
SELECT alertname, 'pending' AS state, start_slot AS slot FROM st
UNION ALL SELECT alertname, 'firing', fire_slot FROM st WHERE fired
UNION ALL SELECT alertname, CASE WHEN fired THEN 'resolved' ELSE 'inactive' END, end_slot FROM st WHERE end_slot IS NOT NULL""")
def t3_stream_alert_states(spark, sf):
    """The state machine on a stream of evaluations of the two gauges."""
    rules = [A.HIGH_FALLBACK_RATE, A.OOV_DRIFT]
    conds = A.evaluate_rules(B.request_log(spark, sf)).where(F.col("alertname").isin([r.name for r in rules]))
    return jobs.available_now(jobs.stream_alert_state(jobs.landing(conds), {r.name: r.for_seconds for r in rules}))


@query("r6_stream_heartbeats", with_(LOG, _WM.replace("FROM log", "FROM events")) + """,
s AS (SELECT user_id, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nus, 1000 * w AS now FROM log, wm),
g AS (SELECT *, nus IS NOT NULL AND nus <= now AS again FROM s WHERE us <= now)
SELECT user_id, 'down' AS kind, us AS last_us, NULL::BIGINT AS again_us FROM g WHERE CASE WHEN again THEN nus ELSE now END - us > 3600000000
UNION ALL SELECT user_id, 'up', us, nus FROM g WHERE again AND nus - us > 3600000000""")
def r6_stream_heartbeats(spark, sf):
    """R6 on the stream: users silent for an hour, those who never come back included."""
    return jobs.available_now(jobs.stream_heartbeats(jobs.landing(B.request_log(spark, sf).repartition("user_id")), ["user_id"], 3600))


def _timed_requests(spark, sf):
    """Requests with a time: ten minutes from one conversation to the next."""
    return B.requests(spark, sf).withColumn("ts", F.timestamp_seconds(F.shiftright("request_id", 32) * 600))


@query("t4_stream_oov", with_(LEX, REQUESTS, f"""
wm AS (SELECT max(request_id // 4294967296) * 600000 - {DELAY_MS} AS w FROM requests),
tok AS (SELECT request_id // 4294967296 * 600 // 3600 AS h, user_id, unnest({tokens_of("lower(text)")}) AS token FROM requests)""") + """
SELECT strftime(make_timestamp(h * 3600000000), '%Y-%m-%d %H:%M:%S') AS window_start, user_id, CAST(count(*) AS BIGINT) AS tokens,
       CAST(count(*) FILTER (WHERE v.term IS NULL) AS BIGINT) AS oov_tokens,
       round(count(*) FILTER (WHERE v.term IS NULL) / count(*), 6) AS oov_rate
FROM tok LEFT JOIN (SELECT DISTINCT lower(term) AS term FROM lex) v ON v.term = tok.token
WHERE (h + 1) * 3600000 <= (SELECT w FROM wm) GROUP BY h, user_id""")
def t4_stream_oov(spark, sf):
    """T4: out-of-vocabulary tokens by user and closed hour of the request stream."""
    out = jobs.stream_oov(jobs.landing(_timed_requests(spark, sf)), B.lexicon(spark, sf), window="1 hour")
    return jobs.available_now(out).select(_text(F.col("window_start")).alias("window_start"), "user_id", "tokens", "oov_tokens", "oov_rate")


@query("t5_stream_new_lexicon", r"""
SELECT DISTINCT term FROM (SELECT unnest([p_type, p_brand, p_name]) AS term FROM part WHERE p_size % 3 = 0)
WHERE regexp_full_match(term, '[abcdefghijklmnoprstuvwyzäìABCDEFGHIJKLMNOPRSTUVWYZÄÌ''ʼ ]*')""")
def t5_stream_new_lexicon(spark, sf):
    """T5: submitted terms, each once, that the character set allows."""
    subs = table(spark, sf, "part").where("p_size % 3 = 0").select(
        F.explode(F.array("p_type", "p_brand", "p_name")).alias("term"), F.timestamp_seconds(F.col("p_partkey") + 1).alias("ts"))
    return jobs.available_now(jobs.stream_new_lexicon(jobs.landing(subs), watermark="3650 days")).select("term")


@query("t6_stream_drift", with_(LEX, REQUESTS, f"""
vocab AS (SELECT DISTINCT lower(term) AS token FROM lex),
doc AS (SELECT unnest({tokens_of("lower(text)")}) AS token FROM benchmark),
tok AS (SELECT unnest({tokens_of("lower(text)")}) AS token FROM requests),
b AS (SELECT count(*) FILTER (WHERE v.token IS NULL) / count(*) AS r FROM doc LEFT JOIN vocab v USING (token)),
l AS (SELECT count(*) FILTER (WHERE v.token IS NULL) / count(*) AS r FROM tok LEFT JOIN vocab v USING (token))""") + """
SELECT CAST(0 AS BIGINT) AS batch_id, CAST(1 AS BIGINT) AS baseline_version, round(b.r, 6) AS baseline_oov, round(l.r, 6) AS live_oov,
       l.r > b.r * 1.15 AS drift_detected, (SELECT CAST(count(*) AS BIGINT) FROM requests) AS n_requests FROM b, l""")
def t6_stream_drift(spark, sf):
    """The requests as a micro-batch, judged against the benchmark's vocabulary rate."""
    lex = B.lexicon(spark, sf)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift-{uuid.uuid4().hex}"
    drift.publish_baseline(folder, tokenise(table(spark, sf, "benchmark"), "text", [], lower=True), lex)
    drift.stream_drift(jobs.landing(B.requests(spark, sf)), lex, folder, f"{folder}/progress").awaitTermination()
    return drift.results(spark, folder).select("batch_id", "baseline_version", "baseline_oov", "live_oov", "drift_detected", "n_requests")


@query("m22_stream_live_quality", f"""
SELECT window_start, pairs, wer, bleu FROM ({LIVE_QUALITY_SQL.replace("AND b.turn = a.turn + 1", "AND b.turn = a.turn + 1 WHERE a.turn % 5 < 4")})
WHERE epoch(CAST(window_start AS TIMESTAMP)) + 3600 <= (SELECT max(conv_id * 600 + 86400) - 600 - 3600.001 FROM conversations a JOIN
      (SELECT conv_id, turn - 1 AS turn FROM conversations) b USING (conv_id, turn))""")
def m22_stream_live_quality(spark, sf):
    """Answers meet labels that come up to an hour later (others don't count), closed hours only."""
    pairs = timed_pairs(spark, sf)
    turn = F.col("pair_id").bitwiseAND(0xFFFFFFFF)
    answers = pairs.select("pair_id", "ts", "hypothesis")
    labels = pairs.select("pair_id", F.timestamp_seconds(F.unix_seconds("ts") + F.when(turn % 5 < 4, turn % 5 * 900).otherwise(7200)).alias("ts"), "reference")
    return jobs.available_now(jobs.stream_live_quality(jobs.landing(answers), jobs.landing(labels), "1 hour", "pair_id"))


@query("m13_stream_user_sketches", with_(LOG, _WM, "d AS (SELECT *, time_bucket(INTERVAL 5 MINUTES, ts) AS b FROM log)",
                                         "c AS (SELECT * FROM d WHERE epoch_ms(b) + 300000 <= (SELECT w FROM wm))") + """
SELECT strftime(date_trunc('day', b), '%Y-%m-%d') AS day, CAST(count(DISTINCT user_id) AS BIGINT) AS exact, true AS within_bound FROM c GROUP BY 1
UNION ALL SELECT 'all', CAST(count(DISTINCT user_id) AS BIGINT), true FROM c""")
def m13_stream_user_sketches(spark, sf):
    """Days and all time as unions of the stream's five-minute sketches, held against exact counts."""
    log = B.request_log(spark, sf)
    sk = jobs.available_now(jobs.stream_user_sketches(jobs.landing(log)))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
    seen = log.select(F.window("ts", "5 minutes")["start"].alias("window_start"), "user_id").join(
        sk.select(F.col("window_start").cast("timestamp_ntz").alias("window_start")).distinct(), "window_start", "left_semi")
    both = []
    for by, of in ((day("window_start"), day("window_start")), (F.lit("all").alias("day"), F.lit("all").alias("day"))):
        exact = seen.groupBy(of).agg(F.countDistinct("user_id").alias("exact"))
        both.append(exact.join(users_of_sketches(sk, [by]), "day"))
    bound = 3 * 1.04 / 2 ** (SKETCH_K / 2)
    return both[0].unionByName(both[1]).select("day", F.col("exact").cast("bigint").alias("exact"),
                                               (F.abs(F.col("users") - F.col("exact")) <= F.col("exact") * bound + 1).alias("within_bound"))
