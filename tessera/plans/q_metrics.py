"""Queries for request-log analytics (M1–M22).  Tests use 1 h / 1 day windows
(the test log has about one request per 4 minutes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import matching, metrics, quality
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.q_matching import BREAKDOWN_SQL, _lookup
from tessera.plans.q_profile import WER_PAIRS_SQL, _bleu_sql
from tessera.plans.sqlparts import LEX, LOG, tokens_of, with_
from tessera.session import table

HOUR = "1 hour"
BOUNDS = metrics.LATENCY_BUCKETS_MS
CB = metrics.CONFIDENCE_BUCKETS


def _ws(ts: str = "ts", interval: str = "1 hour") -> str:
    return f"strftime(time_bucket(INTERVAL '{interval}', {ts}), '%Y-%m-%d %H:%M:%S')"


def _cums_sql(v: str, bounds) -> str:
    return "[" + ", ".join(f"count(*) FILTER (WHERE {v} <= {b})" for b in bounds) + "]"


def quantile_sql(q: float, cums: str, total: str, bounds) -> str:
    rank = f"({q} * {total})"
    idx = f"coalesce(list_position(list_transform({cums}, lambda c: c >= {rank}), true), 0)"
    b = "[" + ", ".join(f"{float(x)}" for x in bounds) + "]"
    upper = f"{b}[greatest({idx}, 1)]"
    lower = f"(CASE WHEN {idx} > 1 THEN {b}[greatest({idx} - 1, 1)] ELSE 0.0 END)"
    prev = f"(CASE WHEN {idx} > 1 THEN {cums}[greatest({idx} - 1, 1)] ELSE 0 END)"
    cnt = f"({cums}[greatest({idx}, 1)] - {prev})"
    return (f"(CASE WHEN {total} = 0 THEN NULL WHEN {idx} = 0 THEN {float(bounds[-1])} "
            f"WHEN {idx} = 1 AND {upper} <= 0 THEN {upper} "
            f"ELSE {lower} + ({upper} - {lower}) * ({rank} - {prev}) / {cnt} END)")


@query("m1_request_counts", with_(LOG) + f"""
SELECT {_ws()} AS window_start, input_type, status, CAST(count(*) AS BIGINT) AS requests,
       round(count(*) / 3600.0 * 60.0, 6) AS per_min
FROM log GROUP BY ALL""")
def m1_request_counts(spark, sf):
    """M1: requests per hour by input type and status, with per-minute rate."""
    return metrics.request_counts(B.request_log(spark, sf), HOUR)


@query("m2_latency_histogram", with_(LOG, f"""
a AS (SELECT {_ws()} AS window_start, {_cums_sql('latency_ms', BOUNDS)[:-1]}, count(*)] AS cum,
             sum(latency_ms) AS latency_sum, count(*) AS latency_count FROM log GROUP BY 1)""") + f"""
SELECT window_start, le, CAST(c AS BIGINT) AS cum_count, round(latency_sum, 6) AS latency_sum,
       CAST(latency_count AS BIGINT) AS latency_count
FROM (SELECT *, unnest({[str(b) for b in BOUNDS] + ['+Inf']}) AS le, unnest(cum) AS c FROM a)""")
def m2_latency_histogram(spark, sf):
    """M2: cumulative latency buckets per hour."""
    return metrics.latency_histogram(B.request_log(spark, sf), HOUR)


@query("m3_latency_quantiles", with_(LOG, f"""
a AS (SELECT {_ws()} AS window_start, {_cums_sql('latency_ms', BOUNDS)} AS cums, count(*) AS total FROM log GROUP BY 1)""")
       + f"""
SELECT window_start, round({quantile_sql(0.5, 'cums', 'total', BOUNDS)}, 6) AS p50,
       round({quantile_sql(0.95, 'cums', 'total', BOUNDS)}, 6) AS p95,
       round({quantile_sql(0.99, 'cums', 'total', BOUNDS)}, 6) AS p99 FROM a""")
def m3_latency_quantiles(spark, sf):
    """M3: bucket-interpolated p50/p95/p99 latency per hour."""
    return metrics.latency_quantiles(B.request_log(spark, sf), HOUR)


@query("m4_confidence_histogram", with_(LOG, f"""
a AS (SELECT {_ws()} AS window_start, input_type, {_cums_sql('confidence', CB)[:-1]}, count(*)] AS cum
      FROM log GROUP BY 1, 2)""") + f"""
SELECT window_start, input_type, le, CAST(c AS BIGINT) AS cum_count, round(c / 3600.0, 6) AS rate
FROM (SELECT *, unnest({[str(b) for b in CB] + ['+Inf']}) AS le, unnest(cum) AS c FROM a)""")
def m4_confidence_histogram(spark, sf):
    """M4: cumulative confidence buckets per hour and input type."""
    return metrics.confidence_histogram(B.request_log(spark, sf), HOUR)


@query("m5_high_confidence_ratio", with_(LOG) + f"""
SELECT {_ws()} AS window_start,
       CAST(count(*) FILTER (WHERE status = 'success' AND confidence >= 0.7) AS BIGINT) AS high,
       CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS success,
       round((count(*) FILTER (WHERE status = 'success' AND confidence >= 0.7) / 3600.0)
             / greatest(count(*) FILTER (WHERE status = 'success') / 3600.0, 0.0001), 6) AS ratio
FROM log GROUP BY 1""")
def m5_high_confidence_ratio(spark, sf):
    """M5: high-confidence share of successes per hour."""
    return metrics.high_confidence_ratio(B.request_log(spark, sf), HOUR)


@query("m6_error_ratio", with_(LOG) + f"""
SELECT {_ws()} AS window_start, input_type,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors, CAST(count(*) AS BIGINT) AS total,
       round((count(*) FILTER (WHERE status = 'error') / 3600.0) / greatest(count(*) / 3600.0, 0.0001), 6) AS ratio
FROM log GROUP BY 1, 2""")
def m6_error_ratio(spark, sf):
    """M6: error ratio per hour and input type."""
    return metrics.error_ratio(B.request_log(spark, sf), HOUR)


def _rolling_sql(flag: str) -> str:
    return with_(LOG) + f"""
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id,
       round(avg(CAST({flag} AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS rate FROM log"""


def _fmt_ts(df):
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("m7_rolling_oov_rate", _rolling_sql("missed"))
def m7_rolling_oov_rate(spark, sf):
    """M7: share of the last 100 requests (per user) with any missed token."""
    log = B.request_log(spark, sf)
    return _fmt_ts(metrics.rolling_rate(log, F.col("missed"), ["user_id"], ["ts", "event_id"]))


NULL_USERS = "FROM (SELECT * REPLACE (nullif(user_id % 10, 0) AS user_id) FROM events)"


@query("m7_rolling_oov_rate_null_user", _rolling_sql("missed").replace("FROM events", NULL_USERS))
def m7_rolling_oov_rate_null_user(spark, sf):
    """M7 with ten users, one of them unknown."""
    log = B.request_log(spark, sf).withColumn("user_id", F.nullif(F.col("user_id") % 10, F.lit(0)))
    return _fmt_ts(metrics.rolling_rate(log, F.col("missed"), ["user_id"], ["ts", "event_id"]))


@query("m8_rolling_fallback_rate", _rolling_sql("confidence < 0.4"))
def m8_rolling_fallback_rate(spark, sf):
    """M8: share of the last 100 requests (per user) that fell back (confidence < 0.4)."""
    log = B.request_log(spark, sf)
    return _fmt_ts(metrics.rolling_rate(log, F.col("confidence") < metrics.FALLBACK_THRESHOLD,
                                        ["user_id"], ["ts", "event_id"]))


def _breakdown_with_user(spark, sf):
    req = B.requests(spark, sf)
    bd = matching.gloss_tokens(req, _lookup(spark, sf))
    return bd.join(req.select("request_id", "user_id"), "request_id")


BD_USER_SQL = BREAKDOWN_SQL.rstrip() + """,
bdu AS (SELECT b.*, r.user_id FROM breakdown b JOIN requests r USING (request_id))
"""


@query("m9_fuzzy_correction_ratio", BD_USER_SQL + """
SELECT user_id, CAST(count(*) FILTER (WHERE fuzzy) AS BIGINT) AS corrected, CAST(count(*) AS BIGINT) AS tokens,
       round(count(*) FILTER (WHERE fuzzy) / greatest(CAST(count(*) AS DOUBLE), 0.0001), 6) AS ratio
FROM bdu GROUP BY user_id""")
def m9_fuzzy_correction_ratio(spark, sf):
    """M9: fuzzy-corrected share of tokens per user."""
    return metrics.fuzzy_correction_ratio(_breakdown_with_user(spark, sf), by=["user_id"])


@query("m10_fuzzy_by_distance", BD_USER_SQL + """
SELECT edit_distance, CAST(count(*) AS BIGINT) AS corrections FROM bdu WHERE fuzzy GROUP BY edit_distance""")
def m10_fuzzy_by_distance(spark, sf):
    """Fuzzy corrections per edit distance."""
    return metrics.fuzzy_by_distance(_breakdown_with_user(spark, sf))


BD_TIME_SQL = BREAKDOWN_SQL.rstrip() + """,
bdt AS (SELECT *, make_timestamp((request_id // 4294967296 * 600 + request_id % 4294967296 * 20) * 1000000) AS ts FROM breakdown),
bdw AS (SELECT *, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start FROM bdt)
"""


def _breakdown_in_time(spark, sf):
    """Requests ten minutes apart by conversation and 20 s by turn."""
    bd = matching.gloss_tokens(B.requests(spark, sf), _lookup(spark, sf))
    conv, turn = F.shiftright("request_id", 32), F.col("request_id") % 4294967296
    return bd.withColumn("ts", F.timestamp_seconds(conv * 600 + turn * 20))


@query("m9_fuzzy_ratio_15m", BD_TIME_SQL + """
SELECT window_start, CAST(count(*) FILTER (WHERE fuzzy) AS BIGINT) AS corrected, CAST(count(*) AS BIGINT) AS tokens,
       round(count(*) FILTER (WHERE fuzzy) / greatest(CAST(count(*) AS DOUBLE), 0.0001), 6) AS ratio
FROM bdw GROUP BY window_start""")
def m9_fuzzy_ratio_15m(spark, sf):
    """M9 per window of 15 minutes."""
    return metrics.fuzzy_correction_ratio(_breakdown_in_time(spark, sf), window="15 minutes")


@query("m10_fuzzy_rate_by_distance", BD_TIME_SQL + """
SELECT window_start, edit_distance, CAST(count(*) AS BIGINT) AS corrections, round(count(*) / 15.0, 6) AS per_minute
FROM bdw WHERE fuzzy GROUP BY window_start, edit_distance""")
def m10_fuzzy_rate_by_distance(spark, sf):
    """M10 per window of 15 minutes, with the rate per minute."""
    return metrics.fuzzy_by_distance(_breakdown_in_time(spark, sf), window="15 minutes")


@query("m11_top_oov_words", with_(LEX, f"""
toks AS (SELECT unnest({tokens_of('lower(text)')}) AS token FROM documents),
oov AS (SELECT token FROM toks WHERE token NOT IN (SELECT lower(term) FROM lex)),
w AS (SELECT nullif(substr(regexp_replace(lower(token), '[^\\p{{L}}\\p{{N}}ìäáéíóúñ]', '', 'g'), 1, 20), '') AS word FROM oov)""")
       + """
SELECT word, CAST(count(*) AS BIGINT) AS count FROM w WHERE word IS NOT NULL
GROUP BY word ORDER BY count DESC, word LIMIT 10""")
def m11_top_oov_words(spark, sf):
    """Top-10 cleaned OOV words of the documents."""
    d = table(spark, sf, "documents")
    toks = matching.tokenise(d, "text", ["doc_id"], lower=True)
    return metrics.top_oov_words(matching.oov_tokens(toks, B.lexicon(spark, sf)))


@query("m12_requests_by_user", with_(LOG) + """
SELECT user_id, CAST(count(*) AS BIGINT) AS requests FROM log
WHERE ts > (SELECT max(ts) FROM log) - INTERVAL 3600 SECONDS GROUP BY user_id""")
def m12_requests_by_user(spark, sf):
    """Requests per user in the last hour of the log."""
    return metrics.requests_by_user(B.request_log(spark, sf))


@query("m13_active_users", with_(LOG, """
c AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS s, count(DISTINCT user_id) AS n FROM log GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(s) FROM c), (SELECT max(s) FROM c), INTERVAL '1 hour')) AS s)""")
       + """
SELECT strftime(g.s, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(coalesce(c.n, 0) AS BIGINT) AS active_users
FROM g LEFT JOIN c ON c.s = g.s""")
def m13_active_users(spark, sf):
    """Distinct active users per hour (0 for silent hours)."""
    return metrics.active_users(B.request_log(spark, sf), HOUR)


@query("m14_unique_users", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users FROM events")
def m14_unique_users(spark, sf):
    """Distinct users over all time."""
    return metrics.unique_users(B.request_log(spark, sf))


@query("m15_oov_by_user", BD_USER_SQL + """
SELECT user_id, CAST(count(*) FILTER (WHERE NOT found) AS BIGINT) AS oov_tokens FROM bdu
GROUP BY user_id HAVING count(*) FILTER (WHERE NOT found) > 0""")
def m15_oov_by_user(spark, sf):
    """Missed tokens per user (only users with misses)."""
    return metrics.oov_by_user(_breakdown_with_user(spark, sf))


@query("m16_submissions_by_window", with_(LOG) + f"""
SELECT {_ws()} AS window_start, CAST(count(*) AS BIGINT) AS submissions, round(count(*) / 3600.0 * 60.0, 6) AS per_min
FROM log WHERE is_submission GROUP BY 1""")
def m16_submissions_by_window(spark, sf):
    """Accepted submissions per hour."""
    return metrics.submissions_by_window(B.request_log(spark, sf), HOUR)


@query("m16_submissions_by_user", with_(LOG) + """
SELECT user_id, CAST(count(*) AS BIGINT) AS submissions FROM log WHERE is_submission GROUP BY user_id""")
def m16_submissions_by_user(spark, sf):
    """Accepted submissions per user."""
    return metrics.submissions_by_user(B.request_log(spark, sf))


@query("m17_user_rate", with_(LOG) + """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, CAST(count(*) AS BIGINT) AS requests,
       round(count(*) / 7200.0, 6) AS rate
FROM (SELECT user_id, unnest([time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour',
                              time_bucket(INTERVAL '1 hour', ts)]) AS s FROM log)
GROUP BY s, user_id""")
def m17_user_rate(spark, sf):
    """Per-user request rate in 2 h windows sliding by 1 h."""
    return metrics.user_rate(B.request_log(spark, sf), "2 hours", "1 hour")


M18_SQL = with_(LOG, """
ev AS (SELECT event_id, epoch_us(ts) AS t_us, 1 AS delta FROM log
       UNION ALL SELECT event_id, epoch_us(ts) + CAST(round(latency_ms * 1000.0) AS BIGINT), -1 FROM log),
s AS (SELECT event_id, t_us, delta, CAST(sum(delta) OVER (ORDER BY t_us, delta, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS in_flight FROM ev)""")


@query("m18_in_flight", M18_SQL + "SELECT event_id, t_us, CAST(delta AS INTEGER) AS delta, in_flight FROM s")
def m18_in_flight(spark, sf):
    """In-flight request count after every start/end."""
    return metrics.in_flight(B.request_log(spark, sf))


@query("m18_peak_in_flight", M18_SQL + """
SELECT CAST(floor(t_us / 3600000000) AS BIGINT) AS window_index, CAST(max(in_flight) AS BIGINT) AS peak_in_flight
FROM s GROUP BY 1""")
def m18_peak_in_flight(spark, sf):
    """Hourly peak concurrency."""
    return metrics.peak_in_flight(metrics.in_flight(B.request_log(spark, sf)))


@query("m19_latest_value", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS set_at FROM events GROUP BY user_id""")
def m19_latest_value(spark, sf):
    """Last value (event type as version label) per user."""
    e = table(spark, sf, "events")
    out = metrics.latest_value(e, ["user_id"], "event_type", "ts", tie="event_id")
    return out.withColumn("set_at", F.date_format("set_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


PHASES = (("baseline", "2024-01-01 00:00:00", "2024-01-11 00:00:00"),
          ("drift", "2024-01-11 00:00:00", "2024-01-21 00:00:00"),
          ("recovery", "2024-01-21 00:00:00", "2024-02-01 00:00:00"))


@query("m20_phase_summary", with_(LOG) + """
SELECT phase, CAST(count(*) AS BIGINT) AS sent, CAST(count(*) FILTER (WHERE confidence >= 0.7) AS BIGINT) AS high_conf,
       CAST(count(*) FILTER (WHERE confidence < 0.7) AS BIGINT) AS low_conf,
       round(count(*) FILTER (WHERE confidence >= 0.7) / greatest(count(*), 1) * 100.0, 6) AS high_pct
FROM (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-11' THEN 'baseline'
                     WHEN ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21' THEN 'drift'
                     WHEN ts >= TIMESTAMP '2024-01-21' AND ts < TIMESTAMP '2024-02-01' THEN 'recovery' END AS phase
      FROM log) WHERE phase IS NOT NULL GROUP BY phase""")
def m20_phase_summary(spark, sf):
    """Per-phase sent / high / low confidence summary."""
    return metrics.phase_summary(B.request_log(spark, sf), PHASES)


@query("m21_counter_increase", """
WITH s AS (SELECT event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS v,
                  lag(CAST(json_extract(props, '$.k') AS DOUBLE)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p
           FROM events)
SELECT event_type, round(sum(CASE WHEN p IS NULL THEN 0.0 WHEN v < p THEN v ELSE v - p END), 6) AS increase,
       CAST(count(*) FILTER (WHERE v < p) AS BIGINT) AS resets, CAST(count(*) AS BIGINT) AS samples
FROM s GROUP BY event_type""")
def m21_counter_increase(spark, sf):
    """Reset-tolerant increase of a sampled counter (props.k per event type)."""
    e = table(spark, sf, "events").select("event_type", "ts", "event_id",
                                          F.get_json_object("props", "$.k").cast("double").alias("k"))
    return metrics.counter_increase(e, ["event_type"], "ts", "k", tie="event_id")


@query("m21_counter_increase_null_key", """
WITH s AS (SELECT nullif(event_type, 'click') AS event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS v,
                  lag(CAST(json_extract(props, '$.k') AS DOUBLE)) OVER (PARTITION BY nullif(event_type, 'click') ORDER BY ts, event_id) AS p
           FROM events)
SELECT event_type, round(sum(CASE WHEN p IS NULL THEN 0.0 WHEN v < p THEN v ELSE v - p END), 6) AS increase,
       CAST(count(*) FILTER (WHERE v < p) AS BIGINT) AS resets, CAST(count(*) AS BIGINT) AS samples
FROM s GROUP BY event_type""")
def m21_counter_increase_null_key(spark, sf):
    """M21 where one counter has no name."""
    e = table(spark, sf, "events").select(F.nullif("event_type", F.lit("click")).alias("event_type"), "ts", "event_id",
                                          F.get_json_object("props", "$.k").cast("double").alias("k"))
    return metrics.counter_increase(e, ["event_type"], "ts", "k", tie="event_id")


@query("m22_live_wer_by_user", WER_PAIRS_SQL + """
SELECT user_id, round(CASE WHEN sum(ref_words) > 0 THEN sum(edits) / sum(ref_words) ELSE 1.0 END, 4) AS wer,
       CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(ref_words) AS BIGINT) AS ref_words,
       CAST(count(*) AS BIGINT) AS pairs FROM pe GROUP BY user_id""")
def m22_live_wer_by_user(spark, sf):
    """WER of adjacent turns per user group (brute-force checked in tests)."""
    return quality.word_error_rate(B.text_pairs(spark, sf), by=["user_id"])


@query("m22_live_bleu_by_user", _bleu_sql("user_id"))
def m22_live_bleu_by_user(spark, sf):
    """BLEU of adjacent turns per user group."""
    return quality.corpus_bleu(B.text_pairs(spark, sf), by=["user_id"])


@query("m22_live_bleu_null_user", _bleu_sql("user_id").replace("AS user_id", "AS user_id_")
       .replace("tok AS (SELECT user_id, pair_id", "tok AS (SELECT coalesce(nullif(user_id_, 0), -1) AS user_id, pair_id")
       .replace("\nSELECT user_id, round(", "\nSELECT nullif(user_id, -1) AS user_id, round("))
def m22_live_bleu_null_user(spark, sf):
    """BLEU per user where one user is unknown."""
    pairs = B.text_pairs(spark, sf).withColumn("user_id", F.nullif("user_id", F.lit(0)))
    return quality.corpus_bleu(pairs, by=["user_id"])


def _by_hour(sql: str) -> str:
    """The measure per hour instead of per user; times as in ``timed_pairs``."""
    return sql.replace("a.conv_id % 50 AS user_id", "strftime(make_timestamp((a.conv_id * 600 + 86400) // 3600 * 3600000000), '%Y-%m-%d %H:%M:%S') AS user_id")


LIVE_QUALITY_SQL = f"""
SELECT user_id AS window_start, pairs, wer, bleu FROM (
  {_by_hour(WER_PAIRS_SQL)} SELECT user_id, round(sum(edits) / sum(ref_words), 4) AS wer, CAST(count(*) AS BIGINT) AS pairs FROM pe GROUP BY user_id)
JOIN ({_by_hour(_bleu_sql("user_id"))}) USING (user_id)"""


def timed_pairs(spark, sf):
    """B4 with a time: ten minutes from one conversation to the next, from the second day on."""
    return B.text_pairs(spark, sf).withColumn("ts", F.timestamp_seconds(F.shiftright("pair_id", 32) * 600 + 86400))


@query("m22_live_quality", LIVE_QUALITY_SQL)
def m22_live_quality(spark, sf):
    """Word error rate and BLEU of adjacent turns per hour."""
    return quality.live_quality(timed_pairs(spark, sf), "1 hour")
