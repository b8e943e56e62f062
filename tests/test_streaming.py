"""Streaming jobs (T1–T6, S8) against their batch twins on small tables."""

import os

from pyspark.sql import functions as F

from tessera.operators import alerts, metrics, profile, matching
from tessera.plans import bindings as B
from tessera.sources import io
from tessera.streaming import jobs

from conftest import SF_SMALL

LOG_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, input_type STRING, "
              "status STRING, latency_ms DOUBLE, confidence DOUBLE, missed BOOLEAN, is_submission BOOLEAN")


def _run(df, tmp, name, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", os.path.join(tmp, "ck_" + name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def _log_dir(spark, tmp):
    path = os.path.join(tmp, "log")
    B.request_log(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return path


def test_t1_s8_m1_window_metrics_match_batch(spark, tmp):
    stream = io.request_stream(spark, _log_dir(spark, tmp), LOG_SCHEMA)
    out = _run(jobs.stream_window_metrics(stream, "1 hour", watermark="1 hour"), tmp, "t1", "complete")
    got = {(str(r.window_start)[:19], r.input_type, r.status): r.requests for r in out.collect()}
    batch = metrics.request_counts(B.request_log(spark, SF_SMALL), "1 hour")
    exp = {(r.window_start, r.input_type, r.status): r.requests for r in batch.collect()}
    assert got == exp


def test_t1_m2_m5_buckets_match_batch(spark, tmp):
    stream = io.request_stream(spark, _log_dir(spark, tmp), LOG_SCHEMA)
    got = _run(jobs.stream_window_metrics(stream, "1 day", watermark="1 day"), tmp, "t1b", "complete").toPandas()
    log = B.request_log(spark, SF_SMALL).toPandas()
    for b in metrics.LATENCY_BUCKETS_MS:
        assert got[f"le_{b}"].sum() == (log["latency_ms"] <= b).sum()
    for b in metrics.CONFIDENCE_BUCKETS:
        assert got[f"conf_{b}"].sum() == (log["confidence"] <= b).sum()
    assert got["high_confidence"].sum() == (log["confidence"] >= metrics.HIGH_CONFIDENCE).sum()


def test_t2_t3_more_rows_than_an_arrow_batch(spark, tmp):
    """A key's rows come in several chunks, out of order, and are still taken in order."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = spark.range(600).select(F.pmod(F.col("id") * 7919, F.lit(600)).alias("slot"))
        evals = rows.select("slot", (F.col("slot") % 20 < 12).alias("cond"), F.lit("NoSuchRule").alias("alertname"))
        evals.coalesce(1).write.parquet(os.path.join(tmp, "many"))
        stream = spark.readStream.schema("slot BIGINT, cond BOOLEAN, alertname STRING").parquet(os.path.join(tmp, "many"))
        out = _run(jobs.stream_alert_state(stream, {}), tmp, "t3many")
        got = [(r.state, r.slot) for r in out.orderBy("slot", F.desc("state")).collect()]
        want = [(s, 20 * k + d) for k in range(30) for s, d in (("pending", 0), ("firing", 0), ("resolved", 12))]
        assert got == want  # a rule without a wait fires at once
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_t4_windows_match_batch(spark, tmp):
    lex = B.lexicon(spark, SF_SMALL)
    req = B.requests(spark, SF_SMALL).withColumn("ts", F.timestamp_seconds(F.shiftright("request_id", 32) * 600))
    req.write.parquet(os.path.join(tmp, "req"))
    stream = spark.readStream.schema(req.schema).parquet(os.path.join(tmp, "req"))
    out = _run(jobs.stream_oov(stream, lex, window="1 hour", watermark="1 hour"), tmp, "t4w", "complete")
    toks = matching.tokenise(req.withColumn("w", F.window("ts", "1 hour")["start"]), "text", ["request_id", "user_id", "w"], lower=True)
    want = {(r.w, r.user_id): (r.total_tokens, r.oov_tokens) for r in profile.oov_rate(toks, lex, by=["w", "user_id"]).collect()}
    assert {(r.window_start, r.user_id): (r.tokens, r.oov_tokens) for r in out.collect()} == want


def test_t3_r1_r7_alert_state_machine_matches_batch(spark, tmp):
    log = B.request_log(spark, SF_SMALL)
    cond = alerts.error_rate_condition(log).withColumn("alertname", F.lit(alerts.HIGH_ERROR_RATE.name))
    path = os.path.join(tmp, "evals")
    cond.write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema("slot BIGINT, cond BOOLEAN, alertname STRING").parquet(path)
    out = _run(jobs.stream_alert_state(stream, {alerts.HIGH_ERROR_RATE.name: alerts.HIGH_ERROR_RATE.for_seconds}),
               tmp, "t3")
    got = sorted((r.state, r.slot) for r in out.collect())
    st = alerts.alert_states(cond, alerts.HIGH_ERROR_RATE).collect()
    exp = []
    for r in st:
        exp.append(("pending", r.start_slot))
        if r.fired:
            exp.append(("firing", r._fire_slot))
        if r._end_slot is not None:
            exp.append(("resolved" if r.fired else "inactive", r._end_slot))
    assert got == sorted(exp)


def test_t4_a1_stream_static_oov(spark, tmp):
    path = os.path.join(tmp, "req")
    B.requests(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema("request_id BIGINT, user_id BIGINT, text STRING").parquet(path)
    lex = B.lexicon(spark, SF_SMALL)
    out = _run(jobs.stream_oov(stream, lex), tmp, "t4", "complete")
    got = {r.user_id: (r.tokens, r.oov_tokens) for r in out.collect()}
    toks = matching.tokenise(B.requests(spark, SF_SMALL), "text", ["request_id", "user_id"], lower=True)
    exp = {r.user_id: (r.total_tokens, r.oov_tokens) for r in profile.oov_rate(toks, lex, by=["user_id"]).collect()}
    assert got == exp


def test_t5_l5_new_lexicon_dedupe(spark, tmp):
    words = F.element_at(F.array(*[F.lit(w) for w in ("movur", "teni", "sal", "maxo")]),
                         (F.col("user_id") % 4 + 1).cast("int"))
    subs = B.request_log(spark, SF_SMALL).filter("is_submission").select("ts", words.alias("term"))
    path = os.path.join(tmp, "subs")
    subs.write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema("ts TIMESTAMP_NTZ, term STRING").parquet(path)
    out = _run(jobs.stream_new_lexicon(stream, watermark="365 days"), tmp, "t5")
    assert sorted(r.term for r in out.collect()) == sorted(
        {r.term for r in subs.collect()} - {"maxo"})  # no "x" in the term charset


def test_t1_sliding_windows_match_batch(spark, tmp):
    stream = io.request_stream(spark, _log_dir(spark, tmp), LOG_SCHEMA)
    out = _run(jobs.stream_window_metrics(stream, "2 hours", "1 hour", watermark="1 hour"), tmp, "t1s", "complete")
    got = {(str(r.window_start)[:19], r.input_type, r.status): r.requests for r in out.collect()}
    b = (B.request_log(spark, SF_SMALL).groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "input_type", "status")
         .count())
    exp = {(str(r.w.start)[:19], r.input_type, r.status): r["count"] for r in b.collect()}
    assert got == exp
