"""Structured Streaming jobs.

Each function takes a streaming DataFrame (plus static tables) and returns a
streaming DataFrame or a started query; sinks, triggers and checkpoint
locations are the caller's.  State lives in the state store (RocksDB when
configured), so restarts resume from the checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import in_charset
from tessera.operators import alerts
from tessera.operators.matching import tokenise
from tessera.operators.metrics import CONFIDENCE_BUCKETS, HIGH_CONFIDENCE, LATENCY_BUCKETS_MS
from tessera.operators.quality import QUALITY_STATS, quality_gauges, quality_stats
from tessera.session import ensure_checkpoint_dir
from tessera.streaming import live


def landing(df: DataFrame) -> DataFrame:
    """The rows of a batch table as a stream: written once into a folder below the shared checkpoint
    folder, from which a file source reads them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def available_now(out: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that has arrived and give its rows as a table; rows that wait for a later
    watermark stay in state.  State, progress and rows lie below the shared checkpoint folder."""
    spark = out.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    (out.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/progress")
     .outputMode(mode).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(out.schema).parquet(f"{path}/rows")


def event_time(stream: DataFrame, ts: str = "ts", name: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast once (session time zone)."""
    return stream.withColumn(name, F.col(ts).cast("timestamp"))


def stream_window_metrics(stream: DataFrame, window: str = "5 minutes", slide: str | None = None,
                          watermark: str = "10 minutes", by: Sequence[str] = ("input_type", "status"),
                          ts: str = "ts") -> DataFrame:
    """tumbling/sliding window counts, errors, latency sum and cumulative latency buckets
    (``le_<bound>``, M2), requests by confidence bucket (``conf_<bound>``, M4) and of high
    confidence (M5), and distinct users per label set; rows later than the watermark are
    dropped (and counted in the query progress).  Quantiles and ratios follow from the buckets
    with the batch functions."""
    s = event_time(stream, ts).withWatermark("event_time", watermark)
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return (s.groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(F.col("status") == "error").alias("errors"),
                 F.sum("latency_ms").alias("latency_sum"),
                 F.approx_count_distinct("user_id").alias("active_users"),
                 F.count_if(F.col("confidence") >= HIGH_CONFIDENCE).alias("high_confidence"),
                 *[F.count_if(F.col("latency_ms") <= b).alias(f"le_{b}") for b in LATENCY_BUCKETS_MS],
                 *[F.count_if(F.col("confidence") <= b).alias(f"conf_{b}") for b in CONFIDENCE_BUCKETS])
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    "requests", "errors", "latency_sum", "active_users", "high_confidence",
                    *[f"le_{b}" for b in LATENCY_BUCKETS_MS], *[f"`conf_{b}`" for b in CONFIDENCE_BUCKETS]))


def stream_rolling_n(stream: DataFrame, key_col: str, flag: F.Column, n: int = 100, id_col: str = "event_id",
                     ts: str = "ts", watermark: str = "10 minutes", stretch_ms: int = 60_000) -> DataFrame:
    """Share of flagged rows among the last ``n`` per key in the order of ``(ts, id)``, whatever files
    they come in.  Rows without a flag are skipped.  A row's rate comes once the watermark has
    passed its stretch of ``stretch_ms``; until then rows wait in state, packed in blocks."""
    live.enable(stream.sparkSession)
    s = event_time(stream, ts).withWatermark("event_time", watermark)
    s = s.select(F.col(key_col).cast("string").alias("key"), F.col(id_col).cast("bigint").alias(id_col), "event_time",
                 F.unix_micros("event_time").alias("us"), flag.cast("double").alias("flag")).where("flag is not null")
    return s.groupBy("key").transformWithStateInPandas(
        live.RollingFlags(n, stretch_ms, id_col), f"key STRING, {id_col} BIGINT, rate DOUBLE", "append", "EventTime")


def _alert_states(evaluations: DataFrame, for_seconds_by_alert: dict[str, int], eval_seconds: int, stale_after: int,
                  by: Sequence[str]) -> DataFrame:
    types = dict(evaluations.dtypes)
    keys = [*by, "alertname"]
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "state STRING", "slot BIGINT"])
    return evaluations.groupBy(*keys).transformWithStateInPandas(
        live.AlertStates(dict(for_seconds_by_alert), eval_seconds, max(1, stale_after // eval_seconds), keys), schema, "append", "EventTime")


def stream_alert_state(evaluations: DataFrame, for_seconds_by_alert: dict[str, int], eval_seconds: int = 30,
                       watermark: str = "0 seconds", stale_after: int = 300, by: Sequence[str] = ()) -> DataFrame:
    """Alert state machine per alert over a stream of evaluations ``(alertname, slot, cond)``:
    pending → firing (after ``for``) → resolved (or back to inactive if it never fired).  One row
    per transition.  Evaluations are taken in the order of their slots.  If none follows, the last
    one holds for ``stale_after`` seconds: timers fire a pending alert when its time comes and
    then resolve it."""
    live.enable(evaluations.sparkSession)
    e = evaluations.select(*by, "alertname", "slot", F.col("slot").alias("until"), "cond",
                           F.timestamp_millis(F.col("slot") * (1000 * eval_seconds) + 1).alias("t")).withWatermark("t", watermark)
    return _alert_states(e, for_seconds_by_alert, eval_seconds, stale_after, by)


def stream_evaluations(requests: DataFrame, watermark: str = "10 minutes", by: Sequence[str] = (), ts: str = "ts",
                       ticks: DataFrame | None = None) -> DataFrame:
    """Evaluations of the windowed rules (R1, R4, R5) from the request stream: ``(alertname, slot, until,
    cond)``, one chain of two stateful operators under one watermark.  Requests are counted once,
    in their 30 s slot; trailing windows are added up from the slots.  ``ticks`` (rows with a
    timestamp ``ts``, such as those of a rate source) move time on when no request comes."""
    live.enable(requests.sparkSession)
    names, slot_us = alerts.slot_sums(), alerts.EVAL_SECONDS * alerts.US
    s = event_time(requests, ts).select(*by, "status", "confidence", "latency_ms", "event_time", F.lit(True).alias("_request"))
    if ticks is not None:
        s = s.unionByName(event_time(ticks, ts).select("event_time", F.lit(False).alias("_request")), allowMissingColumns=True)
    # an evaluation sees the requests up to and at its time: windows that are closed at the end
    s = s.withColumn("event_time", F.timestamp_micros(F.unix_micros("event_time") - 1)).withWatermark("event_time", watermark)
    # ticks go into the aggregation (a filter before it would take them from the watermark, too)
    names["total"] = F.count_if("_request")
    slots = (s.groupBy(F.window("event_time", f"{alerts.EVAL_SECONDS} seconds").alias("w"), *by)
             .agg(*[c.cast("bigint").alias(n) for n, c in names.items()]).where("total > 0")
             .select(F.window_time("w").alias("t"), *(by or [F.lit("all").alias("_all")]),
                     F.floor(F.unix_micros("w.end") / slot_us).cast("bigint").alias("slot"), *names))
    keys = list(by) or ["_all"]
    types = dict(slots.dtypes)
    outs = alerts.trailing_sums()
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "t TIMESTAMP", "slot BIGINT", "until BIGINT", *(f"{o} BIGINT" for o, *_ in outs)])
    sums = slots.groupBy(*keys).transformWithStateInPandas(
        live.TrailingSums(list(names), outs, alerts.EVAL_SECONDS, keys), schema, "append", "EventTime", eventTimeColumnName="t")
    rules = F.array(*[F.struct(F.lit(r.name).alias("alertname"), cond.alias("cond")) for r, cond in alerts.windowed_conditions()])
    return (sums.select(*by, "t", "slot", "until", F.explode(rules).alias("x"))
            .select(*by, "x.alertname", "slot", "until", F.coalesce("x.cond", F.lit(False)).alias("cond"), "t"))


def stream_live_alerts(requests: DataFrame, watermark: str = "10 minutes", by: Sequence[str] = (), ts: str = "ts",
                       ticks: DataFrame | None = None) -> DataFrame:
    """T3 on the request log: requests in, transitions of the windowed rules' alerts out, as R7 has them
    for the same log.  Slots come when the watermark has passed them, silent ones included."""
    waits = {rule.name: rule.for_seconds for rule, _ in alerts.windowed_conditions()}
    return _alert_states(stream_evaluations(requests, watermark, by, ts, ticks), waits, alerts.EVAL_SECONDS, 300, by)


def stream_heartbeats(stream: DataFrame, key_cols: Sequence[str], gap_s: int, watermark: str = "10 minutes",
                      ts: str = "ts") -> DataFrame:
    """R6 on the stream: ``kind`` ``down`` when a source has been silent for ``gap_s`` (by a timer, so it need
    never speak again), ``up`` when it speaks again; times in microseconds."""
    live.enable(stream.sparkSession)
    s = event_time(stream, ts).withWatermark("event_time", watermark)
    s = s.select(*key_cols, "event_time", F.unix_micros("event_time").alias("us"))
    types = dict(s.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in key_cols), "kind STRING", "last_us BIGINT", "again_us BIGINT"])
    return s.groupBy(*key_cols).transformWithStateInPandas(
        live.Heartbeats(gap_s * alerts.US, list(key_cols)), schema, "append", "EventTime")


def stream_oov(requests: DataFrame, lex: DataFrame, by: Sequence[str] = ("user_id",),
               text_col: str = "text", id_col: str = "request_id", window: str | None = None,
               watermark: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """T4: stream–static join of request tokens against the (static) vocabulary; token / OOV
    counts per key and event-time window (with ``window``: state of closed windows goes), or
    running counts per key (update or complete mode, for keys that are few)."""
    keep, keys = [id_col, *by], list(by)
    if window:
        requests = event_time(requests, ts).withWatermark("event_time", watermark)
        keep.append("event_time")
        keys = [F.window("event_time", window).alias("w"), *by]
    toks = tokenise(requests, text_col, keep, lower=True)
    vocab = lex.select(F.lower("term").alias("token")).distinct().withColumn("_in", F.lit(1))
    j = toks.join(vocab, "token", "left")
    out = (j.groupBy(*keys).agg(F.count(F.lit(1)).alias("tokens"),
                                F.count_if(F.col("_in").isNull()).alias("oov_tokens"))
           .withColumn("oov_rate", F.col("oov_tokens") / F.col("tokens")))
    return out.select(F.col("w.start").alias("window_start"), *by, "tokens", "oov_tokens", "oov_rate") if window else out


def stream_live_quality(answers: DataFrame, labels: DataFrame, window: str = "15 minutes", id_col: str = "request_id",
                        label_after: str = "1 hour", watermark: str = "10 minutes", by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """M22 on streams: answers ``(id, ts, hypothesis)`` meet the labels ``(id, ts, reference)`` that come up to
    ``label_after`` later (a stream–stream interval join: both sides leave state when no partner
    can come any more), and each window of answers adds up the numbers of both measures."""
    a = event_time(answers, ts).withWatermark("event_time", watermark).select(id_col, *by, "event_time", "hypothesis")
    b = event_time(labels, ts, "label_time").withWatermark("label_time", watermark).select(F.col(id_col).alias("_label_id"), "label_time", "reference")
    met = a.join(b, (F.col(id_col) == F.col("_label_id")) & (F.col("label_time") >= F.col("event_time"))
                 & (F.col("label_time") <= F.col("event_time") + F.expr(f"INTERVAL {label_after}")))
    stats = quality_stats(met.select(*by, "event_time", "reference", "hypothesis"))
    w = stats.groupBy(F.window("event_time", window).alias("w"), *by).agg(*[F.sum(c).alias(c) for c in QUALITY_STATS])
    return quality_gauges(w, by)


def stream_user_sketches(stream: DataFrame, window: str = "5 minutes", by: Sequence[str] = (), watermark: str = "10 minutes",
                         user: str = "user_id", ts: str = "ts", lg_k: int = 12) -> DataFrame:
    """M13/M14 on streams: a mergeable sketch of the users of each window (and group).  Any longer window, any
    set of groups and all time are unions of these rows (``metrics.users_of_sketches``)."""
    s = event_time(stream, ts).withWatermark("event_time", watermark)
    return (s.groupBy(F.window("event_time", window).alias("w"), *by).agg(F.hll_sketch_agg(F.col(user).cast("string"), lg_k).alias("users"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "users"))


def stream_new_lexicon(submissions: DataFrame, term_col: str = "term", ts: str = "ts",
                       watermark: str = "1 hour") -> DataFrame:
    """T5: accepted submissions (term charset) deduplicated per term within the watermark."""
    s = event_time(submissions, ts).withWatermark("event_time", watermark)
    return s.filter(in_charset(F.col(term_col))).dropDuplicatesWithinWatermark([term_col])
