"""Request-log analytics (M1–M22): the dashboard queries as Spark aggregates
over raw request rows.  ``rate(x[w])`` = count in the window / window seconds.

Order-dependent metrics (rolling last-N, running in-flight, counter
increases) use the bucket-split helpers in ``tessera.plans.scale`` so no key
or time range lands in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import epoch_micros
from tessera.functions.text import clean_oov_word
from tessera.plans.scale import neighbour, rolling_means, running_sum, stretches

# Histogram bucket bounds of the service's instruments.
LATENCY_BUCKETS_MS = (50, 100, 250, 500, 1000, 2000, 3000, 5000, 10000)
CONFIDENCE_BUCKETS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0)
HIGH_CONFIDENCE = 0.7
FALLBACK_THRESHOLD = 0.4
RATE_FLOOR = 0.0001
ROLLING_N = 100


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def _fmt(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def request_counts(log: DataFrame, window: str = "1 minute", by: Sequence[str] = ("input_type", "status"),
                   ts: str = "ts") -> DataFrame:
    """M1: requests per window and label set, and the per-minute rate."""
    secs = _seconds(window)
    return (log.groupBy(F.window(ts, window).alias("w"), *by)
            .agg(F.count(F.lit(1)).cast("bigint").alias("requests"))
            .select(_fmt(F.col("w.start")).alias("window_start"), *by, "requests",
                    (F.col("requests") / secs * 60.0).alias("per_min")))


def _cum_counts(v: Column, bounds: Sequence[float]) -> list[Column]:
    return [F.count_if(v <= b) for b in bounds]


def latency_histogram(log: DataFrame, window: str = "5 minutes", value: str = "latency_ms",
                      bounds: Sequence[float] = LATENCY_BUCKETS_MS, ts: str = "ts") -> DataFrame:
    """M2: cumulative ``le`` buckets per window (+Inf last), with sum and count.

    One aggregation pass: a conditional count per bound (partial aggregation),
    then the few bucket columns are unpivoted."""
    v = F.col(value)
    agg = log.groupBy(F.window(ts, window).alias("w")).agg(
        F.array(*_cum_counts(v, bounds), F.count(v)).alias("cum"),
        F.sum(v).alias("latency_sum"), F.count(v).cast("bigint").alias("latency_count"))
    les = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))
    z = F.arrays_zip(les.alias("le"), F.col("cum").alias("c"))
    return agg.select(_fmt(F.col("w.start")).alias("window_start"), F.explode(z).alias("b"),
                      "latency_sum", "latency_count").select(
        "window_start", F.col("b.le").alias("le"), F.col("b.c").cast("bigint").alias("cum_count"),
        "latency_sum", "latency_count")


def bucket_quantile(q: float, cums: Column, total: Column, bounds: Sequence[float]) -> Column:
    """Prometheus ``histogram_quantile`` on cumulative finite-bucket counts."""
    rank = F.lit(q) * total
    idx = F.array_position(F.transform(cums, lambda c: c >= rank), True).cast("int")
    b = F.array(*[F.lit(float(x)) for x in bounds])
    upper = F.element_at(b, F.greatest(idx, F.lit(1)))
    lower = F.when(idx > 1, F.element_at(b, F.greatest(idx - 1, F.lit(1)))).otherwise(0.0)
    prev = F.when(idx > 1, F.element_at(cums, F.greatest(idx - 1, F.lit(1)))).otherwise(0)
    cnt = F.element_at(cums, F.greatest(idx, F.lit(1))) - prev
    interp = lower + (upper - lower) * (rank - prev) / cnt
    return (F.when(total == 0, F.lit(None).cast("double"))
            .when(idx == 0, F.lit(float(bounds[-1])))
            .when((idx == 1) & (upper <= 0), upper)
            .otherwise(interp))


def latency_quantiles(log: DataFrame, window: str = "5 minutes", value: str = "latency_ms",
                      qs: Sequence[float] = (0.5, 0.95, 0.99), bounds: Sequence[float] = LATENCY_BUCKETS_MS,
                      ts: str = "ts") -> DataFrame:
    """M3: bucket-interpolated quantiles per window (p50/p95/p99 by default)."""
    v = F.col(value)
    agg = log.groupBy(F.window(ts, window).alias("w")).agg(
        F.array(*_cum_counts(v, bounds)).alias("cums"), F.count(v).alias("total"))
    cols = [bucket_quantile(q, F.col("cums"), F.col("total"), bounds).alias(f"p{int(round(q * 100))}") for q in qs]
    return agg.select(_fmt(F.col("w.start")).alias("window_start"), *cols)


def confidence_histogram(log: DataFrame, window: str = "5 minutes", value: str = "confidence",
                         by: Sequence[str] = ("input_type",), bounds: Sequence[float] = CONFIDENCE_BUCKETS,
                         ts: str = "ts") -> DataFrame:
    """M4: cumulative confidence buckets per window and input type, with per-second rates."""
    secs = _seconds(window)
    v = F.col(value)
    agg = log.groupBy(F.window(ts, window).alias("w"), *by).agg(
        F.array(*_cum_counts(v, bounds), F.count(v)).alias("cum"))
    les = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))
    return (agg.select(_fmt(F.col("w.start")).alias("window_start"), *by,
                       F.explode(F.arrays_zip(les.alias("le"), F.col("cum").alias("c"))).alias("b"))
            .select("window_start", *by, F.col("b.le").alias("le"), F.col("b.c").cast("bigint").alias("cum_count"),
                    (F.col("b.c") / secs).alias("rate")))


def high_confidence_ratio(log: DataFrame, window: str = "15 minutes", ts: str = "ts",
                          threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """M5: rate(high-confidence successes) / max(rate(successes), 0.0001)."""
    secs = _seconds(window)
    ok = F.col("status") == "success"
    agg = log.groupBy(F.window(ts, window).alias("w")).agg(
        F.count_if(ok & (F.col("confidence") >= threshold)).cast("bigint").alias("high"),
        F.count_if(ok).cast("bigint").alias("success"))
    return agg.select(_fmt(F.col("w.start")).alias("window_start"), "high", "success",
                      ((F.col("high") / secs) / F.greatest(F.col("success") / secs, F.lit(RATE_FLOOR))).alias("ratio"))


def error_ratio(log: DataFrame, window: str = "5 minutes", by: Sequence[str] = ("input_type",),
                ts: str = "ts") -> DataFrame:
    """M6: rate(errors) / max(rate(all), 0.0001) per window and label set."""
    secs = _seconds(window)
    agg = log.groupBy(F.window(ts, window).alias("w"), *by).agg(
        F.count_if(F.col("status") == "error").cast("bigint").alias("errors"),
        F.count(F.lit(1)).cast("bigint").alias("total"))
    return agg.select(_fmt(F.col("w.start")).alias("window_start"), *by, "errors", "total",
                      ((F.col("errors") / secs) / F.greatest(F.col("total") / secs, F.lit(RATE_FLOOR))).alias("ratio"))


def rolling_rate(log: DataFrame, flag: Column, key_cols: Sequence[str], order_cols: Sequence[str],
                 n: int = ROLLING_N, name: str = "rate", keep: Sequence[str] = ()) -> DataFrame:
    """M7/M8: share of flagged rows among the last ``n`` rows of each key (the
    key may be empty: one global stream), chunk-split so no key is one task.  Rows without
    a flag are skipped and take no place."""
    d = log.select(*key_cols, *[c for c in order_cols if c not in key_cols], *keep,
                   flag.cast("double").alias("_flag")).filter(F.col("_flag").isNotNull())
    return rolling_means(d, key_cols, order_cols, n, {name: "_flag"}).drop("_flag")


def _windowed(df: DataFrame, window: str | None, ts: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its tumbling window's start as ``window_start``, and that name; or as it is."""
    if not window:
        return df, []
    return df.withColumn("window_start", _fmt(F.window(ts, window)["start"])), ["window_start"]


def fuzzy_correction_ratio(breakdown: DataFrame, by: Sequence[str] = (), window: str | None = None,
                           ts: str = "ts") -> DataFrame:
    """M9: fuzzy-corrected tokens / tokens (floor 0.0001 on the denominator), overall or per
    window (15 minutes on the dashboards)."""
    d, w = _windowed(breakdown, window, ts)
    agg = d.groupBy(*w, *by).agg(F.count_if(F.col("fuzzy")).cast("bigint").alias("corrected"),
                                 F.count(F.lit(1)).cast("bigint").alias("tokens"))
    return agg.withColumn("ratio", F.col("corrected") / F.greatest(F.col("tokens").cast("double"), F.lit(RATE_FLOOR)))


def fuzzy_by_distance(breakdown: DataFrame, window: str | None = None, ts: str = "ts") -> DataFrame:
    """Corrected tokens per edit distance; with a window also their rate per minute."""
    d, w = _windowed(breakdown.filter(F.col("fuzzy")), window, ts)
    agg = d.groupBy(*w, "edit_distance").agg(F.count(F.lit(1)).cast("bigint").alias("corrections"))
    return agg.withColumn("per_minute", F.col("corrections") * 60.0 / _seconds(window)) if window else agg


def top_oov_words(oov: DataFrame, k: int = 10, token_col: str = "token") -> DataFrame:
    """Top-k cleaned OOV words (ties by word); the limit is the feature."""
    # count per raw token first (partial aggregation collapses repeats), so the
    # label cleaning runs once per distinct token, not once per occurrence
    per_token = oov.groupBy(token_col).agg(F.count(F.lit(1)).alias("_n"))
    w = clean_oov_word(F.col(token_col))
    return (per_token.select(w.alias("word"), "_n").filter(F.col("word").isNotNull())
            .groupBy("word").agg(F.sum("_n").cast("bigint").alias("count"))
            .orderBy(F.desc("count"), F.asc("word")).limit(k))


def requests_by_user(log: DataFrame, lookback_s: int = 3600, ts: str = "ts", user: str = "user_id") -> DataFrame:
    """Requests per user in the last ``lookback_s`` seconds before the newest row."""
    newest = log.agg(F.max(ts)).scalar()
    recent = log.filter(F.col(ts) > newest - F.expr(f"INTERVAL {lookback_s} SECONDS"))
    return (recent.groupBy(user).agg(F.count(F.lit(1)).cast("bigint").alias("requests"))
            .orderBy(F.desc("requests"), F.asc(user)))


def active_users(log: DataFrame, window: str = "5 minutes", ts: str = "ts", user: str = "user_id",
                 approx: bool = False) -> DataFrame:
    """Distinct users per window; windows without requests report 0."""
    secs = _seconds(window)
    distinct = F.approx_count_distinct(user) if approx else F.countDistinct(user)
    counts = (log.groupBy(F.window(ts, window).alias("w")).agg(distinct.cast("bigint").alias("active_users"))
              .select(F.col("w.start").alias("start"), "active_users"))
    # windows are numbered from the first on, and the numbers cut into stretches
    number = F.floor((F.unix_seconds(F.col("start").cast("timestamp"))) / secs).cast("bigint")
    counts = counts.withColumn("_i", number)
    span = counts.groupBy().agg(F.min("_i").alias("lo"), F.max("_i").alias("hi"), F.min("start").alias("_first")).where("lo is not null")
    grid = stretches(span, 3600).select("_first", "lo", F.explode(F.sequence("_a", "_b")).alias("_i"))
    grid = grid.select("_i", (F.col("_first") + F.make_dt_interval(secs=(F.col("_i") - F.col("lo")) * secs)).alias("start"))
    counts = counts.select("_i", "active_users")
    return (grid.join(counts, "_i", "left")
            .select(_fmt(F.col("start")).alias("window_start"),
                    F.coalesce("active_users", F.lit(0)).cast("bigint").alias("active_users")))


def unique_users(log: DataFrame, user: str = "user_id", approx: bool = False) -> DataFrame:
    """Distinct users over all time."""
    d = F.approx_count_distinct(user) if approx else F.countDistinct(user)
    return log.agg(d.cast("bigint").alias("unique_users"))


#: Relative standard error of a sketch is about 1.04 / sqrt(2 ** SKETCH_K).
SKETCH_K = 12


def user_sketches(log: DataFrame, window: str = "5 minutes", by: Sequence[str] = (), ts: str = "ts", user: str = "user_id",
                  lg_k: int = SKETCH_K) -> DataFrame:
    """The users of each window (and group) as a mergeable sketch of bounded size; null users
    are no users."""
    return (log.groupBy(F.window(ts, window).alias("w"), *by).agg(F.hll_sketch_agg(F.col(user).cast("string"), lg_k).alias("users"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "users"))


def users_of_sketches(sketches: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Distinct users (estimated) of the union of sketches per group: of any longer window, any label set
    or all time, from the same rows."""
    return sketches.groupBy(*by).agg(F.round(F.hll_sketch_estimate(F.hll_union_agg("users"))).cast("bigint").alias("users"))


def oov_by_user(breakdown: DataFrame, user: str = "user_id") -> DataFrame:
    """Missed tokens per user, only users with at least one."""
    return (breakdown.groupBy(user).agg(F.count_if(~F.col("found")).cast("bigint").alias("oov_tokens"))
            .filter(F.col("oov_tokens") > 0))


def submissions_by_window(log: DataFrame, window: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Accepted submissions per window and per minute."""
    secs = _seconds(window)
    return (log.filter(F.col("is_submission")).groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("submissions"))
            .select(_fmt(F.col("w.start")).alias("window_start"), "submissions",
                    (F.col("submissions") / secs * 60.0).alias("per_min")))


def submissions_by_user(log: DataFrame, user: str = "user_id") -> DataFrame:
    """Accepted submissions per user (sorted descending)."""
    return (log.filter(F.col("is_submission")).groupBy(user)
            .agg(F.count(F.lit(1)).cast("bigint").alias("submissions")))


def user_rate(log: DataFrame, window: str = "2 minutes", slide: str = "1 minute", ts: str = "ts",
              user: str = "user_id") -> DataFrame:
    """Per-user request rate in sliding windows."""
    secs = _seconds(window)
    return (log.groupBy(F.window(ts, window, slide).alias("w"), user)
            .agg(F.count(F.lit(1)).cast("bigint").alias("requests"))
            .select(_fmt(F.col("w.start")).alias("window_start"), user, "requests",
                    (F.col("requests") / secs).alias("rate")))


def in_flight(log: DataFrame, ts: str = "ts", latency: str = "latency_ms", id_col: str = "event_id") -> DataFrame:
    """Concurrency series: +1 at each start, −1 at each end (start + latency);
    running sum in (time, −1 before +1, id) order, bucket-split."""
    start = epoch_micros(log, ts)
    end = start + F.round(F.col(latency) * 1000.0).cast("bigint")
    ev = log.select(F.col(id_col), F.explode(F.array(
        F.struct(start.alias("t_us"), F.lit(1).alias("delta")),
        F.struct(end.alias("t_us"), F.lit(-1).alias("delta")))).alias("e")).select(id_col, "e.t_us", "e.delta")
    return running_sum(ev, "delta", ["t_us", "delta", id_col], name="in_flight").withColumn(
        "in_flight", F.col("in_flight").cast("bigint"))


def peak_in_flight(series: DataFrame, window_us: int = 3_600_000_000) -> DataFrame:
    """Peak concurrency per time window of the series."""
    return (series.groupBy(F.floor(F.col("t_us") / window_us).cast("bigint").alias("window_index"))
            .agg(F.max("in_flight").cast("bigint").alias("peak_in_flight")))


def latest_value(df: DataFrame, key_cols: Sequence[str], value: str, ts: str = "ts",
                 tie: str | None = None) -> DataFrame:
    """The last value set per key (``max_by`` — partial aggregation)."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    return df.groupBy(*key_cols).agg(F.max_by(value, order).alias(value), F.max(ts).alias("set_at"))


def phase_summary(log: DataFrame, phases: Sequence[tuple[str, str, str]], ts: str = "ts",
                  conf: str = "confidence", threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Per labelled phase [start, end): sent, high/low confidence, high % (zero-guarded)."""
    label = F.lit(None).cast("string")
    for name, start, end in reversed(phases):
        label = F.when((F.col(ts) >= F.lit(start).cast(log.schema[ts].dataType))
                       & (F.col(ts) < F.lit(end).cast(log.schema[ts].dataType)), F.lit(name)).otherwise(label)
    agg = (log.withColumn("phase", label).filter(F.col("phase").isNotNull()).groupBy("phase")
           .agg(F.count(F.lit(1)).cast("bigint").alias("sent"),
                F.count_if(F.col(conf) >= threshold).cast("bigint").alias("high_conf"),
                F.count_if(F.col(conf) < threshold).cast("bigint").alias("low_conf")))
    return agg.withColumn("high_pct", F.col("high_conf") / F.greatest(F.col("sent"), F.lit(1)) * 100.0)


def counter_increase(samples: DataFrame, key_cols: Sequence[str], ts: str, value: str,
                     tie: str | None = None) -> DataFrame:
    """Increase of a sampled cumulative counter tolerant of resets: a drop
    means the counter restarted from 0, so the new value itself is the increase."""
    order = [ts] + ([tie] if tie else [])
    s = samples.select(*key_cols, *order, F.col(value).cast("double").alias("_v"))
    s = s.withColumn("_t", epoch_micros(s, ts) if dict(s.dtypes)[ts].startswith("timestamp") else F.col(ts))
    p = neighbour(s, key_cols, ["_t"] + ([tie] if tie else []), ["_v"], -1, prefix="prev")
    inc = (F.when(F.col("prev_v").isNull(), 0.0)
           .when(F.col("_v") < F.col("prev_v"), F.col("_v"))
           .otherwise(F.col("_v") - F.col("prev_v")))
    return (p.groupBy(*key_cols).agg(F.sum(inc).alias("increase"),
                                     F.count_if(F.col("_v") < F.col("prev_v")).cast("bigint").alias("resets"),
                                     F.count(F.lit(1)).cast("bigint").alias("samples")))
