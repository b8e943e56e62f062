"""Alert rules, alert states and notifications.

Rules are evaluated on a 30 s grid: evaluation slot ``s`` covers time
``s·30 s`` and a rule over ``[w]`` sees requests in ``(t − w, t]``.  Window
sums are built by sending each slot's partial counts to the ``w/30``
evaluations that can see it (explode + aggregate — no global window), and
alert islands are found by equi-joins on neighbouring slots plus bucket-split
ranking, so a long history is never one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.metrics import (
    FALLBACK_THRESHOLD,
    LATENCY_BUCKETS_MS,
    RATE_FLOOR,
    bucket_quantile,
    rolling_rate,
)
from tessera.functions.numeric import epoch_micros, ntz_from_micros
from tessera.plans.scale import neighbour, rolling_means, stretches
from tessera.session import cut_lineage

EVAL_SECONDS = 30
US = 1_000_000


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    for_seconds: int


# The configured alert rules.
HIGH_ERROR_RATE = Rule("HighErrorRate", "critical", 120)
HIGH_FALLBACK_RATE = Rule("HighFallbackRate", "warning", 120)
OOV_DRIFT = Rule("OOVDriftDetected", "warning", 60)
LOW_CONFIDENCE = Rule("LowConfidenceTranslations", "warning", 300)
HIGH_LATENCY = Rule("HighLatency", "warning", 180)
BACKEND_DOWN = Rule("BackendDown", "critical", 60)
ERROR_RATE_MAX = 0.05
FALLBACK_RATE_MAX = 0.5
OOV_RATE_MAX = 0.3
HIGH_CONF_MIN = 0.4
P95_MAX_MS = 5000.0
# Notification routing (group_wait, repeat_interval) per severity, seconds.
ROUTES = {"critical": ("oncall", 5, 1800), "warning": ("default", 10, 3600)}


def slot_of(df: DataFrame, ts: str) -> Column:
    """Evaluation slot of a timestamp: the first evaluation at or after it."""
    us = epoch_micros(df, ts)
    return F.floor((us + (EVAL_SECONDS * US - 1)) / (EVAL_SECONDS * US)).cast("bigint")


def slot_time(slot: Column) -> Column:
    return F.date_format(ntz_from_micros(slot * (EVAL_SECONDS * US)), "yyyy-MM-dd HH:mm:ss")


def _grid(slots: DataFrame, until: str | None = None) -> DataFrame:
    """All evaluation slots between the first and last slot with data, or up to ``until``: cut at
    hours first, so that a long gap is many rows and not one long array."""
    hour = 3600 // EVAL_SECONDS
    hi = F.max("slot")
    if until is not None:
        seen = F.floor(F.unix_micros(F.lit(until).cast("timestamp")) / (EVAL_SECONDS * US)).cast("bigint")
        hi = F.greatest(hi, F.when(F.count(F.lit(1)) > 0, seen))
    span = slots.agg(F.min("slot").alias("lo"), hi.alias("hi")).where("lo is not null")
    return stretches(span, hour).select(F.explode(F.sequence("_a", "_b")).alias("slot"))


def windowed_sums(log: DataFrame, window_s: int, sums: dict[str, Column], ts: str = "ts") -> DataFrame:
    """Per evaluation slot, sums over the trailing window (all grid slots present)."""
    k = window_s // EVAL_SECONDS
    per_slot = log.withColumn("slot", slot_of(log, ts)).groupBy("slot").agg(
        *[c.alias(n) for n, c in sums.items()])
    spread = (per_slot.withColumn("slot", F.explode(F.sequence(F.col("slot"), F.col("slot") + (k - 1))))
              .groupBy("slot").agg(*[F.sum(n).alias(n) for n in sums]))
    grid = _grid(per_slot)
    out = grid.join(spread, "slot", "left")
    for n in sums:
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0)))
    return out


def error_rate_condition(log: DataFrame, window_s: int = 300, max_ratio: float = ERROR_RATE_MAX) -> DataFrame:
    """5 m error ratio > 5 %."""
    w = windowed_sums(log, window_s, {"errors": F.count_if(F.col("status") == "error"),
                                      "total": F.count(F.lit(1))})
    ratio = (F.col("errors") / window_s) / F.greatest(F.col("total") / window_s, F.lit(RATE_FLOOR))
    return w.select("slot", (ratio > max_ratio).alias("cond"))


def low_confidence_condition(log: DataFrame, window_s: int = 900, min_ratio: float = HIGH_CONF_MIN) -> DataFrame:
    """15 m high-confidence share of successes < 0.4."""
    ok = F.col("status") == "success"
    w = windowed_sums(log, window_s, {"high": F.count_if(ok & (F.col("confidence") >= 0.7)),
                                      "success": F.count_if(ok)})
    ratio = (F.col("high") / window_s) / F.greatest(F.col("success") / window_s, F.lit(RATE_FLOOR))
    return w.select("slot", (ratio < min_ratio).alias("cond"))


def high_latency_condition(log: DataFrame, window_s: int = 300, max_ms: float = P95_MAX_MS,
                           bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> DataFrame:
    """Bucket-interpolated p95 over 5 m > 5000 ms."""
    sums = {f"b{i}": F.count_if(F.col("latency_ms") <= b) for i, b in enumerate(bounds)}
    sums["total"] = F.count(F.lit(1))
    w = windowed_sums(log, window_s, sums)
    cums = F.array(*[F.col(f"b{i}") for i in range(len(bounds))])
    p95 = bucket_quantile(0.95, cums, F.col("total"), bounds)
    return w.select("slot", F.coalesce(p95 > max_ms, F.lit(False)).alias("cond"))


def gauge_condition(log: DataFrame, flag: Column, max_rate: float, n: int = 100) -> DataFrame:
    """A rolling last-``n`` gauge (over the whole stream) above ``max_rate``.

    The gauge keeps the value of the latest request; each slot with requests
    starts a constant stretch up to the next such slot."""
    g = rolling_rate(log, flag, [], ["ts", "event_id"], n, name="gauge")
    per_slot = (g.withColumn("slot", slot_of(g, "ts"))
                .groupBy("slot").agg(F.max_by("gauge", F.struct("ts", "event_id")).alias("gauge")))
    nxt = neighbour(per_slot, [], ["slot"], ["slot"], +1, prefix="next_")
    span = stretches(nxt.select(F.col("slot").alias("lo"), F.coalesce(F.col("next_slot") - 1, F.col("slot")).alias("hi"), "gauge"),
                      3600 // EVAL_SECONDS)
    return span.select(F.explode(F.sequence("_a", "_b")).alias("slot"), (F.col("gauge") > max_rate).alias("cond"))


def fallback_condition(log: DataFrame) -> DataFrame:
    return gauge_condition(log, F.col("confidence") < FALLBACK_THRESHOLD, FALLBACK_RATE_MAX)


def oov_condition(log: DataFrame) -> DataFrame:
    return gauge_condition(log, F.col("missed"), OOV_RATE_MAX)


def alert_states(cond: DataFrame, rule: Rule, materialize: bool = True) -> DataFrame:
    """Condition series ``(slot, cond)`` → alert intervals.

    An island of consecutive true evaluations starting at slot ``a`` is
    pending from ``a``; it fires at ``a + for`` if it still holds then, and
    resolves at the first false evaluation (null while still active at the
    last evaluation)."""
    c = cond.select("slot", F.col("cond").cast("boolean").alias("cond"))
    if materialize:
        # one row per 30 s evaluation: small; read four times below
        c = cut_lineage(c)
    prev = c.select((F.col("slot") + 1).alias("slot"), F.col("cond").alias("prev"))
    nxt = c.select((F.col("slot") - 1).alias("slot"), F.col("cond").alias("next"))
    last = c.agg(F.max("slot").alias("_last"))
    e = c.filter("cond").join(prev, "slot", "left").join(nxt, "slot", "left")
    # run starts and ends alternate in slot order (a start sorts before an end
    # on the same slot), so each end's island start is the previous mark
    starts = e.filter(~F.coalesce("prev", F.lit(False))).select("slot", F.lit(0).alias("_kind"))
    ends = e.filter(~F.coalesce("next", F.lit(False))).select("slot", F.lit(1).alias("_kind"))
    marks = neighbour(starts.unionByName(ends), [], ["slot", "_kind"], ["slot"], -1, prefix="start_")
    isl = (marks.filter(F.col("_kind") == 1).select(F.col("start_slot").alias("a"), F.col("slot").alias("b"))
           .withColumn("_one", F.lit(1)).join(F.broadcast(last.withColumn("_one", F.lit(1))), "_one"))
    k = -(-rule.for_seconds // EVAL_SECONDS)
    fired = (F.col("b") - F.col("a")) >= k
    return isl.select(
        F.lit(rule.name).alias("alertname"), F.lit(rule.severity).alias("severity"),
        F.col("a").alias("start_slot"),
        slot_time(F.col("a")).alias("pending_at"),
        F.when(fired, slot_time(F.col("a") + k)).alias("firing_at"),
        F.when(F.col("b") < F.col("_last"), slot_time(F.col("b") + 1)).alias("resolved_at"),
        fired.alias("fired"),
        F.when(fired, F.col("a") + k).alias("_fire_slot"),
        F.when(F.col("b") < F.col("_last"), F.col("b") + 1).alias("_end_slot"),
        F.col("_last").alias("_last_slot"))


def heartbeat_gaps(log: DataFrame, key_cols: Sequence[str], gap_s: int, ts: str = "ts",
                   tie: str = "event_id", until: str | None = None) -> DataFrame:
    """Silences longer than ``gap_s`` between consecutive signs of life per source.  With
    ``until`` (a timestamp) a source that is silent from its last sign to then is reported, too,
    with null ``seen_again`` and the gap so far."""
    d = log.select(*key_cols, tie, F.col(ts).alias("_ts"),
                   epoch_micros(log, ts).alias("_us"))
    n = neighbour(d, key_cols, ["_us", tie], ["_us"], +1, prefix="next")
    end = F.col("next_us") if until is None else F.coalesce("next_us", F.unix_micros(F.lit(until).cast("timestamp")))
    gap = (end - F.col("_us")) / US
    return (n.filter(gap > gap_s)
            .select(*key_cols, F.date_format("_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_seen"),
                    F.date_format(ntz_from_micros(F.col("next_us")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("seen_again"),
                    gap.alias("gap_s")))


def notifications(states: DataFrame, routes: dict = ROUTES) -> DataFrame:
    """One notice at firing + group wait, repeats every repeat interval while
    firing, one notice on resolve."""
    fired = states.filter("fired")
    recv = F.lit(None).cast("string")
    wait = F.lit(None).cast("int")
    rep = F.lit(None).cast("int")
    for sev, (r, gw, ri) in routes.items():
        is_sev = F.col("severity") == sev
        recv = F.when(is_sev, F.lit(r)).otherwise(recv)
        wait = F.when(is_sev, F.lit(gw)).otherwise(wait)
        rep = F.when(is_sev, F.lit(ri)).otherwise(rep)
    f = fired.withColumn("receiver", recv).withColumn("_gw", wait).withColumn("_ri", rep)
    t0 = F.col("_fire_slot") * EVAL_SECONDS + F.col("_gw")
    t_end = F.col("_end_slot") * EVAL_SECONDS
    # still firing at the last evaluation: repeats up to that evaluation
    t_stop = F.coalesce(t_end, F.col("_last_slot") * EVAL_SECONDS + 1)
    n_rep = F.greatest(F.ceil((t_stop - t0) / F.col("_ri")) - 1, F.lit(0))
    fire = (f.filter(t0 < t_stop)
            .select("alertname", "severity", "receiver", F.lit("firing").alias("kind"),
                    F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), n_rep.cast("bigint")),
                                          lambda i: t0 + i * F.col("_ri"))).alias("_t")))
    resolve = (f.filter(F.col("_end_slot").isNotNull())
               .select("alertname", "severity", "receiver", F.lit("resolved").alias("kind"), t_end.alias("_t")))
    out = fire.unionByName(resolve)
    return out.select("alertname", "severity", "receiver", "kind", F.col("_t").cast("bigint").alias("notify_s"),
                      F.date_format(ntz_from_micros(F.col("_t") * US), "yyyy-MM-dd HH:mm:ss").alias("notify_at"))


def inhibit(notices: DataFrame, states: DataFrame, equal: Sequence[str] = ("alertname",),
            source_severity: str = "critical", target_severity: str = "warning",
            bucket_s: int = 3600) -> DataFrame:
    """Drop target-severity notices sent while a source-severity alert with
    the same ``equal`` labels is firing.  The firing intervals are cut at bucket bounds and
    overlapping ones merged inside each (equal labels, bucket), so a bucket holds at most one
    interval for every other evaluation slot and a notice lies in at most one of them."""
    src = states.filter(F.col("fired") & (F.col("severity") == source_severity)).select(
        *[F.col(c) for c in equal],
        (F.col("_fire_slot") * EVAL_SECONDS).alias("_s"),
        (F.coalesce(F.col("_end_slot"), F.col("_last_slot") + 1) * EVAL_SECONDS).alias("_e")).filter("_s < _e")
    src = src.withColumn("_bk", F.explode(F.sequence(F.floor(F.col("_s") / bucket_s).cast("bigint"),
                                                     F.floor((F.col("_e") - 1) / bucket_s).cast("bigint"))))
    cut = src.select(*equal, "_bk", F.greatest("_s", F.col("_bk") * bucket_s).alias("_s"),
                     F.least("_e", (F.col("_bk") + 1) * bucket_s).alias("_e")).distinct()
    w = Window.partitionBy(*equal, "_bk").orderBy("_s", "_e")
    before = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(before >= F.col("_s"), 0).otherwise(1)).over(w)
    merged = (cut.withColumn("_island", island).groupBy(*equal, "_bk", "_island")
              .agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_island"))
    tgt = notices.filter(F.col("severity") == target_severity).withColumn(
        "_bk", F.floor(F.col("notify_s") / bucket_s).cast("bigint"))
    hit = tgt.join(merged, [*equal, "_bk"], "inner").filter(
        (F.col("notify_s") >= F.col("_s")) & (F.col("notify_s") < F.col("_e")))
    keys = ["alertname", "severity", "receiver", "kind", "notify_s"]
    hit = hit.select(*keys).distinct()
    return (notices.join(hit.withColumn("_inh", F.lit(True)), keys, "left")
            .withColumn("inhibited", F.coalesce("_inh", F.lit(False))).drop("_inh"))


# --------------------------------------------------------------------------
# All request-log rules in one pass over the log (what the alert evaluator
# runs): one per-slot aggregation with every rule's counts, one spread to the
# longest window with offset-conditioned sums, one rolling pass for both
# gauges, and one island pass keyed by alert name.
ALL_RULES = (HIGH_ERROR_RATE, HIGH_FALLBACK_RATE, OOV_DRIFT, LOW_CONFIDENCE, HIGH_LATENCY)


def slot_sums() -> dict[str, Column]:
    """What the windowed rules count in an evaluation slot."""
    ok = F.col("status") == "success"
    sums = {"errors": F.count_if(F.col("status") == "error"), "total": F.count(F.lit(1)),
            "high": F.count_if(ok & (F.col("confidence") >= 0.7)), "success": F.count_if(ok)}
    for i, b in enumerate(LATENCY_BUCKETS_MS):
        sums[f"b{i}"] = F.count_if(F.col("latency_ms") <= b)
    return sums


def trailing_sums() -> list[tuple[str, str, int]]:
    """Names, counts and slots of the trailing windows that the windowed rules read."""
    return [(f"{n}_15m", n, 900 // EVAL_SECONDS) if n in ("high", "success") else (f"{n}_5m", n, 300 // EVAL_SECONDS) for n in slot_sums()]


def windowed_conditions() -> list[tuple[Rule, Column]]:
    """R1, R4 and R5 over the columns of ``trailing_sums``."""
    err = (F.col("errors_5m") / 300) / F.greatest(F.col("total_5m") / 300, F.lit(RATE_FLOOR)) > ERROR_RATE_MAX
    low = (F.col("high_15m") / 900) / F.greatest(F.col("success_15m") / 900, F.lit(RATE_FLOOR)) < HIGH_CONF_MIN
    cums = F.array(*[F.col(f"b{i}_5m") for i in range(len(LATENCY_BUCKETS_MS))])
    lat = F.coalesce(bucket_quantile(0.95, cums, F.col("total_5m"), LATENCY_BUCKETS_MS) > P95_MAX_MS, F.lit(False))
    return [(HIGH_ERROR_RATE, err), (LOW_CONFIDENCE, low), (HIGH_LATENCY, lat)]


def evaluate_rules(log: DataFrame, ts: str = "ts", until: str | None = None) -> DataFrame:
    """R1–R5 conditions as rows ``(alertname, slot, cond)`` over the common grid, up to the last
    request or, with ``until`` (a timestamp), through the silence after it."""
    sums = slot_sums()
    per_slot = log.withColumn("slot", slot_of(log, ts)).groupBy("slot").agg(*[c.alias(n) for n, c in sums.items()])
    # the dense grid by days, each with the slots before it that its windows reach
    day, reach = 86400 // EVAL_SECONDS, max(w for *_, w in trailing_sums()) - 1
    dense = _grid(per_slot, until).join(per_slot, "slot", "left").na.fill(0)
    here = F.floor(F.col("slot") / day)
    copies = F.array(F.struct(here.alias("_day"), F.lit(False).alias("_ctx")),
                     F.when(F.pmod("slot", F.lit(day)) >= day - reach, F.struct((here + 1).alias("_day"), F.lit(True).alias("_ctx"))))
    dense = dense.select("*", F.explode(F.array_compact(copies)).alias("_c")).select("*", "_c.*").drop("_c")
    w = Window.partitionBy("_day").orderBy("slot")
    grid = (dense.select("slot", "_ctx", *[F.sum(n).over(w.rowsBetween(1 - k, 0)).alias(out) for out, n, k in trailing_sums()])
            .where(~F.col("_ctx")).drop("_ctx"))
    windowed = grid.select("slot", F.explode(F.array(*[
        F.struct(F.lit(rule.name).alias("alertname"), cond.alias("cond")) for rule, cond in windowed_conditions()])).alias("x")).select(
        "x.alertname", "slot", "x.cond")
    d = log.select(ts, "event_id", (F.col("confidence") < FALLBACK_THRESHOLD).cast("double").alias("_fb"),
                   F.col("missed").cast("double").alias("_oov"))
    g = rolling_means(d, [], [ts, "event_id"], 100, {"g_fb": "_fb", "g_oov": "_oov"})
    last = F.struct(ts, "event_id")
    gs = (g.withColumn("slot", slot_of(g, ts)).groupBy("slot")
          .agg(F.max_by("g_fb", last).alias("g_fb"), F.max_by("g_oov", last).alias("g_oov")))
    nxt = neighbour(gs, [], ["slot"], ["slot"], +1, prefix="next_")
    span = stretches(nxt.select(F.col("slot").alias("lo"), F.coalesce(F.col("next_slot") - 1, F.col("slot")).alias("hi"), "g_fb", "g_oov"),
                      3600 // EVAL_SECONDS).select(F.explode(F.sequence("_a", "_b")).alias("slot"), "g_fb", "g_oov")
    gauges = span.select("slot", F.explode(F.array(
        F.struct(F.lit(HIGH_FALLBACK_RATE.name).alias("alertname"), (F.col("g_fb") > FALLBACK_RATE_MAX).alias("cond")),
        F.struct(F.lit(OOV_DRIFT.name).alias("alertname"), (F.col("g_oov") > OOV_RATE_MAX).alias("cond")))).alias("x")
    ).select("x.alertname", "slot", "x.cond")
    return windowed.unionByName(gauges)


def alert_states_all(conds: DataFrame, rules=ALL_RULES, materialize: bool = True) -> DataFrame:
    """R7 for many rules at once: ``(alertname, slot, cond)`` → intervals, keyed by alert."""
    c = conds.select("alertname", "slot", F.col("cond").cast("boolean").alias("cond"))
    if materialize:
        c = cut_lineage(c)
    prev = c.select("alertname", (F.col("slot") + 1).alias("slot"), F.col("cond").alias("prev"))
    nxt = c.select("alertname", (F.col("slot") - 1).alias("slot"), F.col("cond").alias("next"))
    last = c.groupBy("alertname").agg(F.max("slot").alias("_last"))
    e = c.filter("cond").join(prev, ["alertname", "slot"], "left").join(nxt, ["alertname", "slot"], "left")
    starts = e.filter(~F.coalesce("prev", F.lit(False))).select("alertname", "slot", F.lit(0).alias("_kind"))
    ends = e.filter(~F.coalesce("next", F.lit(False))).select("alertname", "slot", F.lit(1).alias("_kind"))
    marks = neighbour(starts.unionByName(ends), ["alertname"], ["slot", "_kind"], ["slot"], -1, prefix="start_")
    isl = (marks.filter(F.col("_kind") == 1)
           .select("alertname", F.col("start_slot").alias("a"), F.col("slot").alias("b"))
           .join(last, "alertname"))
    sev = F.lit(None).cast("string")
    k = F.lit(None).cast("int")
    for r in rules:
        sev = F.when(F.col("alertname") == r.name, F.lit(r.severity)).otherwise(sev)
        k = F.when(F.col("alertname") == r.name, F.lit(-(-r.for_seconds // EVAL_SECONDS))).otherwise(k)
    isl = isl.withColumn("_k", k)
    fired = (F.col("b") - F.col("a")) >= F.col("_k")
    return isl.select(
        "alertname", sev.alias("severity"), F.col("a").alias("start_slot"),
        slot_time(F.col("a")).alias("pending_at"),
        F.when(fired, slot_time(F.col("a") + F.col("_k"))).alias("firing_at"),
        F.when(F.col("b") < F.col("_last"), slot_time(F.col("b") + 1)).alias("resolved_at"),
        fired.alias("fired"),
        F.when(fired, F.col("a") + F.col("_k")).alias("_fire_slot"),
        F.when(F.col("b") < F.col("_last"), F.col("b") + 1).alias("_end_slot"),
        F.col("_last").alias("_last_slot"))
