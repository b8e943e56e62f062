"""Live jobs with event-time timers (T2, T3, R6 on streams) against their batch twins, over several
triggers, with late files, silence and null flags."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import alerts, drift, matching, metrics, quality
from tessera.plans import scale
from tessera.streaming import drift as drift_job
from tessera.streaming import jobs, live

T0 = dt.datetime(2024, 3, 1)
LOG = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, status STRING, latency_ms DOUBLE, confidence DOUBLE, missed BOOLEAN"


def feed(spark, tmp, name, parts, schema, build):
    """Each part is a file of its own and a trigger of its own; state lives in the checkpoint."""
    path, sink, ck = (os.path.join(tmp, f"{name}_{x}") for x in ("in", "out", "ck"))
    os.makedirs(path)
    out = build(spark.readStream.schema(schema).parquet(path))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(out.schema).parquet(sink)


def requests(spark, seed=1, n=1200, hours=6):
    """Busy and bad stretches, a silence of two hours, nulls here and there."""
    rng = np.random.RandomState(seed)
    secs = np.sort(rng.uniform(0, hours * 3600, n))
    secs = secs[(secs < 2 * 3600) | (secs > 4 * 3600)]
    rows = []
    for i, s in enumerate(secs):
        bad = int(s // 900) % 3 == 1
        rows.append((i, T0 + dt.timedelta(microseconds=int(s * 1e6)), int(rng.zipf(1.6) % 7) if i % 50 else None,
                     "error" if rng.rand() < (0.3 if bad else 0.01) else "success",
                     float(rng.choice([80, 800, 8000], p=[.5, .2, .3] if bad else [.9, .08, .02])),
                     None if i % 41 == 0 else round(float(rng.rand()), 3), None if i % 29 == 0 else bool(rng.rand() < 0.3)))
    return spark.createDataFrame(rows, LOG)


def shuffled(log, n_parts, jitter_s):
    """Parts in the order of arrival: each row comes up to ``jitter_s`` late."""
    late = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(jitter_s * 1_000_000))
    lo, hi = log.agg(F.min(late), F.max(late)).first()
    part = F.floor((late - lo) * n_parts / (hi - lo + 1))
    return [log.where(part == i) for i in range(n_parts)]


def flush(spark, schema, **values):
    """A last row, far ahead, that moves the watermark past all others."""
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(values.get(c) for c in names)], schema)


def test_t2_m7_order_of_time_over_triggers(spark, tmp):
    log = requests(spark)
    end = flush(spark, LOG, event_id=-1, ts=T0 + dt.timedelta(days=9), user_id=999, missed=True)
    parts = shuffled(log, 3, 600)
    got = feed(spark, tmp, "t2", [*parts[:2], parts[2].unionByName(end)], LOG,
               lambda s: jobs.stream_rolling_n(s, "user_id", F.col("missed"), n=5, watermark="12 minutes"))
    want = metrics.rolling_rate(log, F.col("missed"), ["user_id"], ["ts", "event_id"], n=5)
    got, want = {r.event_id: (r.key, r.rate) for r in got.collect()}, {r.event_id: (r.user_id, r.rate) for r in want.collect()}
    assert got.keys() == want.keys() and len(got) < log.count()  # null flags take no place
    for i, (key, rate) in got.items():
        assert key == (None if want[i][0] is None else str(want[i][0])) and abs(rate - want[i][1]) < 1e-12


def test_t2_chunks_of_a_hot_key(spark, tmp):
    """One key, all rows in one stretch, in many Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        rows = [(i, T0 + dt.timedelta(milliseconds=(i * 7919) % 1000), 1, i % 3 == 0) for i in range(1000)]
        log = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, missed BOOLEAN")
        end = spark.createDataFrame([(-1, T0 + dt.timedelta(days=1), 2, True)], log.schema)
        got = feed(spark, tmp, "hot", [log.unionByName(end)], log.schema, lambda s: jobs.stream_rolling_n(s, "user_id", F.col("missed"), n=10, watermark="1 second"))
        want = {r.event_id: r.rate for r in metrics.rolling_rate(log, F.col("missed"), ["user_id"], ["ts", "event_id"], n=10).collect()}
        assert {r.event_id: round(r.rate, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def transitions(states):
    out = []
    for r in states.collect():
        out.append((r.alertname, "pending", r.start_slot))
        if r.fired:
            out.append((r.alertname, "firing", r._fire_slot))
        if r._end_slot is not None:
            out.append((r.alertname, "resolved" if r.fired else "inactive", r._end_slot))
    return sorted(out)


WINDOWED = [r.name for r in (alerts.HIGH_ERROR_RATE, alerts.LOW_CONFIDENCE, alerts.HIGH_LATENCY)]


def test_t3_live_alerts_match_r7_with_late_rows_and_silence(spark, tmp):
    log = requests(spark)
    until = T0 + dt.timedelta(hours=9)  # three hours after the last request
    ticks_schema = LOG + ", tick BOOLEAN"
    parts = [p.withColumn("tick", F.lit(False)) for p in shuffled(log, 3, 600)]
    tick = flush(spark, ticks_schema, ts=until + dt.timedelta(minutes=12), tick=True)

    def build(s):
        return jobs.stream_live_alerts(s.where("not tick"), "12 minutes", ticks=s.where("tick"))

    got = feed(spark, tmp, "live", [*parts, tick], ticks_schema, build)
    conds = alerts.evaluate_rules(log, until=str(until)).where(F.col("alertname").isin(WINDOWED))
    last = int(until.replace(tzinfo=dt.timezone.utc).timestamp()) // 30
    want = [t for t in transitions(alerts.alert_states_all(conds)) if t[2] < last]
    got = sorted((r.alertname, r.state, r.slot) for r in got.collect() if r.slot < last)
    assert got == want
    assert {(a, s) for a, s, _ in got} >= {("HighErrorRate", "firing"), ("HighErrorRate", "resolved"), ("LowConfidenceTranslations", "firing"), ("HighLatency", "firing")}


def test_t3_live_alerts_by_service(spark, tmp):
    log = requests(spark, 2, 500, 5).withColumn("service", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b"))
    end = flush(spark, LOG + ", service STRING", ts=T0 + dt.timedelta(days=1), status="success", service="c")
    got = feed(spark, tmp, "by", [log.unionByName(end)], log.schema, lambda s: jobs.stream_live_alerts(s, "1 minute", by=["service"])).collect()
    for name in "ab":
        one = log.where(F.col("service") == name)
        conds = alerts.evaluate_rules(one, until=str(T0 + dt.timedelta(hours=20))).where(F.col("alertname").isin(WINDOWED))
        last = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 30 + 2000
        assert sorted((r.alertname, r.state, r.slot) for r in got if r.service == name and r.slot < last) == [
            t for t in transitions(alerts.alert_states_all(conds)) if t[2] < last]


EVAL = "alertname STRING, slot BIGINT, cond BOOLEAN"


def test_t3_timers_fire_and_resolve_without_evaluations(spark, tmp):
    """Alert A is told true twice and then no more; only B's evaluations move time on."""
    def evals(rows):
        return spark.createDataFrame(rows, EVAL)

    parts = [evals([("A", 100, True), ("A", 101, True), ("B", 100, False)]), evals([("B", 103, False)]), evals([("B", 105, True)]),
             evals([("B", 120, False)]), evals([("B", 121, False)])]
    got = []
    path, sink, ck = (os.path.join(tmp, f"timers_{x}") for x in ("in", "out", "ck"))
    os.makedirs(path)
    out = jobs.stream_alert_state(spark.readStream.schema(EVAL).parquet(path), {"A": 120, "B": 0}, stale_after=300)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
        got.append(sorted(tuple(r) for r in spark.read.schema(out.schema).parquet(sink).collect()))
    assert got[0] == [("A", "pending", 100)]
    assert got[1] == got[0]  # 103: not yet 120 s
    assert ("A", "firing", 104) in got[2]  # by the timer: no evaluation of A since 101
    assert ("A", "resolved", 111) in got[3]  # 300 s after the last evaluation
    assert [t for t in got[-1] if t[0] == "B"] == [("B", "firing", 105), ("B", "pending", 105), ("B", "resolved", 115)]


def test_t3_machine_on_runs_equals_slot_by_slot():
    """Random evaluations in random portions, against one step a slot."""
    for seed in range(60):
        rng = np.random.RandomState(seed)
        conds = np.repeat(rng.rand(40) < 0.5, rng.randint(1, 9, 40))
        wait, want, since, firing = int(rng.randint(0, 6)), [], None, False
        for t, c in enumerate(conds.tolist()):
            if c and since is None:
                since, firing = t, False
                want.append(("pending", t))
            if c and not firing and t - since >= wait:
                firing = True
                want.append(("firing", t))
            if not c and since is not None:
                want.append(("resolved" if firing else "inactive", t))
                since = None
        import pandas as pd
        m = live.AlertStates({"x": 30 * wait}, 30, 10, ["alertname"])
        value, got, at = None, [], 0
        slots = rng.permutation(len(conds))
        while at < len(conds):
            nxt = min(len(conds), at + int(rng.randint(1, 40)))
            rows = slots[(slots >= at) & (slots < nxt)]
            frame = pd.DataFrame({"slot": rows, "until": rows, "cond": conds[rows]})
            value, out, _ = m.advance(("x",), value, iter([frame]), (nxt - 1) * 30_000)
            got += [] if out is None else list(zip(out["state"], out["slot"]))
            at = nxt
        assert got == want, seed


def test_r6_heartbeats_match_batch_with_trailing_silence(spark, tmp):
    log = requests(spark, 3, 400).where("user_id is not null")
    until = T0 + dt.timedelta(hours=9)
    end = flush(spark, LOG, event_id=-1, ts=until + dt.timedelta(minutes=12), user_id=999)
    parts = shuffled(log, 3, 600)
    got = feed(spark, tmp, "beat", [*parts, end], LOG, lambda s: jobs.stream_heartbeats(s, ["user_id"], 300, "12 minutes")).where("user_id <> 999").collect()
    want = alerts.heartbeat_gaps(log, ["user_id"], 300, until=str(until)).collect()

    def text(us):
        return None if us is None else (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)).strftime("%Y-%m-%d %H:%M:%S.%f")

    assert sorted((r.user_id, text(r.last_us), text(r.again_us)) for r in got if r.kind == "up") == sorted(
        (r.user_id, r.last_seen, r.seen_again) for r in want if r.seen_again)
    assert sorted((r.user_id, text(r.last_us)) for r in got if r.kind == "down") == sorted((r.user_id, r.last_seen) for r in want)
    assert sum(r.seen_again is None for r in want) == len({r.user_id for r in log.collect()})  # all are silent in the end


def test_r7_grid_of_a_long_gap_is_many_rows(spark):
    """One request a century before the others: the grid is cut at hours, not one array."""
    rows = [(0, dt.datetime(1990, 1, 1), 1, "error", 10.0, 0.9, True), (1, dt.datetime(1990, 2, 1), 1, "success", 10.0, 0.9, False)]
    log = spark.createDataFrame(rows, LOG)
    got = transitions(alerts.alert_states_all(alerts.evaluate_rules(log).where(F.col("alertname") == "HighErrorRate")))
    first = int(dt.datetime(1990, 1, 1, tzinfo=dt.timezone.utc).timestamp()) // 30
    assert got == [("HighErrorRate", "firing", first + 4), ("HighErrorRate", "pending", first), ("HighErrorRate", "resolved", first + 10)]
    wide = spark.createDataFrame([(0, 10**9)], "lo long, hi long")
    n, longest, total = scale.stretches(wide, 120).agg(F.count("*"), F.max(F.col("_b") - F.col("_a")), F.sum(F.col("_b") - F.col("_a") + 1)).first()
    assert longest == 119 and total == 10**9 + 1 and n == -(-(10**9 + 1) // 120)


# ------------------------------------------------------------------ drift of micro-batches
def _requests(spark, first, texts):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "request_id BIGINT, text STRING")


def test_t6_batches_equal_d1_and_replays_add_nothing(spark, tmp):
    folder, path = os.path.join(tmp, "drift"), os.path.join(tmp, "drift_in")
    lex = spark.createDataFrame([("One",), ("two",), ("three",)], "term string")
    base = _requests(spark, 0, ["one two four", "three two one one"])
    parts = [_requests(spark, 10, ["one five", "two six seven", None]), _requests(spark, 20, ["one two", "three"]), _requests(spark, 30, ["x y", ""])]
    os.makedirs(path)

    def run():
        stream = spark.readStream.schema(base.schema).parquet(path)
        drift_job.stream_drift(stream, lex, folder, os.path.join(tmp, "drift_ck")).awaitTermination()

    def toks(df, side):
        return matching.tokenise(df, "text", [], lower=True).withColumn("side", F.lit(side))

    parts[0].coalesce(1).write.mode("append").parquet(path)
    run()
    assert [(r.batch_id, r.reason, r.drift_detected, r.baseline_version) for r in drift_job.results(spark, folder).collect()] == [(0, "no_baselines", False, None)]
    assert drift_job.publish_baseline(folder, toks(base, "baseline"), lex) == 1
    parts[1].coalesce(1).write.mode("append").parquet(path)
    run()
    assert drift_job.publish_baseline(folder, toks(parts[2], "baseline"), lex) == 2
    parts[2].coalesce(1).write.mode("append").parquet(path)
    run()
    rows = {r.batch_id: r for r in drift_job.results(spark, folder).collect()}
    assert {k: (r.baseline_version, r.n_requests) for k, r in rows.items()} == {0: (None, 3), 1: (1, 2), 2: (2, 2)}
    for batch, baseline in ((1, base), (2, parts[2])):
        want = drift.oov_drift(toks(baseline, "baseline").unionByName(toks(parts[batch], "live")), lex).first()
        got = rows[batch]
        assert (got.baseline_oov, got.live_oov, got.oov_drift) == tuple(want)
    # the same batches once more, after a newer baseline: nothing is added or changed
    drift_job.publish_baseline(folder, toks(parts[0], "baseline"), lex)
    for i, part in enumerate(parts):
        drift_job.judge_batch(part, i, lex, folder)
    again = {r.batch_id: r for r in drift_job.results(spark, folder).collect()}
    assert again == rows


def test_t6_batch_that_had_only_begun_keeps_its_baseline(spark, tmp):
    folder = os.path.join(tmp, "begun")
    lex = spark.createDataFrame([("one",)], "term string")
    word = lambda t: matching.tokenise(_requests(spark, 0, [t]), "text", [], lower=True)
    drift_job.publish_baseline(folder, word("one"), lex)
    drift_job._mark(spark, folder, 7, "begun", 1)  # the driver was lost after this
    assert drift_job.results(spark, folder).count() == 0
    drift_job.publish_baseline(folder, word("two"), lex)
    drift_job.judge_batch(_requests(spark, 0, ["two one"]), 7, lex, folder)
    r = drift_job.results(spark, folder).first()
    assert (r.batch_id, r.baseline_version, r.baseline_oov, r.live_oov, r.drift_detected) == (7, 1, 0.0, 0.5, True)
    drift_job.judge_batch(_requests(spark, 0, []), 8, lex, folder)
    assert drift_job.results(spark, folder).where("batch_id = 8").first().reason == "no_requests"


# ------------------------------------------------------------------ live quality and sketches
def test_m22_stream_meets_late_labels_and_equals_batch(spark, tmp):
    rng = np.random.RandomState(4)
    words = ["movur", "teni", "sal", "vudi", "päle", "orin", "."]
    pair = lambda: " ".join(rng.choice(words, rng.randint(1, 9)))
    rows = [(i, T0 + dt.timedelta(minutes=2 * i), pair() if i % 17 else None, pair() if i % 13 else " ") for i in range(200)]
    late = [int(x) for x in rng.randint(0, 80, 200)]  # minutes; labels after an hour don't count
    schema = "request_id BIGINT, ts TIMESTAMP_NTZ, hypothesis STRING, reference STRING, is_label BOOLEAN"
    log = [(i, t, h, None, False) for i, t, h, _ in rows] + [(i, t + dt.timedelta(minutes=m), None, r, True) for (i, t, _, r), m in zip(rows, late)]
    log.sort(key=lambda x: x[1])
    end = [(-1, T0 + dt.timedelta(days=5), "x", None, False), (-1, T0 + dt.timedelta(days=5), None, "x", True)]
    cut = len(log) // 3
    parts = [spark.createDataFrame(x, schema) for x in (log[:cut], log[cut:2 * cut], log[2 * cut:], end)]
    got = feed(spark, tmp, "m22", parts, schema, lambda s: jobs.stream_live_quality(s.where("not is_label"), s.where("is_label"), "1 hour", watermark="5 minutes"))
    met = spark.createDataFrame([(i, t, h, r) for (i, t, h, r), m in zip(rows, late) if m <= 60], "request_id BIGINT, ts TIMESTAMP, hypothesis STRING, reference STRING")
    want = quality.live_quality(met, "1 hour")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() >= 6
    # the same as the two batch measures of each window
    usable = met.where("hypothesis is not null and trim(reference) <> ''").withColumn("h", F.date_format(F.window("ts", "1 hour")["start"], "yyyy-MM-dd HH:mm:ss"))
    wer = {r.h: r.wer for r in quality.word_error_rate(usable, by=["h"]).collect()}
    bleu = {r.h: r.bleu for r in quality.corpus_bleu(usable, by=["h"]).collect()}
    assert {r.window_start: (r.wer, r.bleu) for r in want.collect()} == {h: (wer[h], bleu[h]) for h in wer}


def test_m13_m14_sketches_merge_within_their_bound(spark, tmp):
    rng = np.random.RandomState(6)
    n = 30_000
    rows = list(zip(range(n), [T0 + dt.timedelta(seconds=int(s)) for s in np.sort(rng.randint(0, 6 * 3600, n))],
                    [int(u) if u % 97 else None for u in rng.randint(0, 20_000, n)], rng.choice(["a", "b"], n).tolist()))
    log = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, kind STRING")
    end = spark.createDataFrame([(-1, T0 + dt.timedelta(days=3), None, "c")], log.schema)
    third = n // 3
    parts = [log.where(f"event_id >= {k * third} and event_id < {(k + 1) * third}") for k in range(3)] + [end]
    sk = feed(spark, tmp, "users", parts, log.schema, lambda s: jobs.stream_user_sketches(s, "5 minutes", ["kind"], "1 minute"))
    bound = 3 * 1.04 / 2 ** (metrics.SKETCH_K / 2)
    for keys, exact_keys in (([], []), (["kind"], ["kind"]), ([F.date_trunc("hour", "window_start").alias("h")], [F.date_trunc("hour", "ts").alias("h")])):
        got = {tuple(r)[:-1]: r.users for r in metrics.users_of_sketches(sk, keys).collect()}
        exact = {tuple(r)[:-1]: r.n for r in log.groupBy(*exact_keys).agg(F.countDistinct("user_id").alias("n")).collect()}
        assert got.keys() - {("c",)} == exact.keys()
        for k, v in exact.items():
            assert abs(got[k] - v) <= bound * v + 1, (k, got[k], v)


class _Handle:
    """State and timers of one key, and how often they were asked."""

    def __init__(self):
        self.maps, self.timers, self.calls = {}, set(), 0

    def _count(self):
        self.calls += 1

    def getValueState(self, name, schema):
        h, kept = self, self.maps.setdefault(name, {})

        class Value:
            get = staticmethod(lambda: (h._count(), kept.get(0))[1])
            update = staticmethod(lambda v: (h._count(), kept.__setitem__(0, v))[0])
            exists = staticmethod(lambda: (h._count(), 0 in kept)[1])

        return Value

    def getMapState(self, name, key_schema, schema):
        h, kept = self, self.maps.setdefault(name, {})

        class Map:
            getValue = staticmethod(lambda k: (h._count(), kept[k])[1])
            updateValue = staticmethod(lambda k, v: (h._count(), kept.__setitem__(k, v))[0])
            removeKey = staticmethod(lambda k: (h._count(), kept.pop(k))[0])
            containsKey = staticmethod(lambda k: (h._count(), k in kept)[1])

        return Map

    def registerTimer(self, t):
        self._count()
        self.timers.add(t)

    def deleteTimer(self, t):
        self._count()
        self.timers.remove(t)

    def listTimers(self):
        self._count()
        return iter(sorted(self.timers))


def _rolling(processor, triggers, key=("k",)):
    """Rows put out by triggers ``(rows, watermark)`` of one key, with the trigger each came in."""
    import types

    handle, out = _Handle(), []
    processor.init(handle)
    for k, (rows, watermark) in enumerate(triggers):
        now = types.SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
        frames = [pd.DataFrame(rows[a:a + 7], columns=["us", "event_id", "flag"]) for a in range(0, len(rows), 7)]
        if frames:
            assert not list(processor.handleInputRows(key, iter(frames), now))
        for t in sorted(t for t in handle.timers if t < watermark):
            for pdf in processor.handleExpiredTimer(key, now, types.SimpleNamespace(getExpiryTimeInMs=lambda t=t: t)):
                out += [(k, *r) for r in pdf[["event_id", "rate"]].itertuples(index=False)]
            handle.timers.remove(t)
    return out, handle


@pytest.mark.parametrize("block, deal", [(4, 10), (16, 1000), (8192, 65536)])
def test_t2_blocks_against_a_plain_version(block, deal):
    """Rows out of order over several triggers, blocks that are cut, rows of the same time."""
    import random

    rnd = random.Random(block)
    triggers, low, number, rows = [], 0, 0, []
    for watermark in (0, 500, 2_000, 2_000, 7_500, 30_000, 90_000):
        new = [(rnd.choice([low + rnd.randrange(40_000), low + 5]) * 1000 + 1, number + i, float(rnd.random() < 0.4)) for i in range(rnd.choice([0, 30, 60]))]
        number += len(new)
        rows += [(len(triggers), *r) for r in new]
        triggers.append((new, watermark))
        low = watermark
    got, handle = _rolling(live.RollingFlags(5, 1000, "event_id", block, deal), triggers)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    want = []
    for i, (came, us, event_id, _) in enumerate(order):
        end = (us // 1_000_000 + 1) * 1000
        out = next((k for k, (_, w) in enumerate(triggers) if k >= came and end < w), None)
        if out is not None:
            flags = [r[3] for r in order[max(0, i - 4):i + 1]]
            want.append((out, event_id, sum(flags) / len(flags)))
    assert len(want) == len(rows) > 100
    assert sorted((k, i, round(r, 9)) for k, i, r in got) == sorted((k, i, round(r, 9)) for k, i, r in want)
    assert not handle.maps["rows"] and not handle.timers


def test_t2_state_calls_go_by_rows_not_by_stretches():
    """A thousand rows of a key, each in a stretch of its own."""
    rows = [(i * 3_600_000_000, i, float(i % 2)) for i in range(1000)]
    got, handle = _rolling(live.RollingFlags(100, 60_000, "event_id"), [(rows, 0), ([], 4_000_000_000_000)])
    assert len(got) == 1000 and handle.calls < 30
