"""Stateful processors with event-time timers: what the streaming jobs keep per key.

All of them act on time as the watermark tells it.  Rows are put in order by their own
time, not by the files or triggers they came with, and a timer moves a key on when no row of
its own does, so silence is seen, too.  State is one small value per key, or chunks of packed
rows by stretch of time where rows wait for the watermark.

``transformWithStateInPandas`` needs the RocksDB state store; ``enable`` sets it for the
session unless another provider that can do it is set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def enable(spark: SparkSession) -> None:
    if "HDFSBacked" in spark.conf.get(PROVIDER):
        spark.conf.set(PROVIDER, ROCKSDB)


class Timed(StatefulProcessor):
    """A processor that moves a key on to the watermark whenever rows or a timer come.

    Subclasses keep a value of ``schema`` and give ``advance(key, value, rows, watermark)``: the new
    value, the rows to put out, and when (ms) to be called next without rows, or None."""

    schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.schema)

    def close(self) -> None:
        pass

    def advance(self, key, value, rows, watermark):
        raise NotImplementedError

    def _go(self, key, rows, timers) -> Iterator[pd.DataFrame]:
        watermark = timers.getCurrentWatermarkInMs()
        value, out, wake = self.advance(key, self.value.get() if self.value.exists() else None, rows, watermark)
        if value is None:
            self.value.clear()
        else:
            self.value.update(value)
        set_ = set(self.handle.listTimers())
        for t in set_:
            if t > watermark and t != wake:  # those that are due go by themselves
                self.handle.deleteTimer(t)
        if wake is not None:
            wake = max(wake, watermark + 1)
            if wake not in set_:
                self.handle.registerTimer(wake)
        if out is not None and len(out):
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._go(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._go(key, iter(()), timerValues)


def _stamp(ms: int) -> pd.Timestamp:
    return pd.Timestamp(ms, unit="ms")


class TrailingSums(Timed):
    """Sums over trailing windows for every evaluation slot, from counts of single slots.

    Slot ``s`` is the evaluation at ``s * seconds``; rows give the counts of requests since the
    evaluation before.  A row put out holds for the slots from ``slot`` to ``until``: every slot that
    a request can be seen from has its own, and silence beyond the longest window is one row,
    however long it lasts.  Slots are put out once the watermark has passed them."""

    schema = "next bigint, slots array<bigint>, counts array<bigint>"

    def __init__(self, names: list[str], outs: list[tuple[str, str, int]], seconds: int, keys: list[str]):
        #: ``outs``: (output column, counted column, slots of its window)
        self.names, self.outs, self.ms, self.keys = names, outs, 1000 * seconds, keys
        self.reach = max(w for *_, w in outs)

    def advance(self, key, value, rows, watermark):
        n = len(self.names)
        start, slots, counts = (None, np.zeros(0, np.int64), np.zeros((0, n), np.int64)) if value is None else (
            value[0], np.array(value[1], np.int64), np.array(value[2], np.int64).reshape(-1, n))
        for pdf in rows:
            slots = np.concatenate([slots, pdf["slot"].to_numpy(np.int64)])
            counts = np.concatenate([counts, pdf[self.names].to_numpy(np.int64)])
        order = np.argsort(slots, kind="stable")
        slots, counts = slots[order], counts[order]
        last = watermark // self.ms
        if start is None:
            start = int(slots[0])
        if last < start:
            return (start, slots.tolist(), counts.ravel().tolist()), None, (start) * self.ms
        own = np.unique(np.concatenate([[start], *(slots + d for d in range(self.reach + 1))]))
        own = own[(own >= start) & (own <= last)]
        total = np.concatenate([np.zeros((1, n), np.int64), np.cumsum(counts, axis=0)])
        upto = total[np.searchsorted(slots, own, "right")]
        out = {k: [v] * len(own) for k, v in zip(self.keys, key)}
        # what is put out now is told at the watermark: it may not be older
        out |= {"t": [_stamp(watermark)] * len(own), "slot": own, "until": np.append(own[1:] - 1, last)}
        for name, source, window in self.outs:
            i = self.names.index(source)
            out[name] = upto[:, i] - total[np.searchsorted(slots, own - window, "right"), i]
        keep = slots > last - self.reach
        return (last + 1, slots[keep].tolist(), counts[keep].ravel().tolist()), pd.DataFrame(out), (last + 1) * self.ms


class AlertStates(Timed):
    """pending -> firing (after ``for``) -> resolved, or back to inactive, per alert.

    Rows are evaluations ``(slot, until, cond)``, each of which holds for its slots.  Those beyond
    the watermark wait in order.  If no evaluation follows, the last one holds for ``stale`` more
    slots at most: until then a pending alert fires when its time comes, by a timer; then the
    condition counts as gone, and a firing alert is resolved."""

    schema = "since bigint, firing boolean, held_until bigint, held boolean, slots array<bigint>, untils array<bigint>, conds array<boolean>"

    def __init__(self, wait: dict[str, int], seconds: int, stale_slots: int, keys: list[str]):
        self.wait, self.ms, self.seconds, self.stale, self.keys = wait, 1000 * seconds, seconds, stale_slots, keys

    def _run(self, state, first: int, last: int, cond: bool, wait: int, out: list) -> None:
        """The condition is so from slot ``first`` to ``last``."""
        if last < first:
            return
        if not cond:
            if state["since"] is not None:
                out.append(("resolved" if state["firing"] else "inactive", first))
                state["since"], state["firing"] = None, False
            return
        if state["since"] is None:
            state["since"], state["firing"] = first, False
            out.append(("pending", first))
        fires = state["since"] + wait
        if not state["firing"] and fires <= last:
            state["firing"] = True
            out.append(("firing", max(fires, first)))

    def advance(self, key, value, rows, watermark):
        state = {"since": None, "firing": False, "held_until": None, "held": False}
        waiting = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        if value is not None:
            state = dict(zip(state, value[:4]))
            waiting = [np.array(value[4], np.int64), np.array(value[5], np.int64), np.array(value[6], bool)]
        frames = [(pdf["slot"].to_numpy(np.int64), pdf["until"].to_numpy(np.int64), pdf["cond"].fillna(False).to_numpy(bool)) for pdf in rows]
        slots, untils, conds = (np.concatenate([w, *f]) for w, f in zip(waiting, zip(*frames))) if frames else waiting
        order = np.argsort(slots, kind="stable")
        slots, untils, conds = slots[order], untils[order], conds[order]
        now = watermark // self.ms
        wait = -(-self.wait.get(key[-1], 0) // self.seconds)  # a rule without a wait fires at once
        out: list[tuple[str, int]] = []
        due = int(np.searchsorted(slots, now, "right"))
        if due:
            # one step for each run of evaluations that say the same and leave no gap longer than stale
            upto = np.minimum(untils[:due], now)
            part = np.flatnonzero((conds[1:due] != conds[:due - 1]) | (slots[1:due] > upto[:-1] + self.stale)) + 1
            for a, b in zip([0, *part.tolist()], [*part.tolist(), due]):
                self._hold(state, int(slots[a]) - 1, wait, out)  # what was said before, up to here
                cond, end = bool(conds[a]), int(upto[a:b].max())
                self._run(state, int(slots[a]), end, cond, wait, out)
                state["held_until"], state["held"] = end, cond
        # evaluations that reach beyond the watermark go on holding
        more = [(int(s), int(u), bool(c)) for s, u, c in zip(slots[due:], untils[due:], conds[due:])]
        self._hold(state, now if not more else min(now, more[0][0] - 1), wait, out)
        wakes = [s for s, *_ in more[:1]]
        if state["since"] is not None:
            wakes.append(state["held_until"] + self.stale)
            if not state["firing"]:
                wakes.append(state["since"] + wait)
        kept = (state["since"], state["firing"], state["held_until"], state["held"], [m[0] for m in more], [m[1] for m in more], [m[2] for m in more])
        frame = pd.DataFrame({k: [v] * len(out) for k, v in zip(self.keys, key)} | {"state": [s for s, _ in out], "slot": [t for _, t in out]}) if out else None
        return kept, frame, min(w for w in wakes) * self.ms if wakes else None

    def _hold(self, state, upto: int, wait: int, out: list) -> None:
        """No evaluation from the last one's end to slot ``upto``: it holds on until it is stale."""
        if state["held_until"] is None or not state["held"] or state["since"] is None:
            return
        last = state["held_until"] + self.stale - 1
        self._run(state, state["held_until"], min(upto, last), True, wait, out)
        if upto > last:
            self._run(state, last + 1, upto, False, wait, out)
            state["held"] = False


class Heartbeats(Timed):
    """Dead-man's switch per source: ``down`` when the watermark has passed the last sign of life by
    the gap, ``up`` with the next sign.  Signs beyond the watermark wait, packed, in order."""

    schema = "last bigint, down boolean, waiting binary"

    def __init__(self, gap_us: int, keys: list[str]):
        self.gap, self.keys = gap_us, keys

    def advance(self, key, value, rows, watermark):
        last, down, waiting = (None, False, b"") if value is None else value
        us = np.sort(np.concatenate([np.frombuffer(bytes(waiting), np.int64), *(pdf["us"].to_numpy(np.int64) for pdf in rows)]))
        now = 1000 * watermark
        due, us = us[us <= now], us[us > now]
        out: list[tuple] = []
        seen = due if last is None else np.concatenate([[last], due])
        for i in np.flatnonzero(np.diff(seen) > self.gap).tolist():
            a, b = int(seen[i]), int(seen[i + 1])
            if not (down and i == 0):
                out.append(("down", a, None))
            out.append(("up", a, b))
            down = False
        if len(seen):
            last = int(seen[-1])
            if len(due) and down and int(due[-1]) > int(seen[0]):
                down = False
            if not down and now - last > self.gap and (not len(us) or us[0] - last > self.gap):
                down = True
                out.append(("down", last, None))
        frame = pd.DataFrame({k: [v] * len(out) for k, v in zip(self.keys, key)} | {
            "kind": [o[0] for o in out], "last_us": [o[1] for o in out], "again_us": pd.array([o[2] for o in out], "Int64")}) if out else None
        wakes = [] if last is None or down else [last + self.gap + 1]
        wakes += us[:1].tolist()
        return (last, down, us.tobytes()), frame, -(-min(wakes) // 1000) if wakes else None


ROW = np.dtype([("us", "<i8"), ("id", "<i8"), ("flag", "<f8")])
#: Where a block's span begins, its first row's time, its name, parts and rows.
BLOCK = np.dtype([("begin", "<i8"), ("first", "<i8"), ("name", "<i8"), ("parts", "<i8"), ("n", "<i8")])


class RollingFlags(StatefulProcessor):
    """Share of flagged rows among the last ``n`` of a key in the order of their time.

    Rows wait in map state in blocks, each with the rows of a span of time that begins where the one
    before ends; a block that has grown beyond twice ``block`` rows is cut.  So what a key costs goes
    by its rows, not by how many stretches of time they lie in, and of a key's rows no more than
    ``deal`` new ones or a block (more, if they have the same time) and the last ``n`` are in memory.
    One timer, at the end of the first stretch in which a row waits, lets out all stretches that the
    watermark has passed."""

    def __init__(self, n: int, stretch_ms: int, id_col: str, block: int = 8192, deal: int = 65536):
        self.n, self.stretch, self.id_col, self.block, self.deal = n, stretch_ms, id_col, block, deal

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "flags binary, wake bigint, fresh bigint, blocks binary")
        self.rows = handle.getMapState("rows", "block bigint, part bigint", "rows binary")

    def close(self) -> None:
        pass

    def _load(self) -> None:
        head = self.head.get()
        self.tail, self.wake, self.fresh, blocks = (b"", None, 0, b"") if head is None else head
        self.tail = np.frombuffer(bytes(self.tail), "<f8")
        self.blocks = np.frombuffer(bytes(blocks), BLOCK)

    def _save(self) -> None:
        """Write the key's head, and set its timer by the first row that waits."""
        wake = self._end(int(self.blocks["first"][0])) if len(self.blocks) else None
        if wake != self.wake:
            if self.wake is not None and self.wake in set(self.handle.listTimers()):
                self.handle.deleteTimer(self.wake)
            if wake is not None:
                self.handle.registerTimer(wake)
        self.head.update((self.tail.tobytes(), wake, self.fresh, self.blocks.tobytes()))

    def _end(self, us: int) -> int:
        return (us // (1000 * self.stretch) + 1) * self.stretch

    def _new(self, rows: np.ndarray) -> np.ndarray:
        """Blocks of rows in order of time; those of the same time stay together."""
        cuts = [0]
        while cuts[-1] < len(rows):
            end = cuts[-1] + self.block
            if end < len(rows):
                end = int(np.searchsorted(rows["us"], rows["us"][end - 1], "right"))
            cuts.append(min(end, len(rows)))
        made = np.zeros(len(cuts) - 1, BLOCK)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            made[i] = (rows["us"][a], rows["us"][a], self.fresh, 1, b - a)
            self.rows.updateValue((self.fresh, 0), (rows[a:b].tobytes(),))
            self.fresh += 1
        return made

    def _take(self, block: np.void) -> np.ndarray:
        """A block's rows in order, out of the state."""
        name, parts = int(block["name"]), int(block["parts"])
        rows = np.concatenate([np.frombuffer(bytes(self.rows.getValue((name, i))[0]), ROW) for i in range(parts)])
        for i in range(parts):
            self.rows.removeKey((name, i))
        return rows[np.lexsort((rows["id"], rows["us"]))]

    def _deal(self, frames: list[np.ndarray]) -> None:
        rows = np.concatenate(frames)
        rows = rows[np.argsort(rows["us"], kind="stable")]
        if not len(self.blocks):
            self.blocks = self._new(rows)
            return
        blocks = self.blocks.copy()
        at = np.maximum(np.searchsorted(blocks["begin"], rows["us"], "right") - 1, 0)
        for k, a, b in _runs(at):
            block = blocks[k]
            self.rows.updateValue((int(block["name"]), int(block["parts"])), (rows[a:b].tobytes(),))
            first = min(int(block["first"]), int(rows["us"][a]))
            blocks[k] = (min(int(block["begin"]), first), first, block["name"], block["parts"] + 1, block["n"] + b - a)
        large = blocks["n"] > 2 * self.block
        self.blocks = np.concatenate([x for k in range(len(blocks)) for x in
                                      ([self._new(self._take(blocks[k]))] if large[k] else [blocks[k:k + 1]])]) if large.any() else blocks

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        frames, n = [], 0
        for pdf in rows:
            packed = np.zeros(len(pdf), ROW)
            packed["us"], packed["id"], packed["flag"] = pdf["us"], pdf[self.id_col], pdf["flag"]
            frames.append(packed)
            n += len(packed)
            if n >= self.deal:
                self._deal(frames)
                frames, n = [], 0
        if n:
            self._deal(frames)
        self._save()
        return iter(())
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        if expiredTimerInfo.getExpiryTimeInMs() == self.wake:  # it goes by itself
            self.wake = None
        watermark = timerValues.getCurrentWatermarkInMs()
        # rows of stretches that end before the watermark
        until = -(-watermark // self.stretch) * self.stretch - self.stretch
        while len(self.blocks) and self.blocks["first"][0] < 1000 * until:
            rows = self._take(self.blocks[0])
            due = int(np.searchsorted(rows["us"], 1000 * until, "left"))
            self.blocks = np.concatenate([self._new(rows[due:]), self.blocks[1:]])
            yield self._rates(key, rows[:due])
        self._save()

    def _rates(self, key, rows: np.ndarray) -> pd.DataFrame:
        seq = np.concatenate([self.tail, rows["flag"]])
        total = np.concatenate([[0.0], np.cumsum(seq)])
        ends = np.arange(len(self.tail) + 1, len(seq) + 1)
        starts = np.maximum(ends - self.n, 0)
        self.tail = seq[-self.n:]
        return pd.DataFrame({"key": [key[0]] * len(rows), self.id_col: rows["id"], "rate": (total[ends] - total[starts]) / (ends - starts)})


def _runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    if len(x):
        cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(x[a]), a, b
