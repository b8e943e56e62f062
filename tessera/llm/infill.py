"""Fill-in-middle transformation: texts cut in three at unit boundaries and put in a new order.

The bytes of a slice of texts are sorted into a few character classes (newline, blank, end
of sentence, continuation of a code point, other), and one wavelet matrix holds the classes
of the whole slice; a text is a stretch of it.  Rank queries combine into boundary counts:
lines are ranks of newlines, sentences the sum of two ranks, code points places less the rank
of continuations.  The cut after a number of units is a select where one class ends a unit,
and a bisection on the summed ranks where several do.  All texts are answered at once.

Units: ``line`` (``[^\\n]*\\n|[^\\n]+``), ``sentence`` (ends after each of ``.!?`` and newline),
``word`` (ends after each blank, tab or newline) and ``char`` (code points).  What stands after the last end
is a unit, too.  The cuts are drawn from a hash of the row's id, so a text is cut alike
wherever it runs; rows without an id draw as id ``null``.

Null text counts as empty.  Empty texts, texts that hold a marker, and the share that isn't
chosen keep the form ``plain``.  Repeated rows are cut alike.  Other columns are passed through,
whatever their names but ``out``.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
OTHER, CONTINUATION, BLANK, NEWLINE, STOP = range(5)
PLANES = 3
#: Classes that end a unit; code points are counted by what continues them.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP), "word": (NEWLINE, BLANK), "char": None}
#: Bytes of text that share a matrix.
SLICE = 4 << 20
INFILL = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"

CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[0x80:0xC0] = CONTINUATION
CLASSES[[*b" \t"]] = BLANK
CLASSES[[*b".!?"]] = STOP
CLASSES[ord("\n")] = NEWLINE


class Boundaries:
    """Unit boundaries of the texts that lie at ``[start, end)`` of some bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, unit: str):
        classes = CLASSES[data]
        self.matrix, self.start, self.end, self.ends = WaveletMatrix.of(classes, PLANES), start, end, UNITS[unit]
        self.before = self._count(start)
        self.closed = self._count(end) - self.before
        if self.ends is None:
            self.n = self.closed
        else:
            last = classes[np.maximum(end - 1, 0)] if len(classes) else np.zeros(len(start), np.uint8)
            self.n = self.closed + ((end > start) & ~np.isin(last, self.ends))

    def _count(self, pos: np.ndarray) -> np.ndarray:
        """Boundaries before each place."""
        if self.ends is None:
            return pos - self.matrix.rank(CONTINUATION, pos)
        return sum(self.matrix.rank(c, pos) for c in self.ends)

    def chars(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between places."""
        both = self.matrix.rank(CONTINUATION, np.concatenate([start, end]))
        return end - start - (both[len(start):] - both[:len(start)])

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Place after the first ``k`` units of each text, ``k`` of 0 to ``n``."""
        out = np.where(k == 0, self.start, self.end)
        inner = np.flatnonzero((k > 0) & (k < self.n) | (k == self.n) & (k == self.closed) & (k > 0))
        if not len(inner):
            return out
        goal = (self.before + k)[inner]
        if self.ends and len(self.ends) == 1:
            out[inner] = self.matrix.select(self.ends[0], goal - 1) + 1
            return out
        # the count is at least the goal at ``high``, less at ``low``; code points end where the next begins
        ask = goal + 1 if self.ends is None else goal
        low, high = self.start[inner], self.end[inner] + (self.ends is None)
        while (apart := high - low > 1).any():
            mid = np.where(apart, (low + high) // 2, high)
            enough = (self._count(np.minimum(mid, self.matrix.n)) >= ask) | (mid > self.end[inner])
            low, high = np.where(apart & ~enough, mid, low), np.where(apart & enough, mid, high)
        out[inner] = high - (self.ends is None)
        return out


def _cut_slice(texts: pa.Array, h: np.ndarray, unit: str, rate: int, spm: int) -> pa.Array:
    """The struct of ``INFILL`` for each text; ``h``: four hashes a row."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    units = Boundaries(data, start, end, unit)
    first, second = h[0] % (units.n + 1), h[1] % (units.n + 1)
    a, b = units.cut(np.minimum(first, second)), units.cut(np.maximum(first, second))
    plain = (end == start) | (h[2] % 100 >= rate)
    for marker in MARKERS:
        plain |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    swap = h[3] % 100 < spm
    prefix_chars, middle_chars = units.chars(start, a), units.chars(a, b)
    raw = data.tobytes()
    p, s, m = (x.encode() for x in MARKERS)
    out = []
    for whole, spm_form, i, j, k, n in zip(plain.tolist(), swap.tolist(), start.tolist(), a.tolist(), b.tolist(), end.tolist()):
        if whole:
            out.append(raw[i:n])
        elif spm_form:
            out.append(b"".join((s, raw[k:n], p, raw[i:j], m, raw[j:k])))
        else:
            out.append(b"".join((p, raw[i:j], s, raw[k:n], m, raw[j:k])))
    form = np.where(plain, "plain", np.where(swap, "spm", "psm"))
    return pa.StructArray.from_arrays(
        [pa.array(units.n), pa.array(form.tolist(), pa.string()), pa.array(prefix_chars, pa.int64(), mask=plain), pa.array(middle_chars, pa.int64(), mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())], ["n", "form", "prefix_chars", "middle_chars", "output"])


def hashes(key: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the sha256 of ``seed:key`` as whole numbers."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, unit: str = "line", rate: int = 100, spm: int = 50, seed: int = 7, doc_id: str = "doc_id",
              text: str = "text", out: str = "infill") -> DataFrame:
    """Add a struct ``out``: ``n`` units, ``form`` (``plain``, ``psm`` or ``spm``), code points of
    prefix and middle (null if plain) and ``output``.  ``rate`` per cent of the rows are cut, of
    which ``spm`` per cent have the suffix first."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")

    @F.arrow_udf(INFILL)
    def cut(column: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        h = np.array([x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)])
        size = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, done, a = np.cumsum(size), [], 0
        while a < len(column):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE, "right")))
            done.append(_cut_slice(column.slice(a, b - a), h[:, a:b], unit, rate, spm))
            a = b
        return pa.concat_arrays(done) if done else pa.array([], type=_STRUCT)

    return df.withColumn(out, cut(F.coalesce(F.col(text).cast("string"), F.lit("")), *hashes(F.col(doc_id), seed)))


_STRUCT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def restore(output: Column, form: Column) -> Column:
    """The text again.  A cut text holds no marker and no marker can begin inside one and end
    outside, so the three in the output are those that were put there."""
    parts = F.split(output, "|".join(MARKERS), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
