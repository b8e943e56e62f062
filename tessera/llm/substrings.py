"""Removal of word sequences that an earlier document already holds.

A window is ``WINDOW`` consecutive words of one document; a word goes if a window over it
also starts in a document with a smaller id.  Fixed-block anchors: documents are cut into
non-overlapping reference blocks of ``BLOCK`` words, and every rolling window of that many
words probes them.  As ``WINDOW >= 2 * BLOCK - 1``, each window of the earlier document holds
a whole reference block, so any repeat is anchored.  Anchored places are then extended: the
windows round a hit are compared whole (96 hash bits) and overlapping repeats merge to
maximal ones.

Only hashes travel, packed: documents are written once as chunks, each chunk sends its
distinct block hashes to the range of hashes they lie in (sorted, as differences, about three
bytes each) and gets those back that are a reference block somewhere and occur in two
documents; in the second round it sends the windows round those hits with the smallest id
that has them, and gets the smallest id of all.  A passage that thousands of documents share
is one hash for a chunk, never a pair of documents.  Chunks are bucketed by their number, so
answers come to them without shuffling a text.

Null text has no words.  Rows with a null id neither lose words nor make others lose any;
rows that repeat an id are judged each by itself, and an equal id is not a smaller one.
Ids are whole numbers.  Texts are read whole, an empty table gives no rows, and all other columns
are passed through whatever their names (but those of the result).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Cache, give_back, hold, n_tasks
from tessera.session import ensure_checkpoint_dir

WINDOW = 13
BLOCK = 7
#: Bytes of text in a chunk, and bits of a block hash.
CHUNK = 8 << 20
BITS = 44

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _word_hash(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(word)


_hashes = Cache(_word_hash, 300_000)


def _forget() -> None:
    _hashes.clear()
    _hashes.older.clear()


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits (in place)."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


@functools.lru_cache(3)
def _base(seed: int) -> tuple[int, int]:
    """An odd number and its inverse modulo 2**64."""
    odd = int(np.random.RandomState(seed).randint(2 ** 61, 2 ** 62)) * 2 + 1
    return odd, pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.multiply.accumulate(x)


def _rolling(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Polynomial hash of the ``n`` words from each place on, from running sums."""
    base, inverse = _base(seed)
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(words * _powers(base, len(words)), dtype=np.uint64)]
    m = max(0, len(words) - n + 1)
    return _mix((total[n:n + m] - total[:m]) * _powers(inverse, m))


def _among(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Indices of the elements of ``x`` that are among ``sorted_``; a bit map leaves few to look up."""
    if not len(sorted_) or not len(x):
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    seen = np.zeros(1 << 24, bool)
    seen[sorted_ & low] = True
    maybe = np.flatnonzero(seen[x & low])
    at = np.minimum(np.searchsorted(sorted_, x[maybe]), len(sorted_) - 1)
    return maybe[sorted_[at] == x[maybe]]


def _pack(x: np.ndarray, rising: bool = False) -> bytes:
    """64-bit numbers, compressed byte plane by byte plane; differences if they rise."""
    if rising and len(x):
        x = np.r_[x[:1], x[1:] - x[:-1]]
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(raw: bytes, kind=np.uint64, rising: bool = False) -> np.ndarray:
    x = np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if rising else x


class Chunk:
    """Word hashes of a chunk's documents, one after the other."""

    def __init__(self, raw: bytes, doc_id: str, text: str):
        hold("substrings", _forget)
        give_back()  # of the chunk before
        self.table = pa.ipc.open_stream(raw).read_all()
        self.texts = self.table.column(text).cast(pa.large_binary()).to_pylist()
        parts = []
        for t in self.texts:
            words = t.split() if t else []
            parts.append(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)))
        self.n = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        ids = self.table.column(doc_id)
        self.valid = ids.is_valid().to_numpy()
        self.ids = ids.cast(pa.int64()).fill_null(0).to_numpy()

    def starts(self, n: int) -> np.ndarray:
        """Places from which ``n`` words of one document with an id follow."""
        count = np.where(self.valid, np.maximum(self.n - n + 1, 0), 0)
        return np.repeat(self.first - (np.cumsum(count) - count), count) + np.arange(count.sum())

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first + self.n, places, "right")

    def blocks(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rolling blocks and their hashes."""
        at = self.starts(block)
        return at, _rolling(self.words, block, 1)[at] >> np.uint64(64 - BITS)

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The two hashes of the windows that start at these places."""
        return _rolling(self.words, window, 2)[at], (_rolling(self.words, window, 3)[at] >> np.uint64(32))


def _ranges(high: np.ndarray, top_bits: int, ranges: int) -> Iterator[tuple[int, int, int]]:
    """Bounds in sorted hashes of each range of hash values that has any."""
    bounds = np.array([(k << top_bits) // ranges for k in range(ranges)] + [(1 << top_bits) - 1], np.uint64)
    cut = np.searchsorted(high, bounds[:-1], "left").tolist() + [len(high)]
    return ((k, a, b) for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b)


def _runs(new: np.ndarray) -> np.ndarray:
    return np.flatnonzero(new)


def _chunks(df: DataFrame, doc_id: str, text: str, size: int, buckets: int) -> DataFrame:
    """``df`` as a written table of chunks ``(chunk, rows)``, bucketed by chunk; rows are an
    Arrow stream of all columns."""
    spark = df.sparkSession

    def run(source):
        hold("substrings", _forget)
        part, n = TaskContext.get().partitionId(), 0
        held, weight = [], 0

        def flush():
            nonlocal n, held, weight
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            row = pa.RecordBatch.from_arrays([pa.array([(part << 32) + n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])
            n, held, weight = n + 1, [], 0
            return row

        for batch in source:
            length = np.array([len(t) for t in batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"").to_pylist()], np.int64)
            at = 0
            while at < batch.num_rows:
                room = np.cumsum(length[at:])
                k = max(1, int(np.searchsorted(room, max(size - weight, 0), "right")))
                held.append(batch.slice(at, k))
                weight += int(room[k - 1])
                at += k
                if weight >= size or at < batch.num_rows:
                    yield flush()
        if held:
            yield flush()

    name = f"tessera_chunks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    (df.mapInArrow(run, "chunk long, rows binary").write.bucketBy(buckets, "chunk").option("path", path)
     .option("compression", "none").format("parquet").saveAsTable(name))
    return spark.table(name)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK,
                   chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``n_words``, ``removed`` (maximal runs of removed words: start, end) and
    ``kept`` (the other words, joined by one space); columns of these names are replaced."""
    if window < 2 * block - 1:
        raise ValueError("a window has to hold a whole block wherever it starts")
    df = df.drop("n_words", "removed", "kept")
    df = df.withColumn(text, F.col(text).cast("string"))
    ranges = n_tasks(df, 8)
    chunks = _chunks(df, doc_id, text, chunk, ranges)

    def probe(source):
        for batch in source:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = Chunk(raw, doc_id, text)
                at, h = c.blocks(block)
                row = c.rows(at)
                aligned = (at - c.first[row]) % block == 0
                order = np.argsort(h)
                h, ids, aligned = h[order], c.ids[row[order]], aligned[order]
                run = _runs(np.r_[True, h[1:] != h[:-1]][:len(h)])
                if not len(run):
                    continue
                h, several = h[run], np.minimum.reduceat(ids, run) != np.maximum.reduceat(ids, run)
                aligned = np.logical_or.reduceat(aligned, run)
                out = [(k, number, _pack(h[a:b], True), np.packbits(aligned[a:b]).tobytes(), np.packbits(several[a:b]).tobytes())
                       for k, a, b in _ranges(h, BITS, ranges)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                                 ["range", "chunk", "hashes", "aligned", "several"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        """Hashes that are a reference block somewhere and lie in two documents, for each chunk."""
        parts = [_unpack(x, rising=True) for x in group["hashes"]]
        h = np.concatenate(parts)
        flags = [np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)) for x, p in zip(group[c], parts)]).astype(bool)
                 for c in ("aligned", "several")]
        order = np.argsort(h)
        sorted_ = h[order]
        run = _runs(np.r_[True, sorted_[1:] != sorted_[:-1]])
        count = np.diff(np.r_[run, len(h)])
        good = np.logical_or.reduceat(flags[0][order], run) & ((count > 1) | np.logical_or.reduceat(flags[1][order], run))
        good = sorted_[run[good]]
        out = []
        for number, p in zip(group["chunk"], parts):
            hit = p[_among(p, good)]
            if len(hit):
                out.append((number, _pack(hit, True)))
        return pd.DataFrame(out, columns=["chunk", "hashes"])

    hits = (chunks.mapInArrow(probe, "range int, chunk long, hashes binary, aligned binary, several binary")
            .groupBy("range").applyInPandas(answer, "chunk long, hashes binary"))

    def extend(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """Windows round the hits with the smallest id that has them in this chunk."""
        out = []
        good = np.sort(np.concatenate([_unpack(x, rising=True) for x in right.column("hashes").to_pylist()] or [np.zeros(0, np.uint64)]))
        for raw in left.column("rows").to_pylist() if len(good) else ():
            c = Chunk(raw, doc_id, text)
            at, h = c.blocks(block)
            hit = np.zeros(len(c.words) + 1, np.int64)
            hit[at[_among(h, good)]] = 1
            total = np.r_[0, np.cumsum(hit)]
            start = c.starts(window)
            start = start[total[start + window - block + 1] > total[start]]  # a hit block lies inside
            a, b = c.windows(start, window)
            ids = c.ids[c.rows(start)]
            order = np.lexsort((ids, b, a))
            a, b, ids = a[order], b[order], ids[order]
            run = _runs(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)])
            a, b, ids = a[run], b[run], ids[run]
            out += [(k, key[0].as_py(), _pack(a[i:j], True), _pack(b[i:j]), _pack(ids[i:j])) for k, i, j in _ranges(a, 64, ranges)]
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], ["range", "chunk", "a", "b", "ids"])

    def earliest(group: pd.DataFrame) -> pd.DataFrame:
        """For each chunk the windows that a smaller id elsewhere has, with the smallest."""
        parts = [(_unpack(a, rising=True), _unpack(b), _unpack(i, np.int64)) for a, b, i in zip(group["a"], group["b"], group["ids"])]
        number = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        a, b, ids = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((ids, b, a))
        a, b, ids, number = a[order], b[order], ids[order], number[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        least = ids[_runs(new)][np.cumsum(new) - 1]
        keep = least < ids
        a, b, least, number = a[keep], b[keep], least[keep], number[keep]
        back = np.argsort(number, kind="stable")
        a, b, least, number = a[back], b[back], least[back], number[back]
        cut = np.searchsorted(number, np.arange(len(parts) + 1))
        out = [(c, _pack(a[i:j], True), _pack(b[i:j]), _pack(least[i:j])) for c, i, j in zip(group["chunk"], cut, cut[1:]) if i < j]
        return pd.DataFrame(out, columns=["chunk", "a", "b", "least"])

    windows = chunks.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, "range int, chunk long, a binary, b binary, ids binary")
    found = windows.groupBy("range").applyInPandas(earliest, "chunk long, a binary, b binary, least binary")

    schema = T.StructType([*df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("removed", SPANS),
                           T.StructField("kept", T.StringType())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        known = [np.concatenate([_unpack(x, kind, rising) for x in right.column(c).to_pylist()] or [np.zeros(0, kind)])
                 for c, kind, rising in (("a", np.uint64, True), ("b", np.uint64, False), ("least", np.int64, False))]
        order = np.lexsort((known[1], known[0]))
        ka, kb, least = (x[order] for x in known)
        tables = [_finish(Chunk(raw, doc_id, text), ka, kb, least, window) for raw in left.column("rows").to_pylist()]
        return pa.concat_tables(tables) if tables else _empty(schema)

    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(finish, schema)


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def _finish(c: Chunk, ka: np.ndarray, kb: np.ndarray, least: np.ndarray, window: int) -> pa.Table:
    """The chunk's rows with their repeats taken out."""
    start = c.starts(window)
    a, b = c.windows(start, window)
    ids = c.ids[c.rows(start)]
    first = ids.copy()  # the smallest id that has the window
    order = np.argsort(a)
    same = np.r_[False, a[order][1:] == a[order][:-1]][:len(a)]
    twins = order[same | np.r_[same[1:], False][:len(a)]]  # windows that may occur twice in this chunk
    if len(twins):
        twins = twins[np.lexsort((ids[twins], b[twins], a[twins]))]
        x, y = a[twins], b[twins]
        new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        first[twins] = ids[twins][_runs(new)][np.cumsum(new) - 1]
    known = _among(a, ka)
    at = np.searchsorted(ka, a[known])
    for step in range(2 if len(ka) else 0):  # two windows may agree in the first hash
        i = np.minimum(at + step, len(ka) - 1)
        hit = (ka[i] == a[known]) & (kb[i] == b[known])
        first[known[hit]] = np.minimum(first[known[hit]], least[i[hit]])
    covered = start[first < ids]
    edge = np.zeros(len(c.words) + 1, np.int64)
    np.add.at(edge, covered, 1)
    np.add.at(edge, covered + window, -1)
    gone = np.cumsum(edge)[:-1] > 0
    spans, kept = [], []
    for t, n, f in zip(c.texts, c.n.tolist(), c.first.tolist()):
        mask = gone[f:f + n]
        words = t.split() if t else []
        if mask.any():
            turn = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2])])
            words = [words[i] for i in np.flatnonzero(~mask).tolist()]
        else:
            spans.append([])
        kept.append(b" ".join(words).decode())
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return (c.table.append_column("n_words", pa.array(c.n, pa.int64())).append_column("removed", pa.array(spans, span))
            .append_column("kept", pa.array(kept, pa.string())))
