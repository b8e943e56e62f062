"""Tokenising, cutting and best-two-fit packing of documents into fixed-size sequences.

Best-two-fit: a sequence is filled greedily with the longest documents that fit; then its
smallest document is replaced by two unpacked ones if together they fill the widened gap
more tightly.  Lengths are whole numbers up to the sequence size, so the packing is planned
on the *histogram of lengths* - at most ``size`` rows however large the corpus - as layouts
(how many documents of each length) with the number of sequences that repeat them.  Spark
numbers the documents of each length and a range join gives every one its place; no
document passes through the driver and no length is handled by one task.

Null text counts as empty: it has only the closing id.  Rows with null or repeated ids are
packed like any other, row by row; documents of the same length go in any order.  Long documents
are cut, never shortened.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import give_back, hold, materialise, n_tasks
from tessera.llm.shards import SLICE, Memo, byte_letters, lists, slices

SIZE = 4096
CLOSE = 1
#: Parts of lower-case Latin letters, digits and marks but the apostrophe: the tokenizer's
#: normaliser leaves them as they are, and they fall into pieces wherever letters, digits (each by
#: itself) and marks meet.
_LATIN = r"^[\x21-\x26\x28-\x40\x5b-\x7e\x{df}-\x{f6}\x{f8}-\x{ff}]+$"
_NONE, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = np.full(256, _LETTER, np.uint8)
_CLASS[:128] = [_LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _NONE if b == 0 else _MARK for b in range(128)]


class Words:
    """Ids of a text as the tokenizer gives them, memoised by its parts between white space: the
    tokenizer drops white space and joins nothing across it.  It lower-cases too, so parts are
    kept with A-Z in lower case.  All steps are taken for a column of texts at once.  Texts that
    may spell a special token are given to the tokenizer whole."""

    def __init__(self, path: str, memo: int = 150_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: The same vocabulary over pieces that are parted already and written in its letters.
        self.parted = Tokenizer.from_file(path)
        self.parted.normalizer = normalizers.Sequence([])
        self.parted.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        self.parted.model._resize_cache(0)  # what it is asked is new
        self.letters = byte_letters()
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)  # ids that end a word
        self.ends[[i for w, i in names.items() if w.endswith("</w>")]] = True
        self.special = sorted({w[:2] for w in (t.content for t in self.tokenizer.get_added_tokens_decoder().values())})
        self.memo = Memo(self._learn, memo)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _pieces(self, parts: pa.Array) -> pa.LargeListArray:
        """Ids of parts of ``_LATIN``: one call, told apart by the ids that end words."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(parts)], parts), "\0")[0].as_buffer()
        data = np.frombuffer(joined, np.uint8)
        kind = _CLASS[data]
        new = np.zeros(len(data), bool)
        new[1:] = (kind[1:] != _NONE) & (kind[:-1] != _NONE) & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        at = np.arange(len(data)) + np.cumsum(new)
        text = np.zeros(at[-1] + 1, "<u4")
        text[at] = self.letters[data]
        ids = np.array(self.parted.encode_batch_fast([text.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, "<u4")
        # pieces up to the end of each part
        n = np.append(np.cumsum(new)[kind == _NONE], new.sum()) + np.arange(1, len(parts) + 1)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == n[-1] and stops[-1] == len(ids):
            return lists(ids, stops[n - 1])
        return self._single(parts)

    def _single(self, parts: pa.Array) -> pa.LargeListArray:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts.to_pylist(), add_special_tokens=False)]
        return lists(np.array([i for x in ids for i in x], "<u4"), np.cumsum([len(x) for x in ids]))

    def _learn(self, parts: pa.Array) -> tuple[pa.Array, pa.LargeListArray]:
        latin = pc.match_substring_regex(parts, _LATIN)
        words, ids = [], []
        for some, ask in ((parts.filter(latin), self._pieces), (parts.filter(pc.invert(latin)), self._single)):
            for a in range(0, len(some), 10_000):
                words.append(some.slice(a, 10_000))
                ids.append(ask(words[-1]))
        return pa.concat_arrays(words), pa.concat_arrays(ids)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one text after another, and how many each has."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = texts.cast(pa.string()).fill_null("")
        odd = functools.reduce(pc.or_, [pc.match_substring(texts, s) for s in self.special])
        odd_rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        whole = [self._plain(texts[int(i)].as_py()) for i in odd_rows]
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(odd, "", texts) if whole else texts))
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        entries, n = self._entries(coded.dictionary), len(coded.dictionary)
        if whole:
            codes = np.insert(codes, (np.cumsum(lengths) - lengths)[odd_rows], n + np.arange(len(whole)))
            lengths[odd_rows] += 1
            entries = pa.concat_arrays([entries, lists(np.concatenate(whole), np.cumsum([len(w) for w in whole]))])
        sizes = pc.list_value_length(entries).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])[np.cumsum(lengths)]
        return entries.take(pa.array(codes)).flatten().to_numpy(), np.diff(ends, prepend=0)

    def _entries(self, words: pa.Array) -> pa.LargeListArray:
        """Ids of distinct parts; white space at the ends of a text leaves an empty one."""
        if not len(words):
            return lists(np.zeros(0, "<u4"), np.zeros(0, np.int64))
        empty = pc.equal(words, "")
        if not pc.any(empty).as_py():
            return self.memo.look_up(words)
        rest = words.filter(pc.invert(empty))
        found = self.memo.look_up(rest) if len(rest) else lists(np.zeros(0, "<u4"), np.zeros(0, np.int64))
        found = pa.concat_arrays([found, lists(np.zeros(0, "<u4"), np.zeros(1, np.int64))])
        at = np.full(len(words), len(rest))
        at[~empty.to_numpy(zero_copy_only=False)] = np.arange(len(rest))
        return found.take(pa.array(at))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, n = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(n)
        return [ids[b - k:b].astype("<u4").tobytes() for b, k in zip(ends, n)]


@functools.lru_cache(2)
def load(path: str) -> Words:
    return Words(path)


def cut(df: DataFrame, path: str, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", most: int = SLICE) -> DataFrame:
    """Pieces of at most ``size`` ids of every document: ``doc_id``, ``piece`` (from 0), ``start``
    (ids of the document before it), ``length`` and ``ids`` (little-endian unsigned 32-bit).  Texts are taken
    about ``most`` bytes at a time: fewer need less of a worker's memory and more time."""
    id_type = df.schema[doc_id].dataType.simpleString()

    def run(source):
        hold("packing", load.cache_clear)
        words = load(path)
        for batch in source:
            for a, b in slices(batch.column(1), most):
                ids, n = words.encode_column(batch.column(1).slice(a, b - a))
                total = n + 1
                ends = np.cumsum(total)
                closed = np.full(int(ends[-1]), CLOSE, "<u4")
                inside = np.ones(len(closed), bool)
                inside[ends - 1] = False
                closed[inside] = ids
                pieces = -(-total // size)
                row = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * size
                at = (ends - total)[row] + start
                length = np.minimum(total[row] - start, size)
                offsets = 4 * np.append(at, ends[-1])
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(a + row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     binary.cast(pa.binary())], ["doc_id", "piece", "start", "length", "ids"])
                give_back()

    schema = f"doc_id {id_type}, piece int, start long, length long, ids binary"
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def layouts(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-two-fit on a histogram of lengths: ``[([(length, how many), ...], sequences), ...]``.

    Each layout is repeated as often as the counts allow, so there are a few layouts for each
    length, not for each document."""
    left = {n: c for n, c in counts.items() if c > 0}
    sizes = sorted(left)
    out = []

    def take(n: int, k: int) -> None:
        left[n] -= k
        if not left[n]:
            sizes.remove(n)

    while sizes:
        used: dict[int, int] = {}
        gap, at = size, len(sizes)
        have = dict(left)
        while at and gap:  # greedy: the longest that fits, as often as it fits
            at = bisect_right(sizes, gap, 0, at)
            if not at:
                break
            n = sizes[at - 1]
            k = min(have[n], gap // n)
            used[n] = k
            gap -= k * n
            at -= 1
        if gap:
            last = min(used)
            room = gap + last
            avail = np.array([n for n in sizes[:bisect_right(sizes, room - 1)] if left[n] > used.get(n, 0)], np.int64)
            if len(avail):
                spare = np.array([left[int(n)] - used.get(int(n), 0) for n in avail])
                mate = np.searchsorted(avail, room - avail, "right") - 1
                mate -= (mate == np.arange(len(avail))) & (spare < 2)
                total = np.where(mate >= 0, avail + avail[mate], 0)
                best = int(total.argmax())
                if total[best] > last:  # two unpacked documents fill the widened gap better
                    used[last] -= 1
                    for n in (int(avail[best]), int(avail[mate[best]])):
                        used[n] = used.get(n, 0) + 1
        used = {n: k for n, k in used.items() if k}
        times = min(left[n] // k for n, k in used.items())
        for n, k in used.items():
            take(n, k * times)
        out.append((sorted(used.items(), reverse=True), times))
    return out


def places(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Which documents of a length go where: (length, first rank, end rank, how many a sequence,
    first sequence, offset of the first in its sequence)."""
    rank = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for layout, times in layouts(counts, size):
        offset = 0
        for n, k in layout:
            rows.append((n, rank[n], rank[n] + k * times, k, sequence, offset))
            rank[n] += k * times
            offset += n * k
        sequence += times
    return rows


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``size``.

    ``pieces`` is read three times; give it written (``materialise``) if it is dear to make."""
    spark = pieces.sparkSession
    columns = pieces.columns
    share = n_tasks(pieces, 8)
    dealt = pieces.withColumn("__share", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(share)).cast("int"))
    shares = materialise(dealt.groupBy("length", "__share").agg(F.count("*").alias("__n")))
    histogram = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if any(n is None or not 0 < n <= size for n in histogram):
        raise ValueError(f"lengths are from 1 to {size}")
    before = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("length", "__share", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__share").orderBy(*[F.col(f"`{c}`") for c in columns])
    ranked = (dealt.withColumn("__rank", F.row_number().over(inside) - 1)
              .join(shares, ["length", "__share"]).withColumn("__rank", F.col("__rank") + F.col("__before")))
    # at most a few rows for each length: bounded by the sequence size, whatever the corpus
    where = spark.createDataFrame(places(histogram, size),
                                  "`length` long, __lo long, __hi long, __k long, __sequence long, __offset long")
    found = ranked.join(F.broadcast(where), (ranked["length"] == where["length"])
                        & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
    nth = F.col("__rank") - F.col("__lo")
    return found.select(
        *[pieces[c] for c in columns],
        (F.col("__sequence") + F.floor(nth / F.col("__k"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + (nth % F.col("__k")) * ranked["length"]).cast("long").alias("offset"))
