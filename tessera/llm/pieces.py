"""SentencePiece (merge-type) encoding and decoding.

Encoding is exact and works by backtracking rather than by simulating merges over
the whole text: an Aho-Corasick automaton yields the longest vocabulary piece at a
character, which is tried first and then the shorter ones that begin it; a piece may
follow another only if the two are *compatible* (re-merging the characters of both gives
exactly the two pieces back), and a bitfield records positions from which no encoding
goes on, so each position fails at most once.

Text is cut where no vocabulary piece can span (before a run of word markers, round
characters outside the alphabet, and before marks such as a full stop if no piece holds
them after a letter), and the cuts are encoded independently and memoised; the rules are
derived from the vocabulary, or verified against it, when a model is loaded.
Segments with repeated word markers hold pieces of equal score, whose order the
pairwise test cannot see; they are merged directly.

Null text counts as empty; empty text has no ids.  Texts are encoded whole, rows that repeat one
another each.  Rows, ids and other columns are passed through untouched, whatever their names
(but that of the result); an empty table gives no rows.
"""

from __future__ import annotations

import array
import functools
import heapq
import itertools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hold
from tessera.llm.shards import Memo, lists, slices

MARK = "▁"
#: Bounds of the memos of a worker: parts (two generations of them), segments and pairs.
PARTS, SEGMENTS, PAIRS = 350_000, 150_000, 500_000


class PieceModel:
    """Vocabulary of one model file with the exact encoder and decoder."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        normal = [i for i in range(self.size)
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {names[i]: i for i in normal}
        self.score = {names[i]: sp.get_score(i) for i in normal}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.alphabet = {c for p in self.id_of for c in p}
        if any(c not in self.id_of for c in self.alphabet):
            raise ValueError("a character of the vocabulary has no piece of its own")
        if any(a != MARK and b == MARK for p in self.id_of for a, b in zip(p, p[1:])):
            raise ValueError("a piece spans the start of a word; segments can't be encoded apart")
        seen: dict[float, int] = {}
        for p in self.id_of:
            seen[self.score[p]] = seen.get(self.score[p], 0) + (len(p) > 1)
        self.tied = {p for p in self.id_of if len(p) > 1 and seen[self.score[p]] > 1}
        #: pieces that merging their own characters gives back; no other can occur in an encoding
        self.whole = {p for p in self.id_of if p in self.tied or self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.whole:
            self.automaton.add_word(p, self.id_of[p])
        self.automaton.make_automaton()
        #: the next shorter piece that begins the same way
        self.shorter = [-1] * self.size
        for p in self.whole:
            self.shorter[self.id_of[p]] = next((self.id_of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.whole), -1)
        self.names, self.length = names, [len(p) for p in names]
        self.surface = [b""] * self.size
        for i in normal:
            self.surface[i] = names[i].replace(MARK, " ").encode()
        for b, i in self.byte_id.items():
            self.surface[i] = bytes([b])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.silent = frozenset(i for i in range(self.size) if sp.is_control(i))
        self.pairs: dict[int, bool] = {}
        least = [p for p in self.tied if not any(q != p and q in p for q in self.tied)]
        self.has_tied = re.compile("|".join(map(re.escape, least)) or "(?!)").search
        #: marks that no piece holds right after a letter: text is cut between the two
        after = {b for p in self.id_of for a, b in zip(p, p[1:]) if a.isalpha()}
        letters = {c for c in self.alphabet if c.isalpha()}
        marks = self.alphabet - letters - after - {MARK}
        kinds = letters, marks, self.alphabet - letters - marks - {MARK}
        letter, mark, other = ("[" + "".join(map(re.escape, sorted(k))) + "]" if k else "(?!)" for k in kinds)
        run = f"(?:{letter}++|{other}++{mark}*+)"
        self.segments = re.compile(f"{MARK}++{mark}*+{run}*+|{mark}++{run}*+|{run}++|"
                                   f"[^{''.join(map(re.escape, sorted(self.alphabet)))}]+").findall
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memo = Memo(self._learn, PARTS)
        self.surfaces = pa.array(self.surface, pa.large_binary())
        #: ids after which text can't be put together piece by piece: silent ones, bytes beyond ASCII
        self.odd = np.zeros(self.size, bool)
        self.odd[[*self.silent, *(i for b, i in self.byte_id.items() if b > 127)]] = True

    def merge(self, text: str) -> list[str]:
        """Merge neighbours of ``text`` in order of score, the left one first among equals."""
        if len(text) > 40:
            return self._merge_long(text)
        part, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(part) - 1):
                x = score.get(part[i] + part[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if at < 0:
                return part
            part[at:at + 2] = [part[at] + part[at + 1]]

    def _merge_long(self, text: str) -> list[str]:
        """The same with a queue, for long texts."""
        part = list(text)
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part):
                score = self.score.get(part[i] + part[j])
                if score is not None:
                    heapq.heappush(heap, (-score, i, part[i] + part[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, merged = heapq.heappop(heap)
            j = right[i]
            if not part[i] or j >= len(part) or part[i] + part[j] != merged:
                continue
            part[i], part[j] = merged, ""
            right[i] = right[j]
            if right[i] < len(part):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p]

    def _compatible(self, pair: int) -> bool:
        """Whether two pieces (ids packed into one number) stay as they are side by side."""
        first, second = self.names[pair // self.size], self.names[pair % self.size]
        ok = self.merge(first + second) == [first, second]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = ok
        return ok

    def backtrack(self, text: str) -> list[int]:
        """The only sequence of pieces of ``text`` whose neighbours are all compatible."""
        n, size, length, shorter, known = len(text), self.size, self.length, self.shorter, self.pairs.get
        longest = self.automaton.iter_long
        # the longest pieces one after the other are often the answer, and else begin it
        greedy = [piece for _, piece in longest(text)]
        path = greedy[:1]
        at = length[greedy[0]]
        for piece in greedy[1:]:
            pair = path[-1] * size + piece
            if (ok := known(pair)) is None:
                ok = self._compatible(pair)
            if not ok:
                break
            path.append(piece)
            at += length[piece]
        else:
            return path
        failed = bytearray(n // 8 + 1)
        piece = shorter[piece]  # -2: the longest piece here; -1: none is left
        while at < n:
            if piece == -2:
                piece = next(longest(text, at))[1]
            before = path[-1] * size if path else -1
            while piece >= 0:
                end = at + length[piece]
                if failed[end >> 3] >> (end & 7) & 1:
                    ok = False
                elif before < 0:
                    ok = True
                elif (ok := known(before + piece)) is None:
                    ok = self._compatible(before + piece)
                if ok:
                    path.append(piece)
                    at, piece = end, -2
                    break
                piece = shorter[piece]
            else:
                if not path:
                    raise ValueError(f"no encoding of {text[:80]!r}")
                failed[at >> 3] |= 1 << (at & 7)
                piece = path.pop()
                at -= length[piece]
                piece = shorter[piece]
        return path

    def _segment(self, segment: str) -> bytes:
        """Ids of a segment that is not in ``known``; they are put there."""
        if segment[-1] not in self.alphabet:
            raw = [self.byte_id.get(b, self.unknown) for b in segment.encode()] if self.byte_id else [self.unknown] * len(segment)
            ids = array.array("i", raw).tobytes()
        elif self.has_tied(segment):
            ids = array.array("i", [self.id_of[p] for p in self.merge(segment)]).tobytes()
        else:
            ids = array.array("i", self.backtrack(segment)).tobytes()
        self.known[segment] = ids
        return ids

    def forget(self) -> None:
        for memo in (self.known, self.parts, self.older, self.pairs):
            memo.clear()
        self.memo.forget()

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if len(self.known) >= SEGMENTS:
            self.known.clear()
        if len(self.parts) >= PARTS:  # what is still in use moves back from the older half
            self.older, self.parts = self.parts, {}
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            known, miss, parts = self.known.get, self._segment, self.segments(MARK + text.replace(" ", MARK))
        else:  # one mark before each part and none inside
            known, miss, parts = self.parts.get, self._part, text.split(" ")
        return b"".join([known(p) or miss(p) for p in parts])

    def _part(self, part: str) -> bytes:
        """Ids of a part between single spaces; it is kept in ``parts``."""
        ids = self.older.get(part)
        if ids is None:
            known, miss = self.known.get, self._segment
            ids = b"".join([known(s) or miss(s) for s in self.segments(MARK + part)])
        self.parts[part] = ids
        return ids

    def _learn(self, parts: pa.Array) -> tuple[pa.Array, pa.LargeListArray]:
        """Ids of new parts between single spaces."""
        if len(self.known) >= SEGMENTS:
            self.known.clear()
        known, miss, segments = self.known.get, self._segment, self.segments
        raw = [b"".join([known(s) or miss(s) for s in segments(MARK + p)]) for p in parts.to_pylist()]
        return parts, lists(np.frombuffer(b"".join(raw), "<u4"), np.cumsum([len(r) // 4 for r in raw]))

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one text after another, and how many each has.  Parts between single
        spaces are encoded apart, each distinct one once; texts where markers or spaces stand
        otherwise go one by one."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = texts.cast(pa.string()).fill_null("")
        apart = [pc.equal(texts, ""), pc.match_substring(texts, MARK), pc.match_substring(texts, "  "), pc.starts_with(texts, " "), pc.ends_with(texts, " ")]
        apart = functools.reduce(pc.or_, apart)
        rows = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        whole = [np.frombuffer(self.encode_bytes(texts[int(i)].as_py()), "<u4") for i in rows]
        parts = pc.split_pattern(pc.if_else(apart, "", texts) if whole else texts, " ")
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        flat = parts.flatten()
        own = np.ones(len(flat), bool)
        own[first[rows]] = False
        coded = flat.filter(pa.array(own)).dictionary_encode()
        n = len(coded.dictionary)
        codes = np.empty(len(flat), np.int64)
        codes[own] = coded.indices.to_numpy(zero_copy_only=False)
        codes[first[rows]] = n + np.arange(len(rows))
        entries = [self.memo.look_up(coded.dictionary)] if n else []
        if whole:
            entries.append(lists(np.concatenate(whole), np.cumsum([len(w) for w in whole])))
        entries = pa.concat_arrays(entries)
        sizes = pc.list_value_length(entries).to_numpy(zero_copy_only=False)
        return entries.take(pa.array(codes)).flatten().to_numpy(), np.add.reduceat(sizes[codes], first)

    def decode_rows(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Texts of the rows ``ids[at[i]:at[i + 1]]``.  The surfaces of all pieces are gathered in one step;
        rows with ids of ``odd`` go one by one."""
        if len(at) < 2:
            return pa.array([], pa.string())
        hits = np.concatenate([[0], np.cumsum(self.odd[ids])])
        odd = hits[at[1:]] > hits[at[:-1]]
        size = np.diff(at)
        plain = ids[~np.repeat(odd, size)]
        ends = np.cumsum(np.where(odd, 0, size))
        gathered = self.surfaces.take(pa.array(plain))
        place = np.frombuffer(gathered.buffers()[1], np.int64)[:len(plain) + 1]
        data = np.frombuffer(gathered.buffers()[2] or b"", np.uint8)[:place[-1]]
        stop = place[ends]
        start = stop - np.diff(stop, prepend=0)
        # the marker that encoding put in front goes
        some = np.flatnonzero(stop > start)
        head = plain[(ends - np.where(odd, 0, size))[some]]
        some = some[(data[start[some]] == 32) & (head != self.unknown) & (head != self.byte_id.get(32, -1))]
        keep = np.ones(len(data), bool)
        keep[start[some]] = False
        length = stop - start
        length[some] -= 1
        offsets = np.concatenate([[0], np.cumsum(length)])
        text = pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(data[keep])).cast(pa.string())
        if odd.any():
            text = pc.replace_with_mask(text, pa.array(odd), pa.array([self.decode(ids[at[i]:at[i + 1]].tolist()) for i in np.flatnonzero(odd)], pa.string()))
        return text

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode(self, ids, plain: bool = False) -> str:
        """Text of ``ids`` (``plain``: without control ids): the marker that encoding put in front goes, bytes that form no
        character become U+FFFD one by one."""
        surface = self.surface
        if plain or self.silent.isdisjoint(ids):
            runs = [ids]
        else:  # a control id is silent and ends a run of byte pieces
            runs = [list(run) for silent, run in itertools.groupby(ids, self.silent.__contains__) if not silent]
        text = "".join([b"".join([surface[i] for i in run]).decode("utf-8", "one-by-one") for run in runs])
        if text[:1] == " " and runs and runs[0][0] not in (self.unknown, self.byte_id.get(32)):
            text = text[1:]
        return text


def _one_by_one(e: UnicodeDecodeError):
    return "�", e.start + 1


@functools.lru_cache(2)
def load(path: str) -> PieceModel:
    import codecs

    codecs.register_error("one-by-one", _one_by_one)
    return PieceModel(path)


def encode_column(text: Column, path: str) -> Column:
    """Ids (array of int) of a text column under the model file ``path``."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        model = load(path)
        hold("pieces", model.forget)
        ids, n = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for a, b in slices(column):
            for out, more in zip((ids, n), model.encode_texts(column.slice(a, b - a))):
                out.append(more)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(n))])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(ids).view("<i4")))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """Text of an array-of-int column; null ids give the empty text."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        model = load(path)
        column = column.fill_null([])
        flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy().astype(np.int64)
        out, a = [], 0
        while a < len(column):  # about two million ids at a time
            b = max(a + 1, int(np.searchsorted(at, at[a] + 2_000_000, "right")) - 1)
            out.append(model.decode_rows(flat[at[a]:at[b]], at[a:b + 1] - at[a]))
            a = b
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return decode(ids)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as column ``out``."""
    return df.withColumn(out, encode_column(F.col(text), path))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of ``ids`` as column ``out``."""
    return df.withColumn(out, decode_column(F.col(ids), path))
