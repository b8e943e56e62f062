"""Token ids of a corpus in binary shards, each one wavelet matrix in one compressed file.

Documents are put in ascending order by range partitioning, and each task tokenises its
range and writes shards of about ``TOKENS`` ids.  A shard is opened by its last bytes: the
footer names, for every block of every bit-plane, its place in the file and its ones, so that
token access, counting and occurrence lookup fetch only the blocks they touch::

    magic | compressed blocks of the planes, highest bit first | document table | footer | trailer
    document table   Arrow stream of one batch: doc_id (any type), start (ids of the shard before it)
    footer           compressed JSON: n, planes, zeros, block, ones and places of the blocks, table
    trailer          place and size of the footer (unsigned 64-bit little-endian), magic

Files carry the number of the attempt that wrote them, and only those that the manifest names
count: what a lost task leaves behind is never read.  Folders of any file system that
``pyarrow.fs`` opens by its address will do.

Null text counts as empty: it has only the closing id.  Rows with a null id come first, rows
that repeat an id follow one another in the order of their texts' hashes.  A document longer
than a shard has one of its own.  An empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import functools
import io
import json
import os
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hold, n_tasks
from tessera.llm.wavelet import BLOCK, Plane, WaveletMatrix, build, count_ones
from tessera.plans.scale import running_sum
from tessera.session import ensure_checkpoint_dir

CLOSE = 0
#: Ids of a shard, about, and bytes of text in the range of one task.
TOKENS = 4_000_000
RANGE_BYTES = 64 << 20
MAGIC = b"TWMX0001"
#: Bytes of text that are tokenised at a time.
SLICE = 8 << 20
#: A space before white space or the end of the text: there words don't part at each space.
_HARD = r" ([\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"
#: Latin letters, digits, marks but the apostrophe, and single newlines: parts of these alone fall
#: into pieces wherever the class of the letters changes, and before and after a newline.
_LATIN = r"^{0}+(\n{0}+)*$".format(r"[\x21-\x26\x28-\x7e\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]")
_NONE, _LETTER, _DIGIT, _MARK, _LINE = range(5)
_CLASS = np.full(256, _LETTER, np.uint8)
_CLASS[:128] = [_LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _LINE if b == 10 else _NONE if b in (0, 32) else _MARK for b in range(128)]


def byte_letters() -> np.ndarray:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, the
    others from 256 on.  Byte 0 stays: it parts pieces here."""
    plain = np.zeros(256, bool)
    for a, b in ((33, 127), (161, 173), (174, 256)):
        plain[a:b] = True
    letters = np.where(plain, np.arange(256), 255 + np.cumsum(~plain))
    letters[0] = 0
    return letters.astype("<u4")


def lists(ids: np.ndarray, ends: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), pa.array(ids))


class Memo:
    """Ids of the parts met last, ``most`` of them, kept as columns: a batch of distinct parts is
    looked up in one step, and ``learn`` gives the words and ids of those that aren't there."""

    def __init__(self, learn, most: int):
        self.learn, self.most = learn, most
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = lists(np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def look_up(self, words: pa.Array) -> pa.LargeListArray:
        at = pc.index_in(words, self.words)
        new = words.filter(at.is_null())
        if not len(new):
            return self.ids.take(at)
        learnt, ids = self.learn(new)
        every, every_ids = pa.concat_arrays([self.words, learnt]), pa.concat_arrays([self.ids, ids])
        at = pc.index_in(words, every)
        # what this batch used comes last, so that the parts met longest ago go first
        used = np.zeros(len(every), bool)
        used[at.to_numpy()] = True
        order = np.concatenate([np.flatnonzero(~used), np.flatnonzero(used)])
        kept = pa.array(order[max(len(order) - self.most, 0):])
        self.words, self.ids = every.take(kept), every_ids.take(kept)
        return every_ids.take(at)


class Encoder:
    """Ids of texts as the tokenizer gives them.

    The tokenizer never joins across a single space before a letter or mark, which starts a
    piece of its own.  So texts are split there column-wise, the distinct parts of a slice get
    their ids from a memo or the tokenizer, and the
    ids of all texts are gathered in one step.  Texts where spaces stand otherwise go to the
    tokenizer one by one."""

    def __init__(self, path: str, memo: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: The same vocabulary over pieces that are parted already and written in its letters.
        self.parted = Tokenizer.from_file(path)
        self.parted.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        self.letters = byte_letters()
        self.parted.model._resize_cache(0)  # what it is asked is new
        names = self.tokenizer.get_vocab()
        self.n_ids = max(names.values()) + 1
        space = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(" ")[0][0]
        self.starts = np.zeros(self.n_ids, bool)  # ids that begin with a space
        self.starts[[i for w, i in names.items() if w.startswith(space)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(self._learn, memo)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text in which spaces stand before white space, too."""
        if any(s in text for s in self.special):
            return self._plain(text)
        return np.concatenate([self._plain(p) for p in re.split(r"(?= \S)", text)])

    def _ask(self, tokenizer, text: str, parts: pa.Array) -> pa.LargeListArray:
        """Ids of parts that the tokenizer was given in one call, told apart by their spaces."""
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(self.starts[ids])
        if len(at) == len(parts):
            return lists(ids, np.append(at[1:], len(ids)))
        single = [self._plain(" " + p) for p in parts.to_pylist()]
        return lists(np.concatenate(single), np.cumsum([len(x) for x in single]))

    def _parted(self, parts: pa.Array) -> str:
        """Parts of ``_LATIN`` with a space before each, in pieces: ``\0 word\0,\0 next``."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(parts)], parts), "\0 ")[0].as_buffer()
        data = np.concatenate([np.frombuffer(b"\0 ", np.uint8), np.frombuffer(joined, np.uint8)])
        kind = _CLASS[data]
        new = np.zeros(len(data), bool)
        new[1:] = (kind[1:] != _NONE) & (kind[:-1] != _NONE) & ((kind[1:] != kind[:-1]) | (kind[1:] == _LINE))
        at = np.arange(len(data)) + np.cumsum(new)
        out = np.zeros(at[-1] + 1, "<u4")
        out[at] = self.letters[data]
        return out.tobytes().decode("utf-32-le")

    def _learn(self, parts: pa.Array) -> tuple[pa.Array, pa.LargeListArray]:
        """The ids of new parts, each with the space before it."""
        latin = pc.match_substring_regex(parts, _LATIN)
        plain, rest = parts.filter(latin), parts.filter(pc.invert(latin))
        words, ids = [], []
        for a in range(0, len(plain), 50_000):
            words.append(plain.slice(a, 50_000))
            ids.append(self._ask(self.parted, self._parted(words[-1]), words[-1]))
        for a in range(0, len(rest), 50_000):
            words.append(rest.slice(a, 50_000))
            ids.append(self._ask(self.tokenizer, " " + " ".join(words[-1].to_pylist()), words[-1]))
        return pa.concat_arrays(words), pa.concat_arrays(ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one text after another, and how many each has."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = texts.cast(pa.string()).fill_null("")
        hard = pc.match_substring_regex(texts, _HARD)
        for s in self.special:
            hard = pc.or_(hard, pc.match_substring(texts, s))
        whole = {int(i): self._whole(texts[int(i)].as_py()) for i in np.flatnonzero(hard.to_numpy(zero_copy_only=False))}
        if whole:
            texts = pc.if_else(hard, "", texts)
        parts = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        parts = parts.flatten()
        # the first part of a text has no space before it: an entry of its own
        heads = [whole[i] if i in whole else self._plain(h) for i, h in enumerate(parts.take(pa.array(first)).to_pylist())]
        later = np.ones(len(parts), bool)
        later[first] = False
        coded = parts.filter(pa.array(later)).dictionary_encode()
        n = len(coded.dictionary)
        codes = np.empty(len(parts), np.int64)
        codes[later] = coded.indices.to_numpy(zero_copy_only=False)
        codes[first] = n + np.arange(len(heads))
        entries = lists(np.concatenate(heads), np.cumsum([len(h) for h in heads]))
        if n:
            entries = pa.concat_arrays([self.memo.look_up(coded.dictionary), entries])
        sizes = pc.list_value_length(entries).to_numpy(zero_copy_only=False)
        return entries.take(pa.array(codes)).flatten().to_numpy(), np.add.reduceat(sizes[codes], first)


@functools.lru_cache(2)
def load(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: pa.Array, most: int = SLICE):
    """Ranges of rows of about so many bytes, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most, "right")))
        yield a, b
        a = b


def dump(ids: np.ndarray, doc_ids: pa.Array, starts: np.ndarray, n_ids: int) -> bytes:
    """The file of one shard."""
    narrow = np.uint16 if n_ids <= 1 << 16 else np.uint32
    n_planes = max(1, int(n_ids - 1).bit_length())
    planes, zeros = build(ids.astype(narrow), n_planes)
    press = zstandard.ZstdCompressor(level=1).compress
    out = io.BytesIO()
    out.write(MAGIC)

    def put(raw: bytes) -> list[int]:
        at = out.tell()
        return [at, out.write(raw)]

    ones, places = [], []
    for words in planes:
        blocks = [words[a:a + BLOCK // 64] for a in range(0, max(len(words), 1), BLOCK // 64)]
        ones.append([count_ones(b) for b in blocks])
        places.append([put(press(b.tobytes())) for b in blocks])
    table = pa.RecordBatch.from_arrays([doc_ids, pa.array(starts, pa.int64())], ["doc_id", "start"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(table)
    documents = put(sink.getvalue().to_pybytes())
    footer = put(press(json.dumps({"n": len(ids), "n_ids": n_ids, "zeros": zeros, "block": BLOCK, "ones": ones, "places": places,
                                   "documents": documents}).encode()))
    out.write(struct.pack("<QQ", *footer) + MAGIC)
    return out.getvalue()


class Shard:
    """A shard's file, opened by its footer: blocks are fetched when they are asked for."""

    def __init__(self, path: str):
        fs, name = pyarrow.fs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        at, n, magic = struct.unpack("<QQ8s", self.file.read_at(24, size - 24))
        if magic != MAGIC:
            raise ValueError(f"not a shard of tokens: {path}")
        self.fetched = 0
        self.footer = json.loads(self._block((at, n)))
        self.n, self.n_ids = self.footer["n"], self.footer["n_ids"]
        planes = [Plane(self.n, ones, lambda b, places=places: np.frombuffer(self._block(places[b]), "<u8"), self.footer["block"])
                  for ones, places in zip(self.footer["ones"], self.footer["places"])]
        self.matrix = WaveletMatrix(self.n, planes, self.footer["zeros"])

    def _block(self, place) -> bytes:
        self.fetched += 1
        return zstandard.decompress(self.file.read_at(place[1], place[0]))

    def close(self) -> None:
        self.file.close()

    @functools.cached_property
    def documents(self) -> pa.RecordBatch:
        at, n = self.footer["documents"]
        return pa.ipc.open_stream(self.file.read_at(n, at)).read_next_batch()

    @functools.cached_property
    def starts(self) -> np.ndarray:
        return self.documents.column("start").to_numpy()

    def tokens(self) -> np.ndarray:
        return self.matrix.values(np.uint16 if self.n_ids <= 1 << 16 else np.uint32)

    def find(self, token: int) -> np.ndarray:
        """All places of an id, ascending."""
        n = int(self.matrix.rank(token, [self.n])[0])
        return self.matrix.select(token, np.arange(n)) if n else np.zeros(0, np.int64)


def _put(folder: str, name: str, raw: bytes) -> str:
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{name}") as out:
        out.write(raw)
    return f"{folder}/{name}"


def write(df: DataFrame, path: str, folder: str | None = None, close: int = CLOSE, tokens: int = TOKENS,
          range_bytes: int = RANGE_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise ``text`` and write the shards below ``folder`` (an address such as
    ``file:///shared/tokens``; by default one in ``spark.checkpoint.dir``).  Returns the manifest,
    which lies there too: ``part``, ``shard``, ``path``, ``n_docs``, ``n_tokens`` and ``base``
    (ids in the shards before)."""
    spark = df.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(n_tasks(df), -(-size // range_bytes))
    ordered = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))

    def shards(source):
        encoder = load(path)
        hold("shards", encoder.memo.forget)
        task = TaskContext.get()
        part, n = task.partitionId(), 0
        keys, counts, ids = [], [], []

        def flush():
            nonlocal n
            lengths = np.concatenate(counts)
            every = np.concatenate(ids)
            ends = np.cumsum(lengths)
            raw = dump(every, pa.concat_arrays(keys), ends - lengths, encoder.n_ids)
            where = _put(folder, f"{part:06d}-{n:06d}-{task.taskAttemptId()}.twm", raw)
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": n, "path": where, "n_docs": len(lengths), "n_tokens": len(every)}], _MANIFEST)
            n += 1
            for kept in (keys, counts, ids):
                kept.clear()
            return row

        held = 0
        for batch in source:
            texts = batch.column(1)
            for a, b in slices(texts, min(SLICE, 4 * tokens)):
                flat, lengths = encoder.encode(texts.slice(a, b - a))
                closed = lengths + 1
                ends = np.cumsum(closed) - 1
                out = np.full(int(closed.sum()), close, np.uint32)
                inside = np.ones(len(out), bool)
                inside[ends] = False
                out[inside] = flat
                keys.append(batch.column(0).slice(a, b - a))
                counts.append(closed)
                ids.append(out)
                held += len(out)
                if held >= tokens:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    manifest = ordered.mapInArrow(shards, "part int, shard int, path string, n_docs long, n_tokens long")
    manifest.write.parquet(f"{folder}/manifest")
    return manifest_of(spark, folder)


_MANIFEST = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def manifest_of(spark, folder: str) -> DataFrame:
    """The shards of a folder with ``base``, the ids in the shards before each."""
    rows = spark.read.schema("part int, shard int, path string, n_docs long, n_tokens long").parquet(f"{folder}/manifest")
    summed = running_sum(rows, "n_tokens", ["part", "shard"], name="upto")
    return summed.withColumn("base", F.col("upto") - F.col("n_tokens")).drop("upto")


def _dealt(shards: DataFrame) -> DataFrame:
    """One shard is a lot of work for so small a row: deal them out."""
    return shards.select("part", "shard", "path", "base").repartition(n_tasks(shards), "path")


def read(shards: DataFrame, id_type: str = "long") -> DataFrame:
    """Every document from the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit, the closing id included)."""

    def rows(source):
        for batch in source:
            for r in batch.to_pylist():
                shard = Shard(r["path"])
                starts, doc_ids = shard.starts, shard.documents.column("doc_id")
                wide = shard.tokens().astype("<u4")
                ends = np.append(starts[1:], shard.n)
                shard.close()
                for a, b in _row_slices(ends, starts):
                    raw = wide[starts[a]:ends[b - 1]]
                    offsets = np.append(starts[a:b], ends[b - 1]) - starts[a]
                    binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(4 * offsets), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(a, b - a), pa.array(starts[a:b] + r["base"]), pa.array(ends[a:b] - starts[a:b]), binary.cast(pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return _dealt(shards).mapInArrow(rows, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def _row_slices(ends: np.ndarray, starts: np.ndarray, most: int = 2_000_000):
    """Ranges of documents of about so many ids, one at least."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + most, "right")))
        yield a, b
        a = b


def count(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """How often each of the given ids occurs: ranks at the ends of the shards, no id is decoded.
    ``token``, ``n``; ids that never occur have 0."""
    wanted = sorted(set(tokens))

    def ranks(source):
        for batch in source:
            for r in batch.to_pylist():
                shard = Shard(r["path"])
                found = [int(shard.matrix.rank(t, [shard.n])[0]) for t in wanted]
                shard.close()
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(found, pa.int64())], ["token", "n"])

    spark = shards.sparkSession
    every = spark.createDataFrame([(t,) for t in wanted], "token long")
    found = _dealt(shards).mapInArrow(ranks, "token long, n long")
    return (every.withColumn("n", F.lit(0).cast("long")).unionByName(found).groupBy("token").agg(F.sum("n").alias("n")))


def find(shards: DataFrame, tokens: list[int], id_type: str = "long") -> DataFrame:
    """Every place of the given ids by select: ``token``, ``place`` (among all ids), ``doc_id`` and
    ``at`` (place in the document)."""
    wanted = sorted(set(tokens))

    def selects(source):
        for batch in source:
            for r in batch.to_pylist():
                shard = Shard(r["path"])
                for t in wanted:
                    places = shard.find(t)
                    for a in range(0, len(places), 1 << 20):
                        at = places[a:a + (1 << 20)]
                        doc = np.searchsorted(shard.starts, at, "right") - 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), t)), pa.array(at + r["base"]), shard.documents.column("doc_id").take(pa.array(doc)),
                             pa.array(at - shard.starts[doc])], ["token", "place", "doc_id", "at"])
                shard.close()

    return _dealt(shards).mapInArrow(selects, f"token long, place long, doc_id {id_type}, at long")


def access(shards: DataFrame, places: DataFrame, place: str = "place") -> DataFrame:
    """The ids at the given places: ``place``, ``token``.  Each shard gets its own places, by a
    join on stretches of ids; places outside the corpus give no row."""
    step = TOKENS
    last = F.col("base") + F.col("n_tokens") - 1
    spans = shards.where("n_tokens > 0").select("part", "shard", "path", "base", "n_tokens", F.explode(F.sequence(F.floor(F.col("base") / step), F.floor(last / step))).alias("stretch"))
    asked = places.select(F.col(place).cast("long").alias("place")).where("place is not null").distinct().withColumn("stretch", F.floor(F.col("place") / step))
    hits = (asked.join(spans, "stretch").where((F.col("place") >= F.col("base")) & (F.col("place") < F.col("base") + F.col("n_tokens")))
            .select("path", "base", "place").repartition(n_tasks(shards), "path", F.floor(F.col("place") / (step // 16)))
            .sortWithinPartitions("path", "place"))

    def look(source):
        shard, opened = None, None
        for batch in source:
            paths, base, at = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(paths[1:].to_numpy(zero_copy_only=False) != paths[:-1].to_numpy(zero_copy_only=False)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if paths[a].as_py() != opened:
                        if shard:
                            shard.close()
                        opened = paths[a].as_py()
                        shard = Shard(opened)
                    yield pa.RecordBatch.from_arrays([pa.array(at[a:b]), pa.array(shard.matrix.access(at[a:b] - base[a:b]))], ["place", "token"])
        if shard:
            shard.close()

    return hits.mapInArrow(look, "place long, token long")
