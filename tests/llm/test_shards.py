"""Token shards and the wavelet matrix against the tokenizer, plain arrays and sorted lists."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries, shards, wavelet
from tests.llm.conftest import ROWS

from conftest import SF_SMALL

PATH = P.path("byte_bpe_50k.json")
ALPHABETS = [list("aeinstrth \n"), list("aab "), list("  \t.x"), [chr(c) for c in range(1, 300)],
             list("日本語のあア中 ▁é́\U0001F600aа\x85\xa0  "), ["the", " ", "of", "ing", "<|endoftext|>", "'s", " 12", "!?", ", ", ". "],
             ["Größe ", "été, ", "word.\n", "it's ", "x:y; ", "A\n\nB ", "a1b ", "end.\n"]]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_op12_wavelet_matrix_equals_arrays(n):
    x = np.random.RandomState(n).randint(0, 300, n).astype(np.uint16)
    m = wavelet.WaveletMatrix.of(x, 9)
    assert (m.values(np.uint16) == x).all() and (m.access(np.arange(n)) == x).all()
    for c in range(0, 301, 13):
        where = np.flatnonzero(x == c)
        assert (m.rank(c, np.arange(n + 1)) == np.concatenate([[0], np.cumsum(x == c)])).all()
        assert (m.select(c, np.arange(len(where))) == where).all()
    assert (m.rank(1 << 9, [n]) == 0).all()


def texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABETS[i % len(ALPHABETS)], k=rnd.randint(0, 30))) for i in range(n)]


@pytest.mark.parametrize("memo", [0, 50, 600_000])
def test_op12_encodes_as_the_library(tokenizer, memo):
    encoder = shards.Encoder(PATH, memo)
    every = [*texts(8000, 1), None, "", " ", "a" * 20_000, " " * 5000, "word, " * 5000]
    for k in range(0, len(every), 1500):
        part = every[k:k + 1500]
        ids, n = encoder.encode(pa.array(part, pa.string()))
        ends = np.cumsum(n)
        for t, a, b in zip(part, ends - n, ends):
            assert ids[a:b].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t
    assert len(encoder.memo.words) <= memo


def test_op12_file_is_read_in_part(tmp):
    n = 1_000_000
    x = np.random.RandomState(1).zipf(1.3, n).clip(max=50_000).astype(np.uint32)
    starts = np.arange(0, n, 1000)
    path = f"file://{tmp}/x.twm"
    with open(f"{tmp}/x.twm", "wb") as f:
        f.write(shards.dump(x, pa.array(starts), starts, 50_257))
    whole = shards.Shard(path)
    assert (whole.tokens() == x).all() and whole.documents.column("doc_id").to_pylist() == starts.tolist()
    few = shards.Shard(path)
    assert few.matrix.access([5, 999_999]).tolist() == [x[5], x[999_999]]
    assert few.fetched < whole.fetched  # two places touch some of the blocks only
    for t in (1, 7, 40_000, 50_256):
        assert (shards.Shard(path).find(t) == np.flatnonzero(x == t)).all()
        assert shards.Shard(path).matrix.rank(t, [10, n // 2, n]).tolist() == [(x[:k] == t).sum() for k in (10, n // 2, n)]
    with open(f"{tmp}/bad.twm", "wb") as f:
        f.write(b"0" * 100)
    with pytest.raises(ValueError):
        shards.Shard(f"file://{tmp}/bad.twm")


def expected(tokenizer, rows):
    """Ids by row in ascending order of ids, nulls first."""
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def test_op12_odd_rows_many_shards(spark, odd, none, tmp, tokenizer):
    got = shards.read(shards.write(odd, PATH, folder=f"file://{tmp}/odd", tokens=50)).orderBy("start").collect()
    want = expected(tokenizer, [r[:2] for r in ROWS])
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == sorted(
        (d is not None, d or 0, np.array(i, "<u4").tobytes()) for d, i in want)
    assert [r.doc_id for r in got] == [d for d, _ in want]
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert shards.write(none, PATH, folder=f"file://{tmp}/none").count() == 0
    assert shards.read(shards.write(none, PATH, folder=f"file://{tmp}/none2")).count() == 0


def test_op12_queries_of_the_store(spark, tmp, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    written = shards.write(docs, PATH, folder=f"{tmp}/store", tokens=5_000)
    assert written.count() > 8
    want = expected(tokenizer, [(r.doc_id, r.text) for r in docs.collect()])
    flat = np.concatenate([i for _, i in want])
    owner = np.repeat([d for d, _ in want], [len(i) for _, i in want])
    offset = np.concatenate([np.arange(len(i)) for _, i in want])
    asked = [0, 11, 262, int(flat[5]), 50_000]
    assert {r.token: r.n for r in shards.count(written, asked).collect()} == {t: int((flat == t).sum()) for t in asked}
    found = sorted(map(tuple, shards.find(written, asked).select("token", "place", "doc_id", "at").collect()))
    assert found == sorted((t, int(p), int(owner[p]), int(offset[p])) for t in set(asked) for p in np.flatnonzero(flat == t))
    rnd = np.random.RandomState(2)
    places = [0, len(flat) - 1, len(flat), -1, None, *rnd.randint(0, len(flat), 300).tolist()]
    got = shards.access(written, spark.createDataFrame([(p,) for p in places], "place long")).collect()
    assert sorted(map(tuple, got)) == sorted({(p, int(flat[p])) for p in places if p is not None and 0 <= p < len(flat)})


def test_op12_left_over_files_do_not_count(spark, tmp, tokenizer):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    written = shards.write(docs, PATH, folder=f"{tmp}/twice")
    with open(f"{tmp}/twice/000000-000000-999999.twm", "wb") as f:  # of a task that was lost
        f.write(b"half a file")
    again = shards.manifest_of(spark, f"file://{tmp}/twice")
    assert [r.doc_id for r in shards.read(again).orderBy("start").collect()] == [1, 2] and written.count() == again.count()


def test_op12_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_shards(spark, SF_SMALL).collect()}
    at, want = 0, {}
    for d, ids in expected(tokenizer, [(r.doc_id, r.text) for r in docs.collect()]):
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
