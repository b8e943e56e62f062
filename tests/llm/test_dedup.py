"""SimHash, repeated passages, neighbours and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import graph, neighbours, queries, simhash, substrings
from tessera.llm.common import table
from tests.llm.conftest import ROWS

from conftest import SF_SMALL


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def plain_print(t):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=3):
    """Smallest index reachable over links of at most ``radius`` bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    x = np.array(prints, np.uint64)
    for a in range(len(x)):
        for b in np.flatnonzero(np.bitwise_count(x ^ x[a]) <= radius).tolist():
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return [find(a) for a in range(len(x))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_op7_query(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())
    prints = [plain_print(t) for _, t in docs]
    want = {i: (f"{p:016x}", docs[c][0]) for (i, _), p, c in zip(docs, prints, plain_components(prints))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash_near_dedup(spark, SF_SMALL).collect()}
    assert got == want and any(c != i for i, (_, c) in got.items())


def test_op7_links_in_dense_and_crowded_keys(spark):
    rnd = random.Random(1)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    prints = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(120)} | {0, 1, (1 << 64) - 1})
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    comp = plain_components(prints)
    for segments, block in ((2, 4096), (2, 20), (3, 4096), (4, 8)):
        found = {r.node: r.root for r in graph.components(simhash.links(df, 3, segments, block)).collect()}
        groups = {}
        for p, c in zip(prints, comp):
            groups.setdefault(c, set()).add(found.get(signed(p), signed(p)))
        assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups), (segments, block)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000 + i, 1000) for i in range(200)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(200)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_op7_odd_rows(spark, odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert by[1] == [(signed(plain_print(ROWS[0][1])), 1)] * 2
    assert by[2] == by[3] == by[4] == [(0, 2)] and (0, 2) in by[None]  # texts without a word
    kept = simhash.representatives(odd).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 2, 5, 6, 7] and sum(r.doc_id is None for r in kept) == 1
    assert all(r.fp == "keep" for r in kept)
    assert simhash.near_duplicates(none).count() == 0 and simhash.representatives(none).count() == 0


def plain_kept(docs, n=13):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone[k:k + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def removed(r):
    return sum(s["end"] - s["start"] for s in r.removed)


def test_op5_random_texts(spark):
    rnd = random.Random(4)
    passages = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(8, 40))) for _ in range(12)]
    docs = []
    for i in range(300):
        parts = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(0, 20))) if rnd.random() < 0.5 else rnd.choice(passages) for _ in range(rnd.randint(0, 6))]
        docs.append((rnd.choice([i, i, 7, None]), rnd.choice(["  ", "\n", " ", "\t\r\n"]).join(parts)))
    docs += [(1000, "ab " * 3000), (1001, "ab " * 50), (1002, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for chunk in (1 << 20, 4000):  # one chunk, and many
        got = substrings.remove_repeats(df, chunk=chunk).collect()
        assert sorted(map(repr, ((r.doc_id, r.n_words, removed(r), r.kept) for r in got))) == sorted(map(repr, plain_kept(docs)))


def test_op5_odd_rows(spark, odd, none):
    got = substrings.remove_repeats(odd).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_words, removed(r), r.kept) for r in got))) == sorted(map(repr, plain_kept([(r[0], r[1]) for r in ROWS])))
    assert all(r.fp == "keep" for r in got)
    assert substrings.remove_repeats(none).count() == 0


def test_op5_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    want = {i: (n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in plain_kept(docs)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op5_substring_dedup(spark, SF_SMALL).collect()}
    assert got == want and any(m for _, m, _ in got.values())


def plain_search(rows, asked, k):
    out = {}
    for q in asked:
        found = [(float(np.dot(v, dict(rows)[q])), i) for i, v in rows if i != q]
        out[q] = sorted(found, key=lambda x: (-round(x[0], 12), x[1]))[:k]
    return out


def test_op4_query_recall(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table(spark, SF_SMALL, "embeddings").collect()]
    want = plain_search(rows, [i for i, _ in rows if i % 20 == 0], 20)
    vectors, got = dict(rows), {}
    for r in queries.op4_nearest_neighbours(spark, SF_SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert got.keys() == want.keys()
    recall = [len({r.vec_id for r in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want]
    assert np.mean(recall) >= 0.9
    for q, found in got.items():
        assert [r.rank for r in found] == list(range(1, 21))
        assert all(abs(r.score - vectors[q] @ vectors[r.vec_id]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)


def test_op4_odd_vectors_and_blocks(spark):
    rnd = np.random.RandomState(3)
    base = [(i, rnd.normal(size=8).astype(float).round(3).tolist()) for i in range(200)]
    base += [(200 + i, [3.0] * 8) for i in range(90)]  # copies
    odd = [(500, None), (520, [0.0] * 8), (540, [float("nan")] + [1.0] * 7), (560, [1.0] * 5), (580, [None] + [1.0] * 7), (None, [1.0] * 8),
           (600, [float("inf")] + [1.0] * 7), (0, base[0][1])]
    df = spark.createDataFrame(base + odd, "vec_id long, embedding array<double>").withColumn("key", F.lit("x"))
    want = plain_search([(i, np.array(v)) for i, v in base], [i for i, _ in base if i % 20 == 0], 5)
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, k=5, leaf=20, block=16, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got.keys() == want.keys()
    for q in want:
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]])
    assert [i for _, i in got[200]] == [201, 202, 203, 204, 205]  # ties to the smaller id
    assert neighbours.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (0, 2)]


def test_op4_ties_between_different_vectors(spark):
    """60 different vectors with equal products to the query: the smaller ids are found."""
    rows = [(0, [1.0, 0.0, 0.0])] + [(i, [0.5, float(i), float(-i)]) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (8, 4096):
        got = neighbours.search(df, F.col("vec_id") == 0, k=5, leaf=100, block=block, recall=1.0).orderBy("rank").collect()
        assert [(r.vec_id, r.score) for r in got] == [(i, 0.5) for i in range(1, 6)]
    rnd = np.random.RandomState(9)  # quantised vectors: many equal products
    rows = [(i, rnd.randint(-1, 2, 6).astype(float).tolist()) for i in range(300)]
    want = plain_search([(i, np.array(v)) for i, v in rows if any(v)], [i for i, v in rows if i % 20 == 0 and any(v)], 7)
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, df.schema), F.col("vec_id") % 20 == 0, k=7, leaf=400, block=32, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == want


def test_pipeline_stages_by_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "substring_dedup", "pii", "best_fit_packing"]
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF_SMALL).cache())
        assert steps[-1].columns == docs.columns and steps[-1].schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = [sorted((r.doc_id, r.text) for r in s.collect()) for s in steps]
    assert set(rows[1]) <= set(rows[0]) and len(rows[1]) >= 0.97 * len(rows[0])
    comp = plain_components([plain_print(t) for _, t in rows[1]])
    assert rows[2] == [r for k, r in enumerate(rows[1]) if comp[k] == k]
    want = [(i, t if not m else k) for (i, t), (_, _, m, k) in zip(rows[2], plain_kept(rows[2])) if k or not m]
    assert rows[3] == want
    from tessera.llm import pii
    assert rows[4] == [(i, pii.hide(t)) for i, t in rows[3]] and not any(pii.emails(t).__next__() for _, t in rows[4] if list(pii.emails(t)))
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())
    from tests.llm.test_tokens import check_packed, order, plain_pieces
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert order([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed]) == order(plain_pieces(rows[4]))
    check_packed(packed)


def test_pipeline_odd_rows(spark, odd, none):
    for df in (odd, none, odd.where("text is null")):
        docs = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "").cache()
            assert docs.columns == df.columns, name
            docs.count()
        n = corpus_pipeline.STAGES[-1][1](spark, docs, "").count()
        assert n >= docs.count()
