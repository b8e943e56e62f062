"""Spark jobs against brute-force Python on small fixtures (no SQL oracle for these)."""

import functools
import re

from pyspark.sql import functions as F

from tessera.operators import lexicon, matching, quality
from tessera.plans import bindings as B
from tessera.session import table

from conftest import SF_SMALL


def lev(a, b):
    """Edit distance straight from its recursive definition."""
    @functools.cache
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
    return d(len(a), len(b))


def test_j4_fuzzy_blocking_equals_brute_force(spark):
    lk = lexicon.build_lookup(B.lexicon(spark, SF_SMALL))
    keys = sorted((r.pos, r.key) for r in lk.collect())
    d = table(spark, SF_SMALL, "documents").filter(F.col("doc_id") < 25)  # small brute-force fixture
    words = matching.tokenise(d, "text", [], lower=True).select(F.col("token").alias("low")).distinct()
    words = words.join(lk.select(F.col("key").alias("low")), "low", "left_anti")
    got = {r.low: (r.fuzzy_key, r.edit_distance) for r in matching.match_fuzzy(words, lk).collect()}
    expected = {}
    for (w,) in words.collect():
        if len(w) < 3:
            continue
        best = None
        for pos, k in keys:
            if abs(len(k) - len(w)) > 2:
                continue
            dist = lev(w, k)
            if dist <= 2 and (best is None or dist < best[1]):
                best = (k, dist)
        if best:
            expected[w] = best
    assert got == expected


def wer_words(t):
    t = re.sub(r"\s\s+", " ", t).strip()
    return [w for w in t.split(" ") if len(w) >= 1]


def test_a7_wer_equals_word_dp(spark):
    pairs = B.text_pairs(spark, SF_SMALL)
    got = {r.pair_id: (r.edits, r.ref_words) for r in quality.pair_errors(pairs).collect()}
    edits = refs = 0
    for r in pairs.collect():
        if not r.reference.strip():
            continue
        ref, hyp = wer_words(r.reference), wer_words(r.hypothesis)
        assert got[r.pair_id] == (lev(ref, hyp), len(ref))
        edits += lev(ref, hyp)
        refs += len(ref)
    total = quality.word_error_rate(pairs).first()
    assert total.wer == round(edits / refs, 4)


def test_a7_wer_empty_corpus(spark):
    empty = spark.createDataFrame([], "pair_id BIGINT, reference STRING, hypothesis STRING")
    assert quality.word_error_rate(empty).first().wer == 1.0


def test_m22_live_wer_by_user(spark):
    pairs = B.text_pairs(spark, SF_SMALL)
    got = {r.user_id: r.wer for r in quality.word_error_rate(pairs, by=["user_id"]).collect()}
    per = {}
    for r in pairs.collect():
        if not r.reference.strip():
            continue
        ref, hyp = wer_words(r.reference), wer_words(r.hypothesis)
        e, n = per.get(r.user_id, (0, 0))
        per[r.user_id] = (e + lev(ref, hyp), n + len(ref))
    assert got == {u: round(e / n, 4) for u, (e, n) in per.items()}
