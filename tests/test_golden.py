"""Golden rows from the reference behaviour (FIXTURES F1–F7)."""

import json
import os

from pyspark.sql import functions as F

from tessera.functions.text import (
    canonical_form, clean_gloss, clean_source, looks_like_source, primary_gloss, quoted_target,
)
from tessera.operators import corpus, drift, lexicon, matching, metrics, profile
from tessera.sources import io


def _lex(spark, rows):
    return spark.createDataFrame(rows, "seq BIGINT, term STRING, gloss STRING, term_type STRING")


def test_f1_s1_l1_normalise_lexicon(spark, tmp):
    # one row for each shape an entry may have; the rows are our own
    entries = [
        {"na'vi": "ayram", "en": "mountains", "type": "n"},
        {"en": "no headword", "type": "n"},
        {"na'vi": "pay", "type": "n"},
        {"na'vi": "swok", "en": ["sacred", "holy place"], "type": "adj"},
        {"na'vi": "tok", "en": {"en": "be at", "de": "sein"}, "type": "vtr"},
        {"na'vi": "awnga", "translations": [{"en": "we"}, {"en": " us "}, {"de": "wir"}]},
        {"navi": "sempu", "translations": {"en": "daddy"}, "type": "n"},
        {"na'vi": "   ", "navi": "skipped", "en": "blank first key wins"},
    ]
    path = os.path.join(tmp, "words.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(entries, f, ensure_ascii=False)
    out = lexicon.normalise_lexicon(io.read_lexicon(spark, path)).orderBy("seq").collect()
    got = [(r.term, r.gloss, r.term_type) for r in out]
    assert got == [("ayram", "mountains", "n"), ("swok", "sacred; holy place", "adj"), ("tok", "be at", "vtr"),
                   ("awnga", "we; us", "unknown"), ("sempu", "daddy", "n")]


def test_s1_order_over_several_files(spark, tmp):
    for name, terms in (("b.json", ["p", "q", "r"]), ("a.json", ["x", "y"])):
        with open(os.path.join(tmp, name), "w", encoding="utf-8") as f:
            json.dump([{"na'vi": t, "en": t, "type": "n"} for t in terms], f)
    out = io.read_lexicon(spark, os.path.join(tmp, "*.json")).orderBy("seq").collect()
    assert [(r["na'vi"], r.seq) for r in out] == [("x", 0), ("y", 1), ("p", 2), ("q", 3), ("r", 4)]


def test_s2_keyed_lexicon(spark, tmp):
    doc = {"movur": {"en": "lamp", "type": "noun"},
           "teni": [{"en": "light"}, {"na'vi": "teni-b", "en": "to kindle"}, False],
           "sal": ["neither", 7]}
    path = os.path.join(tmp, "keyed.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False)
    out = lexicon.normalise_lexicon(io.read_keyed_lexicon(spark, path)).collect()
    assert sorted((r.term, r.gloss) for r in out) == [("movur", "lamp"), ("teni", "light"), ("teni-b", "to kindle")]


def test_f2_l7_lookup_exact_first_wins(spark):
    lex = _lex(spark, [(4, "Swok", "sacred", "adj"), (7, "swok", "holy", "adj"), (9, "pay", "water", "n")])
    words = spark.createDataFrame([("swok",), ("SWOK ",), ("Pay",), ("nowhere",)], "word STRING")
    got = {r.word: r.match_gloss for r in lexicon.lookup_exact(words, lex).collect()}
    assert got == {"swok": "sacred", "SWOK ": "sacred", "Pay": "water", "nowhere": None}


def test_f3_c1_word_pairs(spark):
    lex = _lex(spark, [(1, "kilvan", "river; stream", "n"), (2, "hol", "", "adj"), (3, "txon", "night", "n")])
    got = [(r.src, r.tgt) for r in corpus.word_pairs(lex).orderBy("seq").collect()]
    assert got == [("kilvan", "river"), ("txon", "night")]


def test_f4_c4_dedupe_pairs(spark):
    rows = [(5, "txon", "night"), (2, "Txon", "Night"), (9, "txon", "nights"), (7, "kilvan", "river"), (8, "kilvan", "river")]
    df = spark.createDataFrame(rows, "seq BIGINT, src STRING, tgt STRING")
    got = sorted((r.seq, r.src, r.tgt) for r in corpus.dedupe_pairs(df).collect())
    assert got == [(2, "Txon", "Night"), (7, "kilvan", "river"), (9, "txon", "nights")]


def test_f5_j1_j8_a1_d1_oov_rate_and_drift(spark):
    lex = _lex(spark, [(i, t, "g", "x") for i, t in enumerate(["txon", "pay", "kilvan", "hol"])])

    def tokens(texts, side):
        req = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id BIGINT, text STRING")
        return matching.tokenise(req, "text", ["id"], lower=True).withColumn("side", F.lit(side))

    def rate(texts):
        rows = profile.oov_rate(tokens(texts, "x"), lex).collect()
        return rows[0].oov_rate if rows and rows[0].oov_rate is not None else 0.0

    assert rate(["Txon pay", "kilvan"]) == 0.0
    assert rate(["blub", "glub glub"]) == 1.0
    assert abs(rate(["txon pay hol blub", "kilvan kilvan glub pay"]) - 2 / 8) < 1e-9
    # live 2 of 8 against a baseline of 1 of 5: 0.25 > 0.2 * 1.15, but not > 0.2 * 1.5
    both = tokens(["txon pay hol kilvan blub"], "baseline").unionByName(tokens(["txon pay hol blub", "kilvan kilvan glub pay"], "live"))
    assert drift.oov_drift(both, lex).first().oov_drift
    assert not drift.oov_drift(both, lex, threshold=0.5).first().oov_drift


def test_f6_l14_validate_requests(spark):
    """Own rows on and just beyond each limit."""
    rows = [(10, "t", 0.0), (11, "word " * 100, 1.0), (12, "word " * 100 + "s", 0.25), (13, "", -0.01), (14, "four words are here", 1.001)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, confidence DOUBLE")
    got = sorted((r.id, r.reason) for r in lexicon.validate_requests(df, "id").collect())
    assert got == [(12, "text_too_long"), (13, "confidence_out_of_range"), (13, "text_empty"), (14, "confidence_out_of_range")]


def test_f7_l4_l11_l12_c9_c10_expressions(spark):
    df = spark.createDataFrame([("mo/[vu]r", "lamp (of clay)  ;", "[q]", "'Light the lamp!'", "12. Movur teni sal")],
                               "a STRING, b STRING, c STRING, d STRING, e STRING")
    r = df.select(canonical_form(F.col("a")).alias("a"), clean_gloss(F.col("b")).alias("b"),
                  clean_gloss(F.col("c")).alias("c"), quoted_target(F.col("d")).alias("d"),
                  clean_source(F.col("e")).alias("e"), primary_gloss(F.lit("wick; cord")).alias("p")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.p) == ("movur", "lamp", "(no translation)", "Light the lamp!",
                                             "Movur teni sal", "wick")
    r2 = spark.createDataFrame([("[ /te'ni] ",)], "a STRING").select(canonical_form(F.col("a"))).first()[0]
    assert r2 == "te'ni"


def test_f7_l6_j4_fuzzy_ties_and_short_tokens(spark):
    lookup = lexicon.build_lookup(_lex(spark, [(0, "abcd", "first", "x"), (1, "abce", "second", "x")]))
    words = spark.createDataFrame([("abcf",), ("ab",)], "low STRING")
    got = {r.low: (r.fuzzy_key, r.edit_distance) for r in matching.match_fuzzy(words, lookup).collect()}
    assert got == {"abcf": ("abcd", 1)}


def test_f7_j3_suffix_list_order(spark):
    lookup = lexicon.build_lookup(_lex(spark, [(0, "ta", "from", "x"), (1, "tar", "other", "x")]))
    words = spark.createDataFrame([("tari",)], "low STRING")
    got = matching.match_suffix(words, lookup, suffixes=["ri", "i"]).first()
    assert got.stem == "ta"


def test_f7_j2_j5_j6_j7_translate_confidence(spark):
    lex = _lex(spark, [(0, "movur", "lamp; lantern", "noun")])
    req = spark.createDataFrame([(1, "movur zzzz"), (2, "qqq")], "request_id BIGINT, text STRING")
    lk = lexicon.build_lookup(lex)
    out = {r.request_id: r for r in matching.translate_requests(req, matching.gloss_tokens(req, lk)).collect()}
    assert out[1].confidence == 0.725 and out[1].english == "lamp [zzzz]"
    assert out[2].confidence == 0.0 and out[2].english == "qqq"


def test_f7_c12_c13_split_sizes(spark):
    rows, i = [], 0
    for stratum, n in (("a", 1), ("b", 2), ("c", 3), ("d", 10)):
        for _ in range(n):
            rows.append((i, stratum))
            i += 1
    df = spark.createDataFrame(rows, "id BIGINT, s STRING")
    out = corpus.stratified_split(df, "id", "s").groupBy("s").pivot("split", ["train", "val", "test"]).count()
    got = {r.s: tuple(r[c] or 0 for c in ("train", "val", "test")) for r in out.collect()}
    assert got == {"a": (1, 0, 0), "b": (1, 0, 1), "c": (2, 1, 0), "d": (8, 1, 1)}


def test_f7_c6_c7_c8_adjacent_pairs(spark):
    html = "<p>Oe lu 'eylan.</p><p></p><p></p><p>'I see you.'</p><p>Kaltxì ma frapo.</p><p></p><p></p><p></p><p>'Hello all.'</p>"
    pages = spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING")
    got = [(r.src, r.tgt) for r in corpus.adjacent_line_pairs(pages).collect()]
    assert got == [("Oe lu 'eylan.", "I see you.")]
    assert looks_like_source is not None


def test_f7_m7_m8_rolling_rate(spark):
    rows = [(i, i, i == 0) for i in range(101)]
    df = spark.createDataFrame(rows, "event_id BIGINT, ts BIGINT, missed BOOLEAN")
    out = {r.event_id: r.rate for r in metrics.rolling_rate(df, F.col("missed"), [], ["ts", "event_id"]).collect()}
    assert abs(out[99] - 0.01) < 1e-12 and out[100] == 0.0


def test_f7_m2_m3_bucket_quantile(spark):
    df = spark.createDataFrame([(75.0,)] * 10, "v DOUBLE")
    r = df.agg(F.array(*[F.count_if(F.col("v") <= b) for b in metrics.LATENCY_BUCKETS_MS]).alias("c"),
               F.count("v").alias("t")).select(
        metrics.bucket_quantile(0.5, F.col("c"), F.col("t"), metrics.LATENCY_BUCKETS_MS)).first()[0]
    assert r == 75.0
