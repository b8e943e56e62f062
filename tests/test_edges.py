"""Edge rows: empty inputs, zero denominators, overflow buckets, empty requests."""

from pyspark.sql import functions as F

from tessera.operators import drift, lexicon, matching, metrics, profile, quality


def test_a1_oov_rate_no_tokens(spark):
    lex = spark.createDataFrame([(1, "a", "g", "x")], "seq BIGINT, term STRING, gloss STRING, term_type STRING")
    toks = spark.createDataFrame([], "token STRING")
    assert profile.oov_rate(toks, lex).collect() == [] or profile.oov_rate(toks, lex).first().oov_rate == 0.0


def test_d2_d3_column_drift_with_empty_side(spark):
    long = spark.createDataFrame([("c", "reference", float(i)) for i in range(10)], "column STRING, side STRING, value DOUBLE")
    r = drift.column_drift(long).first()
    assert r.n_cur == 0 and r.drifted is False
    assert drift.dataset_drift(drift.column_drift(long)).first().dataset_drift is False


def test_m3_quantile_overflow_bucket(spark):
    df = spark.createDataFrame([(20000.0,)] * 5, "v DOUBLE")
    r = df.agg(F.array(*[F.count_if(F.col("v") <= b) for b in metrics.LATENCY_BUCKETS_MS]).alias("c"),
               F.count("v").alias("t")).select(
        metrics.bucket_quantile(0.95, F.col("c"), F.col("t"), metrics.LATENCY_BUCKETS_MS)).first()[0]
    assert r == 10000.0


def test_j6_empty_request_text(spark):
    lex = spark.createDataFrame([(0, "movur", "lamp", "noun")], "seq BIGINT, term STRING, gloss STRING, term_type STRING")
    req = spark.createDataFrame([(1, ""), (2, "   ")], "request_id BIGINT, text STRING")
    lk = lexicon.build_lookup(lex)
    out = {r.request_id: r for r in matching.translate_requests(req, matching.gloss_tokens(req, lk)).collect()}
    assert out[1].english == "(no translation)" and out[1].confidence == 0.0 and out[1].n_tokens == 0
    assert out[2].n_tokens == 0


def test_a11_resample_single_sample(spark):
    df = spark.createDataFrame([("k", 10.0, 3.5)], "k STRING, t DOUBLE, v DOUBLE")
    rows = profile.resample_linear(df, ["k"], "t", "v", 5.0).collect()
    assert [(r.step_index, r.value) for r in rows] == [(0, 3.5)]


def test_a9_beam_confidence(spark):
    from tessera.operators.quality import beam_confidence
    r = spark.range(1).select(beam_confidence(F.lit(0.0)).alias("c"), beam_confidence(F.lit(50.0)).alias("h")).first()
    assert r.c == 0.5 and r.h == 1.0


def test_d2_wide_columns(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 3), "reference" if i < 50 else "current") for i in range(100)],
                               "id BIGINT, x DOUBLE, y DOUBLE, side STRING")
    out = {r.column: r for r in drift.column_drift(drift.long_values(df, ["x", "y"], F.col("side"))).collect()}
    assert out["x"].ks_stat == 1.0 and out["x"].drifted
    assert out["y"].ks_stat < 0.1 and not out["y"].drifted


def test_a5_a9_empty_inputs(spark):
    v = spark.createDataFrame([(1, None), (2, [])], "id int, v array<double>")
    assert [tuple(r) for r in profile.vector_moments(v, "v", dims=13).orderBy("dim").collect()] == [(d, 0.0, 0.0, 0) for d in range(13)]
    steps = spark.createDataFrame([(1, [0.0, 0.0]), (1, []), (2, None)], "s int, logits array<double>")
    got = quality.sequence_confidence(steps, ["s"], "logits", sequences=spark.createDataFrame([(1,), (2,), (None,)], "s int"))
    assert sorted((r.s or 0, r.confidence, r.steps) for r in got.collect()) == [(0, 0.5, 0), (1, 0.5, 1), (2, 0.5, 0)]
    assert quality.sequence_confidence(steps.where("false"), [], "logits").first()[:] == (0.5, 0)


def test_a7_a8_odd_pairs(spark):
    rows = [("a b c", "a x c"), (None, "a"), (" \t ", "b"), ("a b", None), ("a", ""), ("é 中 \U0001F600", "中 é \U0001F600")]
    pairs = spark.createDataFrame(rows, "reference string, hypothesis string").withColumns({c: F.lit(1) for c in ("w", "i", "x", "_g", "runs")})
    got = quality.pair_errors(pairs).select("reference", "edits", "ref_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a b c", 1, 3), ("a b", None, 2), ("a", 1, 1), ("é 中 \U0001F600", 2, 3)], key=str)
    none = quality.word_error_rate(pairs.where("false")).first()
    assert (none.wer, none.pairs) == (1.0, 0)
    stats = quality.pair_bleu(pairs.where("hypothesis = 'a x c'")).first()
    assert [stats[f"correct{n}"] for n in quality.ORDERS] == [2, 0, 0, 0] and [stats[f"total{n}"] for n in quality.ORDERS] == [3, 2, 1, 0]


def test_a11_m13_long_gaps(spark):
    """Samples half a century apart are stretches of grid points, not one array."""
    import datetime as dt

    pts = spark.createDataFrame([("k", 0.0, 0.0), ("k", 1.6e9, 1600.0), ("j", 5.0, 1.0)], "k string, t double, v double")
    got = profile.resample_linear(pts, ["k"], "t", "v", 1000.0).groupBy("k").agg(F.count("*").alias("n"), F.max("value").alias("m"), F.countDistinct("step_index").alias("d"))
    assert {r.k: (r.n, r.m, r.d) for r in got.collect()} == {"k": (1_600_001, 1600.0, 1_600_001), "j": (1, 1.0, 1)}
    log = spark.createDataFrame([(dt.datetime(1990, 1, 1), 1), (dt.datetime(2000, 1, 1), 2)], "ts timestamp_ntz, user_id long")
    windows = metrics.active_users(log, "1 hour").agg(F.count("*"), F.sum("active_users"), F.countDistinct("window_start")).first()
    assert tuple(windows) == (87_649, 2, 87_649)


def test_j9_blank_texts(spark, tmp):
    """A text without a token is no error: its tier is `rare`, as the oracle has it."""
    import duckdb
    from tessera.plans.catalog import load_all

    texts = ["cat sat", "  mat x", "\n\tcat", "Cat", "zz cat", "cat\u3000", "", " ", " \t\r\n ", None]
    want = ["common", "common", "common", "rare", "rare", "common", "rare", "rare", "rare", "rare"]
    lex = spark.createDataFrame([(1, "cat", "rare"), (2, "cat", "common"), (3, "mat", "common"), (4, "", "common")], "seq long, term string, tier string")
    rows = [*zip(range(len(texts)), texts, strict=True), (10, "\u3000"), (11, "\xa0\u2003mat")]
    got = matching.attach_tier(spark.createDataFrame(rows, "doc_id long, text string"), lex)
    assert {r.doc_id: r.tier for r in got.collect()} == dict(enumerate([*want, "rare", "common"]))
    # the oracle knows ASCII whitespace only
    spark.createDataFrame([r for r in rows if not r[1] or r[1].isascii()], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(1, "the cat sat"), (2, "on a mat")], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    q = load_all()["j9_attach_tier"]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp}/{t}.parquet/*.parquet')")
    got = sorted((r.doc_id, r.tier) for r in q.fn(spark, tmp).collect())
    assert got == sorted(con.execute(q.sql).fetchall()) == [(i, t) for i, t in enumerate(want) if i != 5]
