"""Bucket-split helpers equal the plain (single-task) window functions."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import corpus, drift, profile, quality
from tessera.operators.profile import distribution_stats
from tessera.plans.scale import bucket_of, exact_quantiles, global_row_number, neighbour, rolling_means, rolling_rows, running_sum, with_range_bucket


def _data(spark, n=3000, keys=3):
    rnd = random.Random(7)
    rows = [(i, rnd.randrange(keys), rnd.random() * 1000, rnd.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, "id BIGINT, k INT, t DOUBLE, v INT")


def test_global_row_number(spark):
    df = _data(spark)
    got = global_row_number(df, ["t", "id"], ["k"], n_buckets=16)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.select("id", "rn").exceptAll(ref.select("id", "rn")).count() == 0


def test_running_sum(spark):
    df = _data(spark)
    got = running_sum(df, "v", ["t", "id"], ["k"], name="rs", n_buckets=16)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("rs", F.sum("v").over(w))
    assert got.select("id", "rs").exceptAll(ref.select("id", "rs")).count() == 0


def test_neighbour_lag_lead(spark):
    df = _data(spark)
    for direction, fn in ((-1, F.lag), (1, F.lead)):
        got = neighbour(df, ["k"], ["t", "id"], ["v"], direction, prefix="n_", n_buckets=16)
        ref = df.withColumn("n_v", fn("v", 1).over(Window.partitionBy("k").orderBy("t", "id")))
        assert got.select("id", "n_v").exceptAll(ref.select("id", "n_v")).count() == 0


def test_rolling_rows(spark):
    df = _data(spark)
    got = rolling_rows(df, ["k"], ["t", "id"], 7, {"m": F.sum("v")}, chunk_rows=50)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-6, 0)
    ref = df.withColumn("m", F.sum("v").over(w))
    assert got.select("id", "m").exceptAll(ref.select("id", "m")).count() == 0
    assert got.count() == df.count()


def test_null_keys_are_a_partition(spark):
    df = _data(spark, keys=4).withColumn("k", F.nullif("k", F.lit(0))).cache()
    n = df.count()
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("id", F.row_number().over(w).alias("rn"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                      F.lag("v", 1).over(w).alias("n_v"), F.sum("v").over(w.rowsBetween(-6, 0)).alias("m"))
    for got, col in ((global_row_number(df, ["t", "id"], ["k"], n_buckets=16), "rn"),
                     (running_sum(df, "v", ["t", "id"], ["k"], name="rs", n_buckets=16), "rs"),
                     (neighbour(df, ["k"], ["t", "id"], ["v"], -1, prefix="n_", n_buckets=16), "n_v"),
                     (rolling_rows(df, ["k"], ["t", "id"], 7, {"m": F.sum("v")}, chunk_rows=50), "m")):
        assert got.count() == n
        assert got.select("id", col).exceptAll(plain.select("id", col)).count() == 0


def test_buckets_fit_each_partition(spark):
    """A column of narrow range spreads over as many buckets as one of wide range."""
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id") / 1e6).otherwise(F.col("id") * 1e6).alias("t"))
    used = with_range_bucket(df, "t", 32, partition_cols=["k"]).groupBy("k").agg(F.countDistinct("_bucket").alias("n"))
    assert all(r.n >= 28 for r in used.collect())


def test_c12_a11_null_keys(spark):
    items = spark.range(60).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("s"))
    split = corpus.stratified_split(items, "id", "s")
    assert split.count() == 60 and split.where("s is null and split = 'train'").count() == 16
    pts = spark.createDataFrame([(None, 0.0, 1.0), (None, 2.0, 3.0), ("a", 0.0, 0.0)], "k STRING, t DOUBLE, v DOUBLE")
    assert profile.resample_linear(pts, ["k"], "t", "v", 1.0).where("k is null").count() == 3


def test_m22_bleu_of_the_null_group(spark):
    text = "the cat sat on the mat today"
    pairs = spark.createDataFrame([(1, None, text, text), (2, "a", text, "the cat sat on a mat")],
                                  "pair_id BIGINT, g STRING, reference STRING, hypothesis STRING")
    got = {r.g: r.bleu for r in quality.corpus_bleu(pairs, by=["g"]).collect()}
    assert got[None] == 1.0 and 0 < got["a"] < 1


def test_d2_nulls_are_no_values(spark):
    rows = [(i % 2, float(i // 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "s INT, x DOUBLE")
    df = df.unionByName(spark.createDataFrame([(1, None)] * 100 + [(1, float("nan"))] * 10, "s INT, x DOUBLE"))
    long = drift.long_values(df, ["x"], F.when(F.col("s") == 0, "reference").otherwise("current"))
    r = drift.column_drift(long).first()
    assert (r.n_ref, r.n_cur, r.ks_stat, r.psi, r.drifted) == (200, 200, 0.0, 0.0, False)


def test_rolling_means(spark):
    rng = np.random.RandomState(8)
    rows = [(None if k == 3 else int(k), int(t), i, None if rng.rand() < 0.2 else float(rng.rand() < 0.4))
            for i, (k, t) in enumerate(zip(rng.randint(0, 4, 600), rng.randint(0, 300, 600)))]
    df = spark.createDataFrame(rows, "k int, t int, id int, v double")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-6, 0)
    want = {r.id: r.m for r in df.withColumn("m", F.avg("v").over(w)).collect()}
    got = {r.id: r.m for r in rolling_means(df, ["k"], ["t", "id"], 7, {"m": "v"}, chunk_rows=50).collect()}
    assert got.keys() == want.keys()
    assert all((got[i] is None) == (want[i] is None) and (want[i] is None or abs(got[i] - want[i]) < 1e-12) for i in want)


def test_exact_quantiles_by_selection(spark):
    """Hot values, nulls, tiny groups and a null group; a third of all rows in one group."""
    rng = np.random.RandomState(9)
    groups = {"hot": np.r_[np.full(3000, 7.0), rng.normal(size=2000)], "even": rng.randint(0, 50, 999).astype(float), "one": np.array([3.5]),
              "two": np.array([1.0, 2.0]), None: rng.exponential(size=501), "none": np.zeros(0)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", qs, ["g"])
    found = {r.g: [r[f"q{i}"] for i in range(len(qs))] for r in got.collect()}
    assert found.keys() == groups.keys() - {"none"}
    for g, xs in groups.items():
        if len(xs):
            assert np.allclose(found[g], np.quantile(xs, qs), rtol=1e-12, atol=1e-12), g
    every = np.concatenate(list(groups.values()))
    assert np.allclose(list(exact_quantiles(df, "x", qs).first()), np.quantile(every, qs), rtol=1e-12)
    assert "percentile(" not in got._jdf.queryExecution().toString()
    assert exact_quantiles(df.where("g = 'none'"), "x", qs).count() == 0


def test_distribution_of_nothing_is_zeros(spark):
    none = spark.createDataFrame([("a", None)], "g string, x double")
    assert distribution_stats(none, "x").first()[:] == (0.0,) * 6 + (0,)
    assert distribution_stats(none.where("false"), "x").first()[:] == (0.0,) * 6 + (0,)
    assert distribution_stats(none, "x", ["g"]).first()[:] == ("a",) + (0.0,) * 6 + (0,)


def test_running_sum_bounds_each_partition(spark):
    """A key of narrow range beside one of wide range: both are spread over buckets."""
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") / 1e6).alias("t"), F.lit(1).alias("v"))
    got = running_sum(df, "v", ["t"], ["k"], name="s")
    want = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("t")))
    assert sorted(map(tuple, got.select("k", "t", "s").collect())) == sorted(map(tuple, want.select("k", "t", "s").collect()))
    buckets = with_range_bucket(df, "t", 8, partition_cols=["k"]).groupBy("k").agg(F.countDistinct("_bucket")).collect()
    assert all(n >= 7 for _, n in buckets)


@pytest.mark.parametrize("n", [2, 3, 8, 9, 32])
def test_bucket_is_the_number_of_bounds_below(spark, n):
    """By bisection, not by a look at every bound: nulls, ties, NaN and infinities included."""
    xs = [None, float("nan"), float("inf"), float("-inf"), *[float(i % 37) for i in range(300)]]
    for bounds in ([float(i) for i in range(n - 1)], [1.0][:n - 1], [], None, [-1e300] + [40.0] * (n > 2)):
        df = spark.createDataFrame([(x, bounds) for x in xs], "x double, b array<double>")
        plain = F.coalesce(F.size(F.filter("b", lambda b: b < F.col("x"))), F.lit(0))
        out = bucket_of(df, F.col("x"), "b", n)
        assert out.where(~F.col("_bucket").eqNullSafe(F.greatest(plain, F.lit(0)))).count() == 0
    assert "lambda" not in with_range_bucket(df.select("x"), "x", n)._jdf.queryExecution().toString()


def test_column_drift_against_numpy(spark):
    """Values that repeat, one-sided and empty columns, a third side; the input is read once."""
    rnd = np.random.default_rng(5)
    rows = [(c, s, float(v)) for c, shift, digits in (("a", 0.0, 1), ("b", 0.7, 9)) for s, n, d in (("reference", 400, 0.0), ("current", 300, shift), ("other", 20, 9.0))
            for v in np.round(rnd.normal(d, 1, n), digits)]
    rows += [("r", "reference", 1.0), ("r", "reference", 2.0), ("c", "current", 1.0), ("o", "other", 1.0)]
    long = spark.createDataFrame(rows, "column string, side string, value double").repartition(5)
    df = drift.column_drift(long)
    got = {r["column"]: r for r in df.collect()}
    assert sorted(got) == ["a", "b", "c", "o", "r"]
    plan = df._jdf.queryExecution().toString()
    assert "LogicalRDD" not in plan and "Scan ExistingRDD" not in plan and "LocalTableScan" not in plan
    for c in "ab":
        ref, cur = (np.sort([v for k, s, v in rows if k == c and s == side]) for side in ("reference", "current"))
        at = np.unique(np.concatenate([ref, cur]))
        diff = np.abs(np.searchsorted(ref, at, "right") / len(ref) - np.searchsorted(cur, at, "right") / len(cur))
        edges = np.quantile(ref, np.arange(1, 10) / 10)
        pr, pc = (np.bincount(np.searchsorted(edges, x, "left"), minlength=10) / len(x) for x in (ref, cur))
        used = (pr > 0) | (pc > 0)
        pr, pc = np.maximum(pr, 1e-4)[used], np.maximum(pc, 1e-4)[used]
        r = got[c]
        assert (r.n_ref, r.n_cur) == (400, 300) and r.drifted == (c == "b")
        assert r.ks_stat == pytest.approx(diff.max()) and r.psi == pytest.approx(((pc - pr) * np.log(pc / pr)).sum())
        assert r.wasserstein_norm == pytest.approx((np.diff(at) * diff[:-1]).sum() / ref.std())
    assert (got["r"].n_ref, got["r"].n_cur, got["r"].ks_stat, got["r"].drifted) == (2, 0, None, False)
    assert (got["c"].n_ref, got["c"].psi, got["o"].n_ref, got["o"].n_cur) == (0, 0.0, 0, 0)
