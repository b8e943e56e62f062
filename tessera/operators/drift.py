"""Drift detection.

Column drift works on a long table ``(column, side, value)``: values are
pre-aggregated per (column, value) and written once, cumulative distributions
come from running sums inside buckets of values (a column with billions of rows
is not one task), and the per-column results are small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import round_fp
from tessera.llm.common import materialise
from tessera.operators.profile import distribution_stats, oov_rate, vector_moments
from tessera.plans.scale import bucket_of, default_buckets, range_bounds

OOV_DRIFT_THRESHOLD = 0.15
KS_ALPHA = 0.05
DATASET_DRIFT_SHARE = 0.5
PSI_BINS = 10
PSI_FLOOR = 0.0001
KS_TERMS = 100


def oov_drift(tokens: DataFrame, lex: DataFrame, side_col: str = "side", baseline: str = "baseline",
              live: str = "live", threshold: float = OOV_DRIFT_THRESHOLD) -> DataFrame:
    """One row — baseline and live OOV rates, drift iff live > baseline·(1+thr)."""
    r = oov_rate(tokens, lex, by=[side_col])
    agg = r.agg(F.max(F.when(F.col(side_col) == baseline, F.col("oov_rate"))).alias("baseline_oov"),
                F.max(F.when(F.col(side_col) == live, F.col("oov_rate"))).alias("live_oov"))
    b = F.coalesce(F.col("baseline_oov"), F.lit(0.0))
    return agg.select(b.alias("baseline_oov"), F.coalesce("live_oov", F.lit(0.0)).alias("live_oov"),
                      (F.coalesce("live_oov", F.lit(0.0)) > b * (1 + threshold)).alias("oov_drift"))


def long_values(df: DataFrame, cols: Sequence[str], side: Column) -> DataFrame:
    """Wide numeric columns → ``(column, side, value)``; nulls and NaN are no values."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return _values(df.select(side.alias("side"), F.explode(arr).alias("x")).select("x.column", "side", "x.value"))


def _values(long: DataFrame) -> DataFrame:
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def vector_long(df: DataFrame, vec_col: str, side: Column) -> DataFrame:
    """Vector column → ``(column = dim index, side, value)``."""
    return _values(df.select(side.alias("side"), F.posexplode(vec_col).alias("dim", "value"))
                   .select(F.col("dim").cast("string").alias("column"), "side", F.col("value").cast("double").alias("value")))


def _ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    en = F.sqrt(F.try_divide(n * m, n + m))
    lam = (en + 0.12 + F.try_divide(F.lit(0.11), en)) * d
    terms = F.transform(F.sequence(F.lit(1), F.lit(KS_TERMS)),
                        lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    q = 2.0 * F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return (F.when(lam.isNull(), F.lit(None).cast("double")).when(lam < 1e-3, 1.0)
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))))


def column_drift(long: DataFrame, ref: str = "reference", cur: str = "current",
                 alpha: float = KS_ALPHA, bins: int = PSI_BINS) -> DataFrame:
    """Per column — two-sample KS statistic and asymptotic p-value,
    Wasserstein distance normalised by the reference std, PSI on reference
    deciles; ``drifted`` when p < alpha."""
    is_ref = (F.col("side") == ref).cast("long")
    is_cur = (F.col("side") == cur).cast("long")
    # everything else comes from this table of distinct values, written once and read four times; the mean
    # first, so that the spread is summed round it
    per_val = materialise(long.groupBy("column", "value").agg(F.sum(is_ref).alias("nr"), F.sum(is_cur).alias("nc")))
    n_buckets = default_buckets(per_val)
    sums = materialise(per_val.groupBy("column").agg(
        F.sum("nr").alias("n_ref"), F.sum("nc").alias("n_cur"), F.try_divide(F.sum(F.col("nr") * F.col("value")), F.sum("nr")).alias("_mean"),
        range_bounds(F.col("value"), n_buckets).alias("_bounds")))
    c = bucket_of(per_val.join(sums, "column"), F.col("value"), "_bounds", n_buckets).drop("_bounds")
    # what a bucket needs of the others: counts before it and the first value after it
    off = F.col("value") - F.col("_mean")
    buckets = c.groupBy("column", "_bucket").agg(F.sum("nr").alias("_nr"), F.sum("nc").alias("_nc"), F.min("value").alias("_first"),
                                                 F.sum(F.col("nr") * off * off).alias("_sq"))
    order = Window.partitionBy("column").orderBy("_bucket")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("column", "_bucket", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in ("nr", "nc")],
                             F.lead("_first").over(order).alias("_after"), F.sum("_sq").over(Window.partitionBy("column")).alias("_sq"))
    inside = Window.partitionBy("column", "_bucket").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    c = c.drop("_mean").join(buckets, ["column", "_bucket"]).select(
        "column", "n_ref", "n_cur", "value", F.sqrt(F.try_divide("_sq", "n_ref")).alias("ref_std"),
        (F.col("_before_nr") + F.sum("nr").over(upto)).alias("cr"), (F.col("_before_nc") + F.sum("nc").over(upto)).alias("cc"),
        F.coalesce(F.lead("value").over(inside), "_after").alias("next_value"))
    # an empty side yields nulls (no test), never a division error
    diff = F.try_divide(F.col("cr"), F.col("n_ref")) - F.try_divide(F.col("cc"), F.col("n_cur"))
    seg = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0)) * F.abs(diff)
    # PSI on reference deciles: linear-interpolated percentiles read off the running counts
    at = [F.lit(i / bins) * (F.col("n_ref") - 1) for i in range(1, bins)]

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("cr") > rank, F.col("value")))

    edge = [value_at(F.floor(r)) + (F.max(r - F.floor(r))) * (value_at(F.ceil(r)) - value_at(F.floor(r))) for r in at]
    stats = materialise(c.groupBy("column", "n_ref", "n_cur", "ref_std").agg(
        F.max(F.abs(diff)).alias("ks_stat"), F.sum(seg).alias("w1"), F.array(*edge).alias("edges")))
    below = [F.coalesce((F.get("edges", F.lit(i)) < F.col("value")).cast("int"), F.lit(0)) for i in range(bins - 1)]
    lb = per_val.join(stats.where("n_ref > 0").select("column", "n_ref", "n_cur", "edges"), "column").withColumn("bin", sum(below, F.lit(0)))
    hist = lb.groupBy("column", "bin", "n_ref", "n_cur").agg(F.sum("nr").alias("br"), F.sum("nc").alias("bc"))
    pr = F.greatest(F.try_divide(F.col("br"), F.col("n_ref")), F.lit(PSI_FLOOR))
    pc = F.greatest(F.try_divide(F.col("bc"), F.col("n_cur")), F.lit(PSI_FLOOR))
    psi = hist.groupBy("column").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi"))
    out = stats.join(psi, "column", "left")
    p = _ks_pvalue(F.col("ks_stat"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return out.select(
        "column", F.col("n_ref").cast("bigint").alias("n_ref"), F.col("n_cur").cast("bigint").alias("n_cur"),
        "ks_stat", p.alias("ks_pvalue"),
        F.when(F.col("ref_std") > 0, F.col("w1") / F.col("ref_std")).otherwise(F.col("w1")).alias("wasserstein_norm"),
        F.coalesce("psi", F.lit(0.0)).alias("psi"), F.coalesce(p < alpha, F.lit(False)).alias("drifted"))


def dataset_drift(col_drift: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """D3: number and share of drifted columns; dataset drift when share ≥ ``share``."""
    agg = col_drift.agg(F.count(F.lit(1)).cast("bigint").alias("n_columns"),
                        F.count_if("drifted").cast("bigint").alias("n_drifted"))
    s = F.when(F.col("n_columns") > 0, F.col("n_drifted") / F.col("n_columns")).otherwise(0.0)
    return agg.select("n_columns", "n_drifted", s.alias("drift_share"), (s >= share).alias("dataset_drift"))


def oov_drift_against(tokens: DataFrame, lex: DataFrame, baseline_oov: float | None,
                      threshold: float = OOV_DRIFT_THRESHOLD) -> DataFrame:
    """D1 against a stored baseline rate (None: there is none): the columns of ``oov_drift`` for live tokens."""
    live = oov_rate(tokens, lex).select(F.coalesce("oov_rate", F.lit(0.0)).alias("live_oov"))
    b = F.lit(baseline_oov).cast("double")
    return live.select(F.coalesce(b, F.lit(0.0)).alias("baseline_oov"), "live_oov",
                       F.coalesce(F.col("live_oov") > b * (1 + threshold), F.lit(False)).alias("oov_drift"))


def _one_row(df: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.lit(1))


def drift_report(oov: DataFrame, dataset: DataFrame, n_requests: DataFrame | None = None,
                 n_baseline: DataFrame | None = None, at: DataFrame | None = None) -> DataFrame:
    """verdict = OOV drift or dataset drift, with reason codes: ``no_baselines`` when ``n_baseline`` (one
    row) is 0, else ``no_requests`` when ``n_requests`` is, else ``insufficient_data`` when no column could
    be tested.  Without a baseline or requests there is no drift.  ``at`` (one row ``checked_at``) is the
    report's time."""
    r = _one_row(oov).join(_one_row(dataset), "_k", "left")
    for name, rows in (("n_requests", n_requests), ("n_baseline", n_baseline)):
        if rows is not None:
            r = r.join(_one_row(rows.select(name)), "_k", "left")
        else:
            r = r.withColumn(name, F.lit(None).cast("bigint"))
    none = (F.col("n_baseline") == 0) | (F.col("n_requests") == 0)
    reason = (F.when(F.col("n_baseline") == 0, "no_baselines").when(F.col("n_requests") == 0, "no_requests")
              .when(F.coalesce(F.col("n_columns"), F.lit(0)) == 0, "insufficient_data"))
    verdict = F.when(none, F.lit(False)).otherwise(F.col("oov_drift") | F.coalesce(F.col("dataset_drift"), F.lit(False)))
    time = []
    if at is not None:
        r, time = r.join(_one_row(at.select("checked_at")), "_k", "left"), ["checked_at"]
    return r.select(verdict.alias("drift_detected"), "baseline_oov", "live_oov", (F.col("oov_drift") & ~F.coalesce(none, F.lit(False))).alias("oov_drift"),
                    "n_drifted", "drift_share", "dataset_drift", reason.alias("reason"), *time)


def baseline_snapshot(val_tokens: DataFrame, lex: DataFrame, durations: DataFrame, duration_col: str,
                      vectors: DataFrame, vec_col: str) -> DataFrame:
    """OOV (rounded 4), duration distribution and vector moments as one row."""
    o = oov_rate(val_tokens, lex, round_to=4).withColumn("_k", F.lit(1))
    d = distribution_stats(durations, duration_col).withColumn("_k", F.lit(1))
    vm = vector_moments(vectors, vec_col)
    v = vm.agg(F.array_sort(F.collect_list(F.struct("dim", "mean", "std"))).alias("_m"),
               F.max("count").alias("vector_count")).withColumn("_k", F.lit(1))
    row = o.join(d, "_k").join(v, "_k")
    return row.select(
        "oov_rate", "total_tokens", "oov_tokens", "vocab_size",
        F.col("mean").alias("duration_mean"), F.col("std").alias("duration_std"),
        F.col("p25").alias("duration_p25"), F.col("p75").alias("duration_p75"),
        F.col("min").alias("duration_min"), F.col("max").alias("duration_max"),
        F.col("count").alias("duration_count"),
        F.transform("_m", lambda x: round_fp(x["mean"], 6)).alias("vector_mean"),
        F.transform("_m", lambda x: round_fp(x["std"], 6)).alias("vector_std"),
        F.coalesce("vector_count", F.lit(0)).cast("bigint").alias("vector_count"))
