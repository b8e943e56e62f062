"""Baselines and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import round_fp

from tessera.plans.scale import exact_quantiles, join_null_safe, neighbour, stretches


def oov_rate(tokens: DataFrame, lex: DataFrame, by: Sequence[str] = (), token_col: str = "token",
             round_to: int | None = None) -> DataFrame:
    """A1: share of tokens that are not ``lower(term)`` of any entry.

    Tokens are first counted per (group, token) — a map-side partial
    aggregate that collapses hot tokens — and only those counts meet the
    vocabulary in the join.  Output: ``by…, total_tokens, oov_tokens,
    oov_rate, vocab_size``; a group with no tokens has rate 0.
    """
    by = list(by)
    counts = tokens.groupBy(*by, token_col).agg(F.count(F.lit(1)).alias("_n"))
    vocab = lex.select(F.lower("term").alias(token_col)).distinct().withColumn("_in", F.lit(1))
    j = counts.join(vocab, token_col, "left")
    agg = j.groupBy(*by).agg(F.sum("_n").cast("bigint").alias("total_tokens"),
                             F.sum(F.when(F.col("_in").isNull(), F.col("_n")).otherwise(0))
                             .cast("bigint").alias("oov_tokens"))
    rate = F.when(F.col("total_tokens") > 0, F.col("oov_tokens") / F.col("total_tokens")).otherwise(0.0)
    if round_to is not None:
        rate = round_fp(rate, round_to)
    vocab_size = lex.select(F.countDistinct(F.lower("term"))).scalar()
    return agg.select(*by, "total_tokens", "oov_tokens", rate.alias("oov_rate"),
                      vocab_size.cast("bigint").alias("vocab_size"))


def distribution_stats(df: DataFrame, col: str, by: Sequence[str] = (), digits: int = 3,
                       exact: bool = True) -> DataFrame:
    """A2: mean, population std, p25/p75 (linear interpolation), min, max, count; zeros where a group
    (or the whole) has no value.

    The percentiles are selected over range buckets (``scale.exact_quantiles``);
    ``exact=False`` takes ``percentile_approx`` (a bounded sketch) instead."""
    x = F.col(col).cast("double")
    by = list(by)
    r = lambda c: round_fp(F.coalesce(c, F.lit(0.0)), digits)
    quick = [] if exact else [F.percentile_approx(x, q, 10000).alias(n) for q, n in ((0.25, "q0"), (0.75, "q1"))]
    stats = df.groupBy(*by).agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
                                F.count(x).cast("bigint").alias("count"), *quick)
    if exact:
        quantiles = exact_quantiles(df, col, [0.25, 0.75], by)
        if by:
            stats = join_null_safe(stats, quantiles, by, "left")
        else:
            stats = stats.withColumn("_k", F.lit(1)).join(quantiles.withColumn("_k", F.lit(1)), "_k", "left")
    return stats.select(*by, r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), r(F.col("q0")).alias("p25"), r(F.col("q1")).alias("p75"),
                        r(F.col("min")).alias("min"), r(F.col("max")).alias("max"), "count")


def media_summary(df: DataFrame, duration_col: str = "duration_s", by: Sequence[str] = ()) -> DataFrame:
    """A3: count, total (2 digits), mean/std/min/max (3 digits)."""
    d = F.col(duration_col).cast("double")
    return df.groupBy(*by).agg(
        F.count(d).cast("bigint").alias("count"),
        round_fp(F.sum(d), 2).alias("total_duration_s"),
        round_fp(F.avg(d), 3).alias("mean_duration_s"),
        round_fp(F.stddev_pop(d), 3).alias("std_duration_s"),
        round_fp(F.min(d), 3).alias("min_duration_s"),
        round_fp(F.max(d), 3).alias("max_duration_s"))


def speaker_counts(df: DataFrame, speaker_col: str = "speaker", term_col: str = "term",
                   approx: bool = False) -> DataFrame:
    """A4: items per speaker and distinct terms per speaker."""
    distinct = (F.approx_count_distinct(term_col) if approx else F.countDistinct(term_col))
    return df.groupBy(F.col(speaker_col).alias("speaker")).agg(
        F.count(F.lit(1)).cast("bigint").alias("items"), distinct.cast("bigint").alias("distinct_terms"))


def vector_moments(df: DataFrame, vec_col: str, by: Sequence[str] = (), dims: int | None = None) -> DataFrame:
    """A5: element-wise mean and population std, long format ``(dim, mean, std, count)``.

    ``posexplode`` + partial aggregation: each task ships one small state per
    dimension, never the vectors.  With ``dims`` there is a row for every dimension (without
    ``by``): zeros and count 0 where there are no values, so for an empty table, too."""
    e = df.select(*by, F.posexplode(vec_col).alias("dim", "_x"))
    out = e.groupBy(*by, "dim").agg(
        F.avg(F.col("_x").cast("double")).alias("mean"),
        F.stddev_pop(F.col("_x").cast("double")).alias("std"),
        F.count(F.lit(1)).cast("bigint").alias("count"))
    if dims is None or by:
        return out
    every = df.sparkSession.range(dims).select(F.col("id").cast("int").alias("dim"))
    zero = F.lit(0.0)
    return every.join(out, "dim", "left").select("dim", F.coalesce("mean", zero).alias("mean"), F.coalesce("std", zero).alias("std"),
                                                 F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def vector_bin_means(df: DataFrame, vec_col: str, id_cols: Sequence[str], k: int = 13) -> DataFrame:
    """Split each vector into ``k`` near-equal bins (the first ``n mod k`` one
    longer) and average each bin; an empty bin gives 0.  Output long format."""
    v = F.col(vec_col)
    n = F.size(v)
    base = (n / k).cast("int")
    extra = n % k

    def one_bin(b):
        length = base + F.when(b < extra, 1).otherwise(0)
        start = b * base + F.least(b, extra)
        vals = F.slice(v, start + 1, F.greatest(length, F.lit(1)))
        total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
        return F.struct(b.alias("bin"), F.when(length > 0, total / length).otherwise(0.0).alias("bin_mean"))

    bins = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), one_bin)
    return df.select(*id_cols, F.explode(bins).alias("b")).select(*id_cols, "b.bin", "b.bin_mean")


def resample_linear(df: DataFrame, key_cols: Sequence[str], t_col: str, v_col: str,
                    step: float) -> DataFrame:
    """Values on the even grid ``t0 + i·step`` (``t0`` = first sample of the
    key, up to the last sample), linearly interpolated between the samples.

    Each sample is paired with the next one of its key (bucket-split
    ``neighbour``, no per-key single-task window); each such segment emits the
    grid points ``t_a <= g < t_b`` it covers, the last sample covers ``g == t``."""
    keys = list(key_cols)
    pts = df.select(*keys, F.col(t_col).cast("double").alias("t"), F.col(v_col).cast("double").alias("v"))
    t0 = pts.groupBy(*keys).agg(F.min("t").alias("_t0"))
    seg = neighbour(pts, keys, ["t"], ["t", "v"], +1, prefix="n")
    seg = join_null_safe(seg, t0, keys)
    lo = F.ceil((F.col("t") - F.col("_t0")) / step).cast("bigint")
    hi = F.when(F.col("nt").isNull(), F.floor((F.col("t") - F.col("_t0")) / step))\
        .otherwise(F.ceil((F.col("nt") - F.col("_t0")) / step) - 1).cast("bigint")
    seg = seg.select(*keys, "t", "v", "nt", "nv", "_t0", lo.alias("lo"), hi.alias("hi")).where("hi >= lo")
    # a long gap is many stretches, not one long array
    g = stretches(seg, 3600).select(*keys, "t", "v", "nt", "nv", "_t0", F.explode(F.sequence("_a", "_b")).alias("step_index"))
    gt = F.col("_t0") + F.col("step_index") * step
    frac = F.when(F.col("nt").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(gt - F.col("t"), F.col("nt") - F.col("t")), F.lit(0.0)))
    val = F.col("v") + F.coalesce(F.col("nv") - F.col("v"), F.lit(0.0)) * frac
    return g.select(*keys, "step_index", gt.alias("t"), val.alias("value"))
