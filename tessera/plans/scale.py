"""Scale-out building blocks for order-dependent work.

A window partitioned by nothing (or by a key with few values) puts every row
of that key into one task.  The helpers below split such work into balanced
*buckets* of the ordering column (range buckets from approximate quantiles of
each partition), do the ordered work inside each bucket, and stitch buckets
together with a tiny per-bucket table (counts, sums, first/last rows).
Results are exact; quantiles only balance the buckets.  There are twice as many
buckets as shuffle partitions, so they grow with the session's parallelism.
Null partition values form a partition like any other: stitching is null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import epoch_micros


def default_buckets(df: DataFrame) -> int:
    """Twice the shuffle partitions of the session, which are sized to the data."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same names in which null equals null."""
    names = {k: f"__right_{i}" for i, k in enumerate(keys)}
    cond = F.lit(True)
    for k, r in names.items():
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(r))
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def _names(cols: Sequence[str] | str | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _as_double(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind.startswith("timestamp"):
        return epoch_micros(df, name).cast("double")
    if kind == "date":
        return F.unix_date(F.col(name)).cast("double")
    return F.col(name).cast("double")


def range_bounds(order: Column, n_buckets: int) -> Column:
    """Aggregate: rising bounds between so many buckets of about the same number of rows; with few distinct
    values there are fewer."""
    return F.array_distinct(F.percentile_approx(order, [i / n_buckets for i in range(1, n_buckets)], 10000))


def bucket_of(df: DataFrame, order: Column, bounds: str, n_buckets: int, name: str = "_bucket") -> DataFrame:
    """Add the number of rising ``bounds`` (less than ``n_buckets``) below ``order``, found by bisection: a row
    costs the logarithm of their number.  Nulls are in bucket 0."""
    step = 1 << (n_buckets - 1).bit_length()
    df = df.withColumn(name, F.lit(0))
    while step > 1:  # one projection a step, which uses the one before twice
        step //= 2
        df = df.withColumn(name, F.col(name) + F.when(F.get(F.col(bounds), F.col(name) + (step - 1)) < order, step).otherwise(0))
    return df


def with_range_bucket(df: DataFrame, order_col: str, n_buckets: int | None = None,
                      name: str = "_bucket", partition_cols=None) -> DataFrame:
    """Add a bucket id that is monotone in ``order_col`` and roughly balanced inside each
    partition, whatever range its values have."""
    n_buckets = n_buckets or default_buckets(df)
    parts = _names(partition_cols)
    if n_buckets <= 1:
        return df.withColumn(name, F.lit(0))
    d = df.withColumn("_ordx", _as_double(df, order_col))
    bounds = range_bounds(F.col("_ordx"), n_buckets).alias("_bounds")
    if parts:
        # a small partition has few distinct bounds
        d = join_null_safe(d, d.groupBy(*parts).agg(bounds), parts)
    else:
        # one row of at most n_buckets - 1 doubles: a proven-small broadcast side
        d = d.withColumn("_one", F.lit(1))
        d = d.join(F.broadcast(d.groupBy("_one").agg(bounds)), "_one").drop("_one")
    return bucket_of(d, F.col("_ordx"), "_bounds", n_buckets, name).drop("_bounds", "_ordx")


def global_row_number(df: DataFrame, order_cols: Sequence[str], partition_cols=None,
                      name: str = "rn", n_buckets: int | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by p order by o)`` without a single-task window.

    The first order column must be numeric.  Ties in later order columns are
    broken by them as usual; the ordering must be total for a unique result.
    """
    parts = _names(partition_cols)
    order = _names(order_cols)
    b = with_range_bucket(df, order[0], n_buckets, partition_cols=parts)
    w_in = Window.partitionBy(*parts, "_bucket").orderBy(*order)
    b = b.withColumn("_rn_in", F.row_number().over(w_in))
    counts = b.groupBy(*parts, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = (Window.partitionBy(*parts).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w_off), F.lit(0))).drop("_cnt")
    return (join_null_safe(b, offsets, [*parts, "_bucket"])
            .withColumn(name, (F.col("_off") + F.col("_rn_in")).cast("bigint"))
            .drop("_bucket", "_rn_in", "_off"))


def running_sum(df: DataFrame, value_col, order_cols: Sequence[str], partition_cols=None,
                name="running", n_buckets: int | None = None) -> DataFrame:
    """Exact running sum(s) over a total order, split into balanced buckets.

    ``value_col``/``name`` may be lists to compute several sums in one pass."""
    values = _names(value_col)
    names = _names(name)
    parts = _names(partition_cols)
    order = _names(order_cols)
    b = with_range_bucket(df, order[0], n_buckets, partition_cols=parts)
    w_in = (Window.partitionBy(*parts, "_bucket").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, 0))
    for v, n in zip(values, names):
        b = b.withColumn(f"_rs_{n}", F.sum(v).over(w_in))
    sums = b.groupBy(*parts, "_bucket").agg(*[F.sum(v).alias(f"_bs_{n}") for v, n in zip(values, names)])
    w_off = (Window.partitionBy(*parts).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    for n in names:
        sums = sums.withColumn(f"_off_{n}", F.coalesce(F.sum(f"_bs_{n}").over(w_off), F.lit(0)))
    offsets = sums.select(*parts, "_bucket", *[f"_off_{n}" for n in names])
    out = join_null_safe(b, offsets, [*parts, "_bucket"])
    for n in names:
        out = out.withColumn(n, F.col(f"_off_{n}") + F.col(f"_rs_{n}")).drop(f"_off_{n}", f"_rs_{n}")
    return out.drop("_bucket")


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], by=None, prefix: str = "q") -> DataFrame:
    """Exact quantiles (linear interpolation) per group by distributed selection: ``by…, q0, q1, …``.

    Equal values are counted first, so a hot value is one row.  The distinct values fall into
    range buckets with a count each; the counts tell which buckets hold the wanted ranks, and
    only those are put in order.  No task sees a whole group and no state grows with it.  Nulls are
    no values; a group without any has no row."""
    parts = _names(by)
    x = F.col(f"`{col}`").cast("double")
    values = df.select(*parts, x.alias("_x")).where("_x is not null").groupBy(*parts, "_x").agg(F.count(F.lit(1)).alias("_c"))
    b = with_range_bucket(values, "_x", partition_cols=parts)
    key = parts or ["_all"]
    if not parts:
        b = b.withColumn("_all", F.lit(0))
    sums = b.groupBy(*key, "_bucket").agg(F.sum("_c").alias("_in"))
    order = Window.partitionBy(*key).orderBy("_bucket")
    every = Window.partitionBy(*key)
    sums = sums.select("*", F.coalesce(F.sum("_in").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                       F.sum("_in").over(every).alias("_n"))
    at = [q * (F.col("_n") - 1) for q in qs]
    ranks = [r.cast("bigint") for p in at for r in (F.floor(p), F.ceil(p))]
    holds = F.lit(False)
    for r in ranks:
        holds = holds | ((F.col("_off") <= r) & (r < F.col("_off") + F.col("_in")))
    chosen = join_null_safe(b, sums.where(holds).drop("_in"), [*key, "_bucket"])
    upto = F.col("_off") + F.sum("_c").over(Window.partitionBy(*key, "_bucket").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    rows = chosen.withColumn("_upto", upto)
    has = lambda r: (F.col("_upto") - F.col("_c") <= r) & (r < F.col("_upto"))
    picked = rows.groupBy(*key).agg(F.max("_n").alias("_n"), *[F.max(F.when(has(r), F.col("_x"))).alias(f"_v{i}") for i, r in enumerate(ranks)])
    out = [(F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * (p - F.floor(p))).alias(f"{prefix}{i}") for i, p in enumerate(at)]
    return picked.select(*parts, *out)


def neighbour(df: DataFrame, key_cols, order_cols: Sequence[str], value_cols: Sequence[str],
              direction: int = -1, prefix: str = "prev_",
              n_buckets: int | None = None) -> DataFrame:
    """``lag`` (direction -1) or ``lead`` (+1) of ``value_cols`` per key, bucket-split.

    Inside a bucket the ordinary window function is used; the first (last) row
    of a bucket takes its neighbour from the last (first) row of the nearest
    non-empty previous (next) bucket of the same key.
    """
    keys = _names(key_cols)
    order = _names(order_cols)
    vals = _names(value_cols)
    b = with_range_bucket(df, order[0], n_buckets, partition_cols=keys)
    w_in = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    fn = F.lag if direction < 0 else F.lead
    edge_rank = F.row_number().over(
        w_in if direction < 0 else Window.partitionBy(*keys, "_bucket").orderBy(*[F.desc(c) for c in order]))
    for v in vals:
        b = b.withColumn(f"_in_{v}", fn(v, 1).over(w_in))
    b = b.withColumn("_edge", edge_rank == 1)
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(v).alias(v) for v in vals])
    pick = F.max_by if direction < 0 else F.min_by
    ends = b.groupBy(*keys, "_bucket").agg(pick(payload, ordering).alias("_end"))
    w_b = Window.partitionBy(*keys).orderBy("_bucket")
    ends = ends.withColumn("_nb", (F.lag if direction < 0 else F.lead)("_end", 1).over(w_b)).drop("_end")
    out = join_null_safe(b, ends, [*keys, "_bucket"])
    for v in vals:
        out = out.withColumn(prefix + v, F.when(F.col("_edge"), F.col("_nb")[v]).otherwise(F.col(f"_in_{v}")))
        out = out.drop(f"_in_{v}")
    return out.drop("_bucket", "_edge", "_nb")


def _chunks(df: DataFrame, keys: list[str], order_cols: Sequence[str], n_rows: int, chunk_rows: int) -> DataFrame:
    """Rows numbered per key (``_rrn``) in chunks (``_chunk``), each with the ``n_rows - 1`` rows before it as
    context (``_ctx``)."""
    if n_rows - 1 >= chunk_rows:
        raise ValueError("chunk_rows must exceed the frame length")
    numbered = global_row_number(df, order_cols, keys, name="_rrn")
    pos = (F.col("_rrn") - 1) % chunk_rows
    chunk = ((F.col("_rrn") - 1) / chunk_rows).cast("bigint")
    copies = F.array(
        F.struct(chunk.alias("_chunk"), F.lit(False).alias("_ctx")),
        F.when(pos >= chunk_rows - (n_rows - 1),
               F.struct((chunk + 1).alias("_chunk"), F.lit(True).alias("_ctx"))))
    return (numbered.withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
                .select("*", "_copy._chunk", "_copy._ctx").drop("_copy"))


def rolling_means(df: DataFrame, key_cols, order_cols: Sequence[str], n_rows: int, values: dict[str, str],
                  chunk_rows: int = 20_000) -> DataFrame:
    """Means of columns over the last ``n_rows`` rows per key (output name -> column; nulls take a place but
    no part).  As ``rolling_rows``, but each row costs the same whatever the frame's length: running
    sums and counts inside a chunk, less those of ``n_rows`` rows before.  Exact for flags and
    counts."""
    keys = _names(key_cols)
    rows = _chunks(df, keys, order_cols, n_rows, chunk_rows)
    order = Window.partitionBy(*keys, "_chunk").orderBy("_rrn")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    for i, c in enumerate(values.values()):
        rows = rows.withColumn(f"_s{i}", F.coalesce(F.sum(c).over(upto), F.lit(0.0))).withColumn(f"_n{i}", F.count(c).over(upto))
    for i, name in enumerate(values):
        s, n = (F.col(f"_{x}{i}") - F.coalesce(F.lag(f"_{x}{i}", n_rows).over(order), F.lit(0)) for x in "sn")
        rows = rows.withColumn(name, F.try_divide(s, n))
    return rows.filter(~F.col("_ctx")).drop("_chunk", "_ctx", "_rrn", *[f"_{x}{i}" for x in "sn" for i in range(len(values))])


def rolling_rows(df: DataFrame, key_cols, order_cols: Sequence[str], n_rows: int,
                 aggs: dict[str, Column], chunk_rows: int = 20_000) -> DataFrame:
    """Aggregates over the last ``n_rows`` rows per key (a ROWS frame) without
    holding a whole key in one task.

    Rows are numbered per key (``global_row_number``), cut into chunks of
    ``chunk_rows``; the last ``n_rows-1`` rows of each chunk are copied into the
    next chunk as context, so every frame is complete inside one chunk.
    ``aggs`` maps output names to aggregate columns (e.g. ``F.avg("flag")``).
    """
    keys = _names(key_cols)
    exploded = _chunks(df, keys, order_cols, n_rows, chunk_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rrn").rowsBetween(-(n_rows - 1), 0)
    for name, agg in aggs.items():
        exploded = exploded.withColumn(name, agg.over(w))
    return exploded.filter(~F.col("_ctx")).drop("_chunk", "_ctx", "_rrn")


def stretches(spans: DataFrame, size: int) -> DataFrame:
    """Rows with ``lo`` and ``hi`` cut into stretches ``_a`` to ``_b`` of at most ``size`` whole numbers.
    The stretches of a span are numbered in two steps of at most 4096, spread over tasks in
    between: no row holds more than 4096 of them, spans of up to 4096 * 4096 stretches included."""
    block = 4096 * size
    n = F.floor((F.col("hi") - F.col("lo")) / block).cast("bigint")
    outer = spans.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("_i")).repartition("_i")
    lo = F.col("lo") + F.col("_i") * block
    inner = outer.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.least("hi", lo + block - 1) - lo) / size).cast("bigint"))).alias("_j"))
    a = lo + F.col("_j") * size
    return inner.withColumn("_a", a).withColumn("_b", F.least("hi", a + size - 1)).drop("_i", "_j")
