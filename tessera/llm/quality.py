"""Quality rules and robust outliers, with DataFrame functions only.

Base rules look at one text.  The method's verdict is a robust multivariate outlier test:
for every language and source the minimum covariance determinant is estimated over
transformed statistics of the texts - start from medians and absolute deviations, then
concentrate: take the ``SHARE`` nearest rows, their mean and covariance, new distances, and
again - and rows far away by Mahalanobis distance are rejected.

Medians and shares are read off histograms with fixed bins, so every step is a plain
aggregation that combines before the shuffle, and one source that holds a third of the rows
is no more work for any task.  Spreads have a small floor, so a statistic that is the same
in nearly all rows does not make small departures outliers but large ones, each statistic by
itself; the distances are only ever scaled down to the expected median.  No group is exempt: one of fewer than ``LEAST`` rows is
judged by a mixture of its own estimate, weighted by its share of ``LEAST``, and that of the
wider group (the language over all sources, then all rows), which is estimated the same way.

Null text has no words, and so fails.  Null languages and sources form groups like any other
value.  Rows may repeat; each is judged by itself.
"""

from __future__ import annotations

from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
#: Rows of a group whose covariance is sought, concentration steps, smallest group judged by itself.
SHARE, STEPS, LEAST = 0.75, 3, 40
#: Squared distance beyond which a row is an outlier: 0.9999 quantile for four normal statistics.
CUTOFF = 23.51
#: Median of the squared distance of four normal statistics.
MEDIAN = 3.357
#: Bins of the histograms: width for statistics, bins for each e-fold of a distance.
WIDTH, FOLDS = 1 / 128, 32
#: What is added to a share before its logarithm: shares far below it count as none.
OFFSETS = {"x_symbols": 0.01, "x_lines": 0.05, "x_repeats": 0.05}
#: Largest share that a row past the base rules can have.
MOST = {"x_symbols": 1.0, "x_lines": 1.0, "x_repeats": MAX_REPEATED / 100}
#: Least spread of each statistic.  Shares: half the attainable range alone reaches the cutoff
#: where nearly all rows have the same.  Word length, whose deviation is about its mean: the
#: error of the mean of the fewest words.
FLOORS = {"x_length": MIN_WORDS ** -0.5} | {k: log(1 + MOST[k] / a) / (2 * sqrt(CUTOFF)) for k, a in OFFSETS.items()}
STATS = tuple(FLOORS)


def words(text: Column) -> Column:
    flat = F.trim(F.translate(text, SPACE, " " * len(SPACE)))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics of ``text``; ``text`` itself is dropped."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keep = [F.col(f"`{c}`") for c in df.columns if c != text]
    names = [c for c in df.columns if c != text]
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.trim(F.translate(x, SPACE, " " * len(SPACE))) != "")
    first = df.select(
        *keep, words(t).alias("__w"), lines.alias("__lines"),
        F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    keep = [F.col(f"`{c}`") for c in names]
    counted = first.select(
        *keep, F.size("__w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").alias("__n_lines"),
        F.when(F.size("__w") < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.array_sort(F.transform(
            F.sequence(F.lit(1), F.size("__w") - 2),
            lambda i: F.struct(F.xxhash64(F.get("__w", i - 1), F.get("__w", i), F.get("__w", i + 1)).alias("h"), i.alias("i"))))).alias("__t"))

    def repeated(x: Column, j: Column) -> Column:
        return F.coalesce(F.get("__t", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("__t", j + 1)["h"] == x["h"], F.lit(False))

    found = counted.select(
        *[F.col(f"`{c}`") for c in counted.columns if c != "__t"],
        F.array_sort(F.transform(F.filter("__t", repeated), lambda x: x["i"])).alias("__p"))
    # each window adds the words past the one before it, three at most
    covered = F.aggregate("__p", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return found.withColumn("n_repeat_words", covered.cast("long")).drop("__p")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """The statistics whose outliers are sought, on logarithmic scales."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("__n_lines"), F.lit(1)).cast("double")
    shares = {"x_symbols": F.col("n_symbols") / chars, "x_lines": F.col("n_dup_lines") / lines, "x_repeats": F.col("n_repeat_words") / n}
    return {"x_length": F.log(chars / n)} | {k: F.log(x + OFFSETS[k]) for k, x in shares.items()}


def _quantile_bins(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """For each key the first ``bin`` that, with those below, holds the share of the rows."""
    n = rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy(*keys).orderBy("bin")
    all_ = Window.partitionBy(*keys)
    sums = n.select(*keys, "bin", F.sum("n").over(up).alias("upto"), F.sum("n").over(all_).alias("of"))
    return sums.where(F.col("upto") >= share * F.col("of")).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _medians(rows: DataFrame, columns: dict[str, Column], to: str) -> DataFrame:
    """Median of each column by group, from a histogram: ``<name><to>``."""
    long = rows.select("__g", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(c / WIDTH).alias("bin")) for k, c in columns.items()])).alias("x"))
    at = _quantile_bins(long.select("__g", "x.k", "x.bin"), ["__g", "k"], 0.5)
    return at.groupBy("__g").agg(*[F.max(F.when(F.col("k") == k, (F.col("bin") + 0.5) * WIDTH)).alias(k + to) for k in columns])


def _distance(mean: str = "_m", factor: str = "_f") -> Column:
    """Squared Mahalanobis distance from the triangular factor of the covariance."""
    z: list[Column] = []
    total = F.lit(0.0)
    for i, a in enumerate(STATS):
        v = F.col(a) - F.col(a + mean)
        for j in range(i):
            v = v - F.col(f"{factor}{i}{j}") * z[j]
        v = v / F.col(f"{factor}{i}{i}")
        z.append(v)
        total = total + v * v
    return total


def _covariance(moments: DataFrame) -> DataFrame:
    """Mean and covariance of each group, spreads at their floors or above."""
    n = F.col("n").cast("double")
    return moments.select("__g", *[(F.col(f"s{i}") / n).alias(a + "_m") for i, a in enumerate(STATS)], *[
        ((F.col(f"s{i}{j}") / n - F.col(f"s{i}") / n * (F.col(f"s{j}") / n)) + (FLOORS[a] ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
        for i, a in enumerate(STATS) for j in range(i + 1)])


def _factor(out: DataFrame) -> DataFrame:
    """Triangular (Cholesky) factor of each group's covariance."""
    for i in range(len(STATS)):
        for j in range(i + 1):
            v = F.col(f"c{i}{j}")
            for k in range(j):
                v = v - F.col(f"_f{i}{k}") * F.col(f"_f{j}{k}")
            out = out.withColumn(f"_f{i}{j}", F.sqrt(F.greatest(v, F.lit(1e-12))) if i == j else v / F.col(f"_f{j}{j}"))
    return out.select("__g", *[a + "_m" for a in STATS], *[f"_f{i}{j}" for i in range(len(STATS)) for j in range(i + 1)])


def _small(groups: DataFrame, most: int = 20_000) -> DataFrame:
    """A written table of groups, broadcast if it has few rows; else it is joined as it is."""
    return F.broadcast(groups) if groups.limit(most + 1).count() <= most else groups


def _tree(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Groups, from ``keys[0]`` to wider ones, and the wider groups of each that are needed.

    The first table has a group's rows ``__n`` and, if these are too few, the wider group
    ``__up`` (which is itself in the table only where some group needs it); the second has for
    each group of ``keys[0]`` the ``__path`` of all groups to which its rows count."""
    paths = sizes = materialise(rows.groupBy(*keys).agg(F.count("*").alias("__n")))
    groups, asked = [], None
    for i, k in enumerate(keys):
        level = sizes.groupBy(*keys[i:i + 2]).agg(F.sum("__n").alias("__n"))
        level = level if asked is None else level.join(asked, k, "left_semi")
        up = F.when(F.col("__n") < LEAST, F.col(keys[i + 1])) if i + 1 < len(keys) else F.lit(None).cast("string")
        groups.append(level.select(F.lit(i).alias("__level"), F.col(k).alias("__g"), up.alias("__up"), "__n"))
        if i + 1 < len(keys):
            asked = groups[-1].where("__up is not null").select(F.col("__up").alias(keys[i + 1])).distinct()
            paths = paths.join(asked.withColumn(f"__asked{i + 1}", F.lit(True)), keys[i + 1], "left")
    path = F.array_compact(F.array(keys[0], *[F.when(F.col(f"__asked{i}"), F.col(k)) for i, k in enumerate(keys) if i]))
    return materialise(reduce(DataFrame.unionByName, groups)), materialise(paths.select(keys[0], path.alias("__path")))


def _mixed(values: DataFrame, tree: DataFrame, levels: int) -> DataFrame:
    """Each group's values; those of small groups mixed with the wider group's, widest first."""
    names = [c for c in values.columns if c != "__g"]
    own = materialise(values.join(tree, "__g"))
    share = F.col("__n") / LEAST
    done = [own.where(F.col("__level") == levels - 1).select("__g", *names)]
    for i in reversed(range(levels - 1)):
        wider = done[-1].select(F.col("__g").alias("__up"), *[F.col(c).alias("__w" + c) for c in names])
        done.append(own.where(F.col("__level") == i).join(wider, "__up", "left").select(
            "__g", *[F.when(F.col("__up").isNull(), F.col(c)).otherwise(share * F.col(c) + (1 - share) * F.col("__w" + c)).alias(c) for c in names]))
    return reduce(DataFrame.unionByName, done)


def _bin(d: Column) -> Column:
    return F.floor(FOLDS * F.log(d + 1e-6))


def outliers(rows: DataFrame, by: list[str], steps: int = STEPS) -> DataFrame:
    """Add ``distance`` (squared, scaled) and ``outlier`` to rows with the columns ``STATS``."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in by]
    keys = [f"__g{i}" for i in range(len(by) + 1)]  # by all of ``by``, by all but the last, and so on
    key = {k: F.concat_ws("\x00", F.lit(str(i)), *parts[:len(by) - i]) for i, k in enumerate(keys)}
    tree, paths = _tree(rows.select(*[c.alias(k) for k, c in key.items()]), keys)
    rows = rows.withColumn("__g", key["__g0"])
    thin = rows.select(F.col("__g").alias("__g0"), *STATS).join(_small(paths), "__g0").select(F.explode("__path").alias("__g"), *STATS)
    medians = _small(materialise(_medians(thin, {a: F.col(a) for a in STATS}, "_m")))
    off = {a: F.abs(F.col(a) - F.col(a + "_m")) for a in STATS}
    spreads = _medians(thin.join(medians, "__g"), off, "_d")
    start = medians.join(spreads, "__g")
    near = [(F.col(a) - F.col(a + "_m")) / F.greatest(1.4826 * F.col(a + "_d"), F.lit(FLOORS[a])) for a in STATS]
    model, distance = _small(materialise(start)), sum((x * x for x in near), F.lit(0.0))
    for step in range(steps):
        binned = thin.join(model, "__g").select("__g", *STATS, _bin(distance).alias("bin"))
        limit = _small(materialise(_quantile_bins(binned, ["__g"], SHARE).withColumnRenamed("bin", "most")))
        x = [F.col(a) for a in STATS]
        moments = binned.join(limit, "__g").where("bin <= most").groupBy("__g").agg(
            F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(len(x))],
            *[F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i in range(len(x)) for j in range(i + 1)])
        estimate = _covariance(moments)
        if step == steps - 1:
            estimate = _mixed(estimate, tree, len(keys))
        model, distance = _small(materialise(_factor(estimate))), _distance()
    middle = _quantile_bins(thin.join(model, "__g").select("__g", _bin(distance).alias("bin")), ["__g"], 0.5)
    # the factors of the distances, 1 at most, are mixed and not what they are divided by: a
    # small group whose rows are all far does not make its own median the expected one
    factor = middle.select("__g", F.least(MEDIAN / F.exp((F.col("bin") + 0.5) / FOLDS), F.lit(1.0)).alias("__factor"))
    model = _small(materialise(model.join(_mixed(factor, tree, len(keys)), "__g")))
    names = [F.col(f"`{c}`") for c in rows.columns if c != "__g"]
    told = rows.join(model, "__g").withColumn("distance", distance * F.col("__factor"))
    return told.select(*names, "distance", (F.col("distance") > CUTOFF).alias("outlier"))


def judge(df: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``df`` without ``text``, with the base statistics, ``base_failed``, ``distance``,
    ``outlier`` and ``kept``."""
    taken = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "outlier", "kept", *STATS]
    names = [c for c in df.columns if c != text and (c not in taken or c in by)]
    df = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`"))
    rows = text_statistics(df, text)
    rows = materialise(rows.withColumns(transformed()).withColumn("base_failed", base_failed()).drop("__n_lines"))
    # texts that fail anyway don't shape the estimates
    fine = outliers(rows.where(~F.col("base_failed")), list(by))
    failed = rows.where("base_failed").withColumn("distance", F.lit(None).cast("double")).withColumn("outlier", F.lit(False))
    return fine.unionByName(failed).withColumn("kept", ~F.col("base_failed") & ~F.col("outlier")).drop(*STATS)
