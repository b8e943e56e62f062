"""Quality metrics: corpus WER, corpus BLEU, sequence confidence."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import round_fp
from tessera.functions.text import strip_ws
from tessera.plans.scale import join_null_safe

MAX_NGRAM = 4
# Fixed values of the default BLEU tokenizer ("13a"), applied in this order.
BLEU_13A_RULES = (
    ("([\\{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])", " $1 "),
    ("([^0-9])([\\.,])", "$1 $2 "),
    ("([\\.,])([^0-9])", " $1 $2"),
    ("([0-9])(-)", "$1 $2 "),
)
BLEU_13A_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
LOG_ZERO = -9999999999.0


# ----------------------------------------------------------------------------- WER
def wer_words(text: Column) -> Column:
    """Words as the WER transform sees them: runs of 2+ whitespace collapse to a
    space, the text is stripped and split on single spaces."""
    t = strip_ws(F.regexp_replace(text, "(?U)\\s\\s+", " "))
    return F.filter(F.split(t, " "), lambda w: F.length(w) >= 1)


def _computed(df: DataFrame, keep: Sequence[str], **cols: Column) -> DataFrame:
    """``keep`` and the new columns, computed once a row.  A projection would do, but the optimizer
    merges projections, and an expression that a lambda refers to is then evaluated for every
    element; it does not look into a generator.  Arrays are sorted in a step of their own, where
    they are flat."""
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def _dealt(pairs: DataFrame) -> DataFrame:
    """Comparing two texts takes far longer than shuffling them: even shares for all tasks, also
    where the table is one small file or a join has left a few large partitions."""
    return pairs if pairs.isStreaming else pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _run_starts(items: str, key: str) -> Column:
    """Where runs of equal keys start in a sorted array column, and its size at the end."""
    s = F.col(items)
    first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)[key] != F.get(s, i - 1)[key]))
    return F.concat(F.when(F.size(s) > 0, first).otherwise(F.array().cast("array<int>")), F.array(F.size(s)))


def _code_point(number: Column) -> Column:
    """Word numbers as code points, from 1 on and past the surrogates.  A pair with more distinct
    words than there are code points fails loudly."""
    i = F.when(number + 1 >= 0xD800, number + 0x801).otherwise(number + 1)
    return F.when(i <= 0x10FFFF, i).otherwise(F.raise_error(F.lit("a pair has more distinct words than code points")).cast("int"))


def pair_errors(pairs: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis") -> DataFrame:
    """Per pair: word edits (null without a hypothesis) and reference length (pairs with a blank reference
    dropped).

    The words of both sides are sorted together with their places, so that equal words are a run;
    the number of its run becomes a word's code point, and the native character
    ``levenshtein`` then compares words."""
    keep = pairs.columns
    d = _computed(pairs.filter(strip_ws(F.coalesce(F.col(ref_col), F.lit(""))) != ""), keep, __r=wer_words(F.col(ref_col)), __h=wer_words(F.col(hyp_col)))
    both = F.concat(F.transform("__r", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                    F.transform("__h", lambda w, i: F.struct(w.alias("w"), (i + F.size("__r")).alias("i"))))
    d = _computed(d, keep, __n=F.size("__r"), __u=both)
    d = _computed(d, [*keep, "__n"], __s=F.sort_array("__u"))
    d = _computed(d, [*keep, "__n", "__s"], __at=_run_starts("__s", "w"))
    numbered = F.flatten(F.transform(F.slice("__at", 1, F.size("__at") - 1), lambda a, k: F.transform(
        F.sequence(a, F.get(F.col("__at"), k + 1) - 1), lambda j: F.struct(F.get(F.col("__s"), j)["i"].alias("i"), k.alias("k")))))
    d = _computed(d, [*keep, "__n"], __u=numbered)
    d = _computed(d, [*keep, "__n"], __c=F.sort_array("__u"))
    d = _computed(d, [*keep, "__n"], __x=F.transform("__c", lambda x: F.lpad(F.hex(_code_point(x["k"])), 8, "0")))

    def text(part: Column) -> Column:
        return F.decode(F.unhex(F.array_join(part, "")), "UTF-32")

    d = _computed(d, [*keep, "__n"], __a=text(F.slice("__x", 1, F.col("__n"))), __b=text(F.slice("__x", F.col("__n") + 1, F.greatest(F.size("__x"), F.lit(1)))))
    return _computed(d, keep, edits=F.when(F.col(hyp_col).isNotNull(), F.levenshtein("__a", "__b")).cast("bigint"), ref_words=F.col("__n").cast("bigint"))


def word_error_rate(pairs: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis",
                    by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Σ word edits / Σ reference words; no rows → 1.0; rounded to ``digits``
    (``by`` gives the live per-group gauge)."""
    e = pair_errors(_dealt(pairs.select(*by, ref_col, hyp_col)), ref_col, hyp_col)
    agg = e.groupBy(*by).agg(F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"),
                             F.count(F.lit(1)).cast("bigint").alias("pairs"))
    wer = F.when(F.col("ref_words") > 0, F.col("edits") / F.col("ref_words")).otherwise(1.0)
    out = agg.select(*by, round_fp(wer, digits).alias("wer"), F.col("edits").cast("bigint").alias("edits"),
                     F.col("ref_words").cast("bigint").alias("ref_words"), "pairs")
    if not by:
        # an empty corpus still yields its one row (wer = 1.0)
        out = out.select(F.coalesce("wer", F.lit(1.0)).alias("wer"), F.coalesce("edits", F.lit(0)).alias("edits"),
                         F.coalesce("ref_words", F.lit(0)).alias("ref_words"), "pairs")
    return out


# ---------------------------------------------------------------------------- BLEU
def bleu_tokens(text: Column) -> Column:
    """Default ("13a") BLEU tokenisation of a stripped text."""
    t = F.replace(strip_ws(text), F.lit("<skipped>"), F.lit(""))
    t = F.replace(t, F.lit("-\n"), F.lit(""))
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    for a, b in BLEU_13A_ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for pat, rep in BLEU_13A_RULES:
        t = F.regexp_replace(t, pat, rep)
    return F.filter(F.split(t, "(?U)\\s+"), lambda x: x != "")


def _ngrams(tokens: Column, n: int) -> Column:
    """By places: a slice would copy the whole array each time."""
    k = F.size(tokens) - n
    return F.when(k >= 0, F.transform(F.sequence(F.lit(0), F.greatest(k, F.lit(0))),
                                      lambda i: F.concat_ws(" ", *[F.get(tokens, i + j) for j in range(n)]))
                  ).otherwise(F.array().cast("array<string>"))


ORDERS = range(1, MAX_NGRAM + 1)
BLEU_STATS = [*(f"total{n}" for n in ORDERS), "sys_len", "ref_len", *(f"correct{n}" for n in ORDERS)]


def pair_bleu(pairs: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis") -> DataFrame:
    """Per pair the numbers that BLEU adds up (``BLEU_STATS``): n-grams of the hypothesis and clipped
    matches per order, and lengths.  Pairs with a null side are dropped.

    The n-grams of both sides are sorted together; those of a gram are then two neighbouring
    runs, the shorter of which is its clipped match.  No gram leaves its row."""
    keep = pairs.columns
    d = pairs.where(F.col(ref_col).isNotNull() & F.col(hyp_col).isNotNull())
    d = _computed(d, keep, __r=bleu_tokens(F.col(ref_col)), __h=bleu_tokens(F.col(hyp_col)))
    grams = F.concat(*[F.transform(_ngrams(F.col(c), n), functools.partial(_gram, n, side)) for c, side in (("__h", 0), ("__r", 1)) for n in ORDERS])
    d = _computed(d, keep, __hl=F.size("__h"), __rl=F.size("__r"), __g=grams)
    d = _computed(d, [*keep, "__hl", "__rl"], __s=F.sort_array("__g"))
    d = _computed(d, [*keep, "__hl", "__rl", "__s"], __at=_run_starts("__s", "x"))
    runs = F.transform(F.slice("__at", 1, F.size("__at") - 1), lambda a, k: F.struct(F.get(F.col("__s"), a)["x"].alias("x"), (F.get(F.col("__at"), k + 1) - a).alias("n")))
    d = _computed(d, [*keep, "__hl", "__rl"], __runs=runs)

    def clipped(run: Column, k: Column) -> Column:
        after = F.get(F.col("__runs"), k + 1)
        same = (run["x"]["side"] == 0) & (after["x"]["gram"] == run["x"]["gram"]) & (after["x"]["n"] == run["x"]["n"])
        return F.struct(run["x"]["n"].alias("n"), F.when(same, F.least(run["n"], after["n"])).otherwise(0).alias("m"))

    d = _computed(d, [*keep, "__hl", "__rl"], __m=F.transform("__runs", clipped))

    def matches(n: int) -> Column:
        return F.aggregate(F.filter("__m", lambda m: m["n"] == n), F.lit(0), lambda a, m: a + m["m"])

    d = _computed(d, [*keep, "__hl", "__rl"], **{f"correct{n}": matches(n).cast("bigint") for n in ORDERS})
    return d.select(*[F.col(f"`{c}`") for c in keep], *[F.greatest(F.col("__hl") - (n - 1), F.lit(0)).cast("bigint").alias(f"total{n}") for n in ORDERS],
                    F.col("__hl").cast("bigint").alias("sys_len"), F.col("__rl").cast("bigint").alias("ref_len"), *[f"correct{n}" for n in ORDERS])


def _gram(n: int, side: int, g: Column) -> Column:
    return F.struct(F.struct(F.lit(n).alias("n"), g.alias("gram"), F.lit(side).alias("side")).alias("x"))


def bleu_stats(pairs: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis", by: Sequence[str] = ()) -> DataFrame:
    """``BLEU_STATS`` added up per group: ten numbers a pair and one aggregation.  Null groups are groups like
    any other."""
    s = pair_bleu(_dealt(pairs.select(*by, ref_col, hyp_col)), ref_col, hyp_col)
    return s.groupBy(*by).agg(*[(F.sum(c) if c.endswith("len") else F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in BLEU_STATS])


def bleu_score() -> tuple[Column, Column]:
    """Score (0 to 100) and brevity penalty from the columns ``BLEU_STATS``."""
    smooth, logs, stop = F.lit(1.0), [], F.lit(False)
    for n in ORDERS:
        tot, cor = F.col(f"total{n}"), F.col(f"correct{n}")
        stop = stop | (tot == 0)
        smooth_n = smooth * F.when(cor == 0, 2.0).otherwise(1.0)
        prec = F.when(stop, F.lit(0.0)).when(cor == 0, 100.0 / (smooth_n * tot)).otherwise(100.0 * cor / tot)
        smooth = F.when(stop, smooth).otherwise(smooth_n)
        logs.append(F.when(prec > 0, F.log(prec)).otherwise(F.lit(LOG_ZERO)))
    sys_len, ref_len = F.col("sys_len").cast("double"), F.col("ref_len").cast("double")
    bp = F.when(sys_len < ref_len, F.when(sys_len > 0, F.exp(1 - ref_len / sys_len)).otherwise(0.0)).otherwise(1.0)
    return bp * F.exp(sum(logs[1:], logs[0]) / MAX_NGRAM), bp


def corpus_bleu(pairs: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis",
                by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Corpus BLEU (orders 1–4, exponential smoothing, brevity penalty) / 100."""
    score, bp = bleu_score()
    return bleu_stats(pairs, ref_col, hyp_col, by).select(
        *by, round_fp(score / 100.0, digits).alias("bleu"), bp.alias("brevity_penalty"),
        F.col("sys_len").cast("bigint").alias("sys_len"), F.col("ref_len").cast("bigint").alias("ref_len"))


def live_quality(labelled: DataFrame, window: str = "15 minutes", ref_col: str = "reference", hyp_col: str = "hypothesis",
                 ts: str = "ts", by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Word error rate and BLEU per time window (and group), from one pass over the labelled rows: what
    both measures add up is kept beside each other, so windows can be merged further."""
    stats = quality_stats(labelled, ref_col, hyp_col)
    w = stats.groupBy(F.window(ts, window).alias("w"), *by).agg(*[F.sum(c).alias(c) for c in QUALITY_STATS])
    return quality_gauges(w, by, digits)


#: What the live measures add up.
QUALITY_STATS = ["pairs", "edits", "ref_words", *BLEU_STATS]


def quality_stats(labelled: DataFrame, ref_col: str = "reference", hyp_col: str = "hypothesis") -> DataFrame:
    """Rows with a reference that isn't blank and a hypothesis, with ``QUALITY_STATS``."""
    s = pair_bleu(_dealt(labelled), ref_col, hyp_col)
    return pair_errors(s, ref_col, hyp_col).withColumn("pairs", F.lit(1).cast("bigint")).drop(ref_col, hyp_col)


def quality_gauges(w: DataFrame, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    score, _ = bleu_score()
    wer = F.when(F.col("ref_words") > 0, F.col("edits") / F.col("ref_words")).otherwise(1.0)
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *by, "pairs",
                    round_fp(wer, digits).alias("wer"), round_fp(score / 100.0, digits).alias("bleu"))


# ------------------------------------------------------------------ confidence
def step_log_prob(logits: Column) -> Column:
    """max log-softmax of one decoding step's logits."""
    m = F.array_max(F.transform(logits, lambda x: x.cast("double")))
    lse = m + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - m)))
    return m - lse


#: Confidence of a sequence without a step.
NO_STEPS = 0.5


def sequence_confidence(steps: DataFrame, seq_cols: Sequence[str], logits_col: str, digits: int = 3,
                        sequences: DataFrame | None = None) -> DataFrame:
    """confidence = clamp(exp(mean step max-log-prob), 0, 1) per sequence; steps without logits are
    none.  ``sequences`` (rows of ``seq_cols``) names all there are: one without a step has 0.5.
    Without ``seq_cols`` all steps are one sequence, which has its row in any case."""
    s = steps.where(F.size(logits_col) > 0).select(*seq_cols, step_log_prob(F.col(logits_col)).alias("_lp"))
    conf = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.exp(F.avg("_lp"))))
    out = s.groupBy(*seq_cols).agg(F.when(F.count(F.lit(1)) > 0, conf).alias("confidence"), F.count(F.lit(1)).cast("bigint").alias("steps"))
    if sequences is not None:
        out = join_null_safe(sequences.select(*seq_cols).distinct(), out, seq_cols, "left")
    return out.select(*seq_cols, round_fp(F.coalesce("confidence", F.lit(NO_STEPS)), digits).alias("confidence"),
                      F.coalesce("steps", F.lit(0)).cast("bigint").alias("steps"))


def beam_confidence(score: Column) -> Column:
    """A9 (beam variant): clamp(sigmoid(score), 0, 1)."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 / (1.0 + F.exp(-score))))
