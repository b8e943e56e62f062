"""Corpus building: pairs, phrase synthesis, union/dedupe, HTML mining, tiers,
stratified split and summaries (C1–C14)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import (
    clean_source,
    html_to_lines,
    looks_like_source,
    primary_gloss,
    quoted_target,
    strip_ws,
)
from tessera.plans.scale import global_row_number, join_null_safe
from tessera.session import cut_lineage

# Fixed values of the reference corpus build.
PHRASES_2 = 500
PHRASES_3 = 200
TRAIN_RATIO = 0.8
VAL_RATIO = 0.1
SPLIT_SEED = 42
LOOKAHEAD_LINES = 3
# Multiplier/modulus of the seeded split order (a permutation of residues).
ORDER_MULT = 1_000_003
ORDER_MOD = 4_294_967_291


def word_pairs(lex: DataFrame) -> DataFrame:
    """``(seq, src=term, tgt=primary gloss)``, empty glosses dropped."""
    return (lex.select("seq", F.col("term").alias("src"), primary_gloss(F.col("gloss")).alias("tgt"))
            .filter(F.col("tgt").isNotNull()))


def dense_index(lex: DataFrame, name: str = "idx") -> DataFrame:
    """0-based dense index in ``seq`` order (bucket-split, no global window)."""
    return global_row_number(lex, ["seq"], name=name).withColumn(name, F.col(name) - 1)


def phrase_pairs(lex: DataFrame, n2: int = PHRASES_2, n3: int = PHRASES_3,
                 mult: Sequence[int] = (7919, 104729, 1299709), offset: Sequence[int] = (1, 17, 401)) -> DataFrame:
    """min(n2, N) 2-word and min(n3, N//2) 3-word phrases.

    Word j of phrase i is entry ``(mult[j]·i + offset[j]) mod N`` of the
    dense ``seq`` order, moved forward past earlier picks so the words of one
    phrase are distinct.  Glosses are the primary glosses joined by spaces.
    Phrase ids come from ``spark.range``; words arrive by equi-joins on the
    dense index — no sampling on the driver.
    """
    spark = lex.sparkSession
    # lexicon-sized and read by five joins: materialise once (reliable checkpoint)
    idx = cut_lineage(dense_index(lex.select("seq", "term", primary_gloss(F.col("gloss")).alias("pg"))))
    n = lex.select(F.count(F.lit(1))).scalar()
    outs = []
    for width, count, kind in ((2, F.least(F.lit(n2), n), "phrase2"), (3, F.least(F.lit(n3), F.floor(n / 2)), "phrase3")):
        ids = spark.range(0, max(n2, n3)).withColumnRenamed("id", "i").filter(F.col("i") < count)
        picks = []
        for j in range(width):
            raw = F.pmod(F.lit(mult[j]) * F.col("i") + offset[j], n)
            # step forward (mod N) past the earlier picks of this phrase
            p = raw
            for earlier in picks:
                p = F.when(p == earlier, F.pmod(p + 1, n)).otherwise(p)
            for earlier in picks:
                p = F.when(p == earlier, F.pmod(p + 1, n)).otherwise(p)
            picks.append(p)
        rows = ids.select("i", *[p.alias(f"w{j}") for j, p in enumerate(picks)])
        for j in range(width):
            w = idx.select(F.col("idx").alias(f"w{j}"), F.col("term").alias(f"t{j}"),
                           F.coalesce("pg", F.lit("")).alias(f"g{j}"))
            rows = rows.join(w, f"w{j}")
        outs.append(rows.select(
            F.lit(kind).alias("kind"), F.col("i").alias("phrase_id"),
            F.concat_ws(" ", *[F.col(f"t{j}") for j in range(width)]).alias("src"),
            F.concat_ws(" ", *[F.col(f"g{j}") for j in range(width)]).alias("tgt")))
    return outs[0].unionByName(outs[1])


def combine(*parts: DataFrame) -> DataFrame:
    """UNION ALL of pair sets (each with ``kind``, ``seq``, ``src``, ``tgt``)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedupe_pairs(pairs: DataFrame, seq_col: str = "seq") -> DataFrame:
    """C4: keep the first pair (by ``seq``) of each case-insensitive (src, tgt)."""
    row = F.struct(*[F.col(c) for c in pairs.columns])
    return (pairs.groupBy(F.lower("src").alias("_ks"), F.lower("tgt").alias("_kt"))
            .agg(F.min_by(row, F.col(seq_col)).alias("r")).select("r.*"))


def dedupe_by_source(pairs: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Keep the first pair per ``lower(strip(src))``."""
    row = F.struct(*[F.col(c) for c in pairs.columns])
    return (pairs.groupBy(F.lower(strip_ws(F.col("src"))).alias("_k"))
            .agg(F.min_by(row, F.col(seq_col)).alias("r")).select("r.*"))


def html_lines(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per text line ``(id, line_no, line)``."""
    return pages.select(id_col, F.posexplode(html_to_lines(F.col(html_col))).alias("line_no", "line"))


def adjacent_line_pairs(pages: DataFrame, is_source: Callable[[Column], Column] = looks_like_source,
                        extract_target: Callable[[Column], Column] = quoted_target,
                        clean: Callable[[Column], Column] = clean_source,
                        horizon: int = LOOKAHEAD_LINES, id_col: str = "page_id",
                        html_col: str = "html") -> DataFrame:
    """For each source line, the first non-empty line among the next
    ``horizon`` must yield a target; else no pair.

    Works on each page's line array in place (lookahead by index), so it
    needs no window and no shuffle."""
    # the line array is projected once; the lambda only indexes into it
    paged = pages.select(id_col, html_to_lines(F.col(html_col)).alias("_lines"))
    lines = F.col("_lines")

    def entry(x, i):
        ahead = [F.nullif(F.try_element_at(lines, i + 1 + k), F.lit("")) for k in range(1, horizon + 1)]
        return F.struct(i.alias("line_no"), x.alias("line"), F.coalesce(*ahead).alias("next_line"))

    e = paged.select(id_col, F.explode(F.transform(lines, entry)).alias("e")).select(id_col, "e.*")
    e = e.filter(is_source(F.col("line")))
    tgt = extract_target(F.col("next_line"))
    src = clean(F.col("line"))
    return (e.select(id_col, "line_no", src.alias("src"), tgt.alias("tgt"))
            .filter(F.col("src").isNotNull() & F.col("tgt").isNotNull()))


def frequency_tier(lex: DataFrame, type_col: str = "term_type") -> DataFrame:
    """C11: rank term types by count (ties: first seen); first 30 % common,
    next 40 % mid, rest rare.  The types are ranked over range buckets, so many types
    are no single task, and joined back."""
    t = F.coalesce(F.col(type_col), F.lit("unknown"))
    counts = lex.groupBy(t.alias("_type")).agg(F.count(F.lit(1)).alias("_n"), F.min("seq").alias("_first"))
    ranked = (global_row_number(counts.withColumn("_less", -F.col("_n")), ["_less", "_first"], name="_rn")
              .select("_type", (F.col("_rn") - 1).alias("_i"), F.lit(1).alias("_one"))
              .join(counts.agg(F.count(F.lit(1)).alias("_nt")).withColumn("_one", F.lit(1)), "_one"))
    tier = (F.when(F.col("_i") < F.col("_nt") * 0.3, "common")
            .when(F.col("_i") < F.col("_nt") * 0.7, "mid").otherwise("rare"))
    tiers = ranked.select("_type", tier.alias("tier"))
    return (lex.withColumn("_type", t).join(tiers, "_type", "left")
            .withColumn("tier", F.coalesce("tier", F.lit("rare"))).drop("_type"))


def split_order(id_col: Column, seed: int = SPLIT_SEED) -> Column:
    """Seeded, partition-independent order key: ((id mod P)·A + seed) mod P."""
    return F.pmod(F.pmod(id_col, F.lit(ORDER_MOD)) * F.lit(ORDER_MULT) + F.lit(seed), F.lit(ORDER_MOD))


def stratified_split(items: DataFrame, id_col: str, strata_col: str, train: float = TRAIN_RATIO,
                     val: float = VAL_RATIO, seed: int = SPLIT_SEED) -> DataFrame:
    """Per stratum of n items: train = max(1, ⌊n·train⌋), val = max(1, ⌊n·val⌋)
    if n > 2 else 0, rest test; order inside a stratum is the seeded key.

    Exact ranks come from bucket-split ranking, so a huge stratum is not one task."""
    keyed = items.withColumn("_ok", split_order(F.col(id_col), seed))
    ranked = global_row_number(keyed, ["_ok", id_col], [strata_col], name="_rn")
    n = items.groupBy(strata_col).agg(F.count(F.lit(1)).alias("_n"))
    r = join_null_safe(ranked, n, [strata_col])
    n_train = F.greatest(F.lit(1), F.floor(F.col("_n").cast("double") * F.lit(train)))
    n_val = F.when(F.col("_n") > 2, F.greatest(F.lit(1), F.floor(F.col("_n").cast("double") * F.lit(val)))).otherwise(0)
    split = (F.when(F.col("_rn") <= n_train, "train")
             .when(F.col("_rn") <= n_train + n_val, "val").otherwise("test"))
    return r.withColumn("split", split).drop("_ok", "_rn", "_n")


def split_summary(split_df: DataFrame, kind_col: str = "kind") -> DataFrame:
    """Counts per kind × split (pivot on the three known splits)."""
    p = split_df.groupBy(kind_col).pivot("split", ["train", "val", "test"]).count()
    return p.select(kind_col, *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in ("train", "val", "test")])


def corpus_manifest(pairs: DataFrame, kind_col: str = "kind") -> DataFrame:
    """C14: one-row totals by kind (total, word pairs, phrase pairs, source words)."""
    k = F.col(kind_col)
    return pairs.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_pairs"),
        F.count_if(k == "word").cast("bigint").alias("word_pairs"),
        F.count_if(F.startswith(k, F.lit("phrase"))).cast("bigint").alias("phrase_pairs"),
        F.sum(F.size(F.split(F.col("src"), " "))).cast("bigint").alias("source_words"))
