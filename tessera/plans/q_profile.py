"""Queries for profiles, baselines and quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import epoch_micros
from tessera.functions.text import fused_confidence
from tessera.operators import profile, quality
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.sqlparts import LOG, PAIRS, with_
from tessera.session import table


def _dist_sql(src: str, by: str, x: str) -> str:
    return f"""
SELECT {by}, round(avg(x), 3) AS mean, round(stddev_pop(x), 3) AS std,
       round(quantile_cont(x, 0.25), 3) AS p25, round(quantile_cont(x, 0.75), 3) AS p75,
       round(min(x), 3) AS min, round(max(x), 3) AS max, CAST(count(x) AS BIGINT) AS count
FROM (SELECT {by}, CAST({x} AS DOUBLE) AS x FROM {src}) GROUP BY {by}"""


@query("a2_distribution_n_chars", _dist_sql("documents", "lang", "n_chars"))
def a2_distribution_n_chars(spark, sf):
    """A2: document length distribution per language."""
    return profile.distribution_stats(table(spark, sf, "documents"), "n_chars", by=["lang"])


@query("a2_distribution_price", _dist_sql("lineitem", "l_returnflag", "l_extendedprice"))
def a2_distribution_price(spark, sf):
    """A2: line price distribution per return flag."""
    return profile.distribution_stats(table(spark, sf, "lineitem"), "l_extendedprice", by=["l_returnflag"])


@query("a3_media_summary", r"""
SELECT lang AS speaker, CAST(count(d) AS BIGINT) AS count, round(sum(d), 2) AS total_duration_s,
       round(avg(d), 3) AS mean_duration_s, round(stddev_pop(d), 3) AS std_duration_s,
       round(min(d), 3) AS min_duration_s, round(max(d), 3) AS max_duration_s
FROM (SELECT lang, n_chars / 1000.0 AS d FROM documents) GROUP BY lang""")
def a3_media_summary(spark, sf):
    """A3: media duration summary per speaker (documents as a manifest)."""
    return profile.media_summary(B.media_manifest(spark, sf), by=["speaker"])


@query("a4_speaker_counts", r"""
SELECT role AS speaker, CAST(count(*) AS BIGINT) AS items, CAST(count(DISTINCT conv_id) AS BIGINT) AS distinct_terms
FROM conversations GROUP BY role""")
def a4_speaker_counts(spark, sf):
    """A4: items and distinct terms per speaker (conversation roles)."""
    c = table(spark, sf, "conversations").select(F.col("role").alias("speaker"), F.col("conv_id").alias("term"))
    return profile.speaker_counts(c)


@query("a5_vector_moments", r"""
SELECT CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS dim FROM embeddings)
GROUP BY dim""")
def a5_vector_moments(spark, sf):
    """A5: element-wise mean/std of the embedding vectors."""
    return profile.vector_moments(table(spark, sf, "embeddings"), "embedding")


@query("a6_vector_bin_means", r"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, len(embedding) AS n FROM embeddings),
b AS (SELECT vec_id, e, n, unnest(range(0, 13)) AS bin FROM v),
s AS (SELECT vec_id, e, bin, n // 13 + CASE WHEN bin < n % 13 THEN 1 ELSE 0 END AS len,
             bin * (n // 13) + least(bin, n % 13) AS start FROM b)
SELECT vec_id, CAST(bin AS INTEGER) AS bin,
       CASE WHEN len > 0 THEN list_sum(e[start + 1:start + len]) / len ELSE 0.0 END AS bin_mean FROM s""")
def a6_vector_bin_means(spark, sf):
    """13 near-equal bin means per embedding vector."""
    return profile.vector_bin_means(table(spark, sf, "embeddings"), "embedding", ["vec_id"])


def _wer_words_sql(x: str) -> str:
    t = f"regexp_replace(regexp_replace({x}, '\\s\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
    return f"list_filter(string_split({t}, ' '), lambda w: length(w) >= 1)"


# Word-level edit distance in SQL: one recursive step per reference word; each
# DP row is min(prev+1, diagonal+cost) followed by a running minimum over j
# (insertions), i.e. cur[j] = min_k (t[k] + j - k).
WER_PAIRS_SQL = "WITH RECURSIVE " + PAIRS.strip() + f""",
pw AS (SELECT pair_id, user_id, {_wer_words_sql('reference')} AS r, {_wer_words_sql('hypothesis')} AS h
       FROM pairs WHERE regexp_replace(coalesce(reference, ''), '^\\s+|\\s+$', '', 'g') <> ''),
dp(pair_id, i, j, d) AS (
  SELECT pair_id, 0, j, j FROM (SELECT pair_id, unnest(range(0, len(h) + 1)) AS j FROM pw)
  UNION ALL
  SELECT pair_id, i, j, min(t - j) OVER (PARTITION BY pair_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + j
  FROM (SELECT x.pair_id, x.i + 1 AS i, x.j,
               CASE WHEN x.j = 0 THEN x.i + 1
                    ELSE least(x.d + 1, lag(x.d) OVER (PARTITION BY x.pair_id ORDER BY x.j)
                               + CASE WHEN pw.r[x.i + 1] = pw.h[x.j] THEN 0 ELSE 1 END) END AS t
        FROM dp x JOIN pw USING (pair_id) WHERE x.i < len(pw.r))),
pe AS (SELECT pw.pair_id, pw.user_id, CAST(dp.d AS BIGINT) AS edits, CAST(len(pw.r) AS BIGINT) AS ref_words
       FROM pw JOIN dp ON dp.pair_id = pw.pair_id AND dp.i = len(pw.r) AND dp.j = len(pw.h))
"""


@query("a7_word_error_rate", WER_PAIRS_SQL + """
SELECT round(CASE WHEN coalesce(sum(ref_words), 0) > 0 THEN sum(edits) / sum(ref_words) ELSE 1.0 END, 4) AS wer,
       CAST(coalesce(sum(edits), 0) AS BIGINT) AS edits, CAST(coalesce(sum(ref_words), 0) AS BIGINT) AS ref_words,
       CAST(count(*) AS BIGINT) AS pairs FROM pe""")
def a7_word_error_rate(spark, sf):
    """Corpus WER of adjacent conversation turns (whole texts; checked
    against a brute-force word DP in tests — DuckDB's levenshtein counts bytes)."""
    return quality.word_error_rate(B.text_pairs(spark, sf))


@query("a7_pair_errors", WER_PAIRS_SQL + "SELECT pair_id, edits, ref_words FROM pe")
def a7_pair_errors(spark, sf):
    """A7 per pair: word edits and reference words."""
    return quality.pair_errors(B.text_pairs(spark, sf)).select("pair_id", "edits", "ref_words")


def _bleu_tok_sql(x: str) -> str:
    t = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    t = f"replace({t}, '<skipped>', '')"
    t = f"replace({t}, '-' || chr(10), '')"
    t = f"replace({t}, chr(10), ' ')"
    for a, b in quality.BLEU_13A_ENTITIES:
        t = f"replace({t}, '{a}', '{b}')"
    t = f"(' ' || {t} || ' ')"
    for pat, rep in quality.BLEU_13A_RULES:
        t = f"regexp_replace({t}, '{pat}', '{rep.replace('$', chr(92))}', 'g')"
    return f"list_filter(string_split_regex({t}, '\\s+'), lambda x: x <> '')"


def _bleu_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    grams = []
    for side, col in (("h", "h"), ("r", "r")):
        for n in range(1, 5):
            grams.append(f"SELECT {g}pair_id, '{side}' AS side, {n} AS n, unnest(list_transform(range(0, len({col}) - {n} + 1), "
                         f"lambda i: array_to_string({col}[i + 1:i + {n}], ' '))) AS gram FROM tok")
    smooth, stop, logs = "1.0", "false", []
    for n in range(1, 5):
        tot, cor = f"total{n}", f"correct{n}"
        stop = f"({stop} OR {tot} = 0)"
        smooth_n = f"({smooth} * CASE WHEN {cor} = 0 THEN 2.0 ELSE 1.0 END)"
        prec = f"(CASE WHEN {stop} THEN 0.0 WHEN {cor} = 0 THEN 100.0 / ({smooth_n} * {tot}) ELSE 100.0 * {cor} / {tot} END)"
        smooth = f"(CASE WHEN {stop} THEN {smooth} ELSE {smooth_n} END)"
        logs.append(f"(CASE WHEN {prec} > 0 THEN ln({prec}) ELSE -9999999999.0 END)")
    bp = ("(CASE WHEN sys_len < ref_len THEN CASE WHEN sys_len > 0 THEN exp(1 - CAST(ref_len AS DOUBLE) / sys_len) "
          "ELSE 0.0 END ELSE 1.0 END)")
    score = f"{bp} * exp(({' + '.join(logs)}) / 4)"
    join_on = f"USING ({by})" if by else "ON true"
    hby = f"h.{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return with_(PAIRS, f"""
tok AS (SELECT {g}pair_id, {_bleu_tok_sql('reference')} AS r, {_bleu_tok_sql('hypothesis')} AS h FROM pairs),
grams AS ({' UNION ALL '.join(grams)}),
cnt AS (SELECT {g}pair_id, side, n, gram, count(*) AS c FROM grams GROUP BY ALL),
clip AS (SELECT {hby}h.n, sum(least(h.c, r.c)) AS correct
         FROM cnt h JOIN cnt r ON r.pair_id = h.pair_id AND r.n = h.n AND r.gram = h.gram AND r.side = 'r'
         WHERE h.side = 'h' GROUP BY {hby}h.n),
piv AS (SELECT {g}{', '.join(f'coalesce(sum(correct) FILTER (WHERE n = {n}), 0) AS correct{n}' for n in range(1, 5))}
        FROM clip {grp}),
tot AS (SELECT {g}{', '.join(f'sum(greatest(len(h) - {n} + 1, 0)) AS total{n}' for n in range(1, 5))},
        sum(len(h)) AS sys_len, sum(len(r)) AS ref_len FROM tok {grp}),
s AS (SELECT tot.*, {', '.join(f'coalesce(piv.correct{n}, 0) AS correct{n}' for n in range(1, 5))}
      FROM tot LEFT JOIN piv {join_on})
""") + f"""
SELECT {g}round({score} / 100.0, 4) AS bleu, round({bp}, 6) AS brevity_penalty,
       CAST(sys_len AS BIGINT) AS sys_len, CAST(ref_len AS BIGINT) AS ref_len FROM s"""


@query("a8_corpus_bleu", _bleu_sql(None))
def a8_corpus_bleu(spark, sf):
    """Corpus BLEU of adjacent conversation turns."""
    return quality.corpus_bleu(B.text_pairs(spark, sf))


@query("a9_sequence_confidence", r"""
WITH s AS (SELECT label, list_max(e) AS m, e FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
lp AS (SELECT label, m - (m + ln(list_sum(list_transform(e, lambda x: exp(x - m))))) AS lp FROM s)
SELECT label, round(least(1.0, greatest(0.0, exp(avg(lp)))), 3) AS confidence, CAST(count(*) AS BIGINT) AS steps
FROM lp GROUP BY label""")
def a9_sequence_confidence(spark, sf):
    """Per-sequence confidence from step logits (embeddings as logits, label as sequence)."""
    return quality.sequence_confidence(table(spark, sf, "embeddings"), ["label"], "embedding")


@query("a10_fused_confidence", with_(LOG) + r"""
SELECT event_id, round((confidence + least(latency_ms / 20000.0, 1.0)) / 2, 3) AS fused_confidence
FROM log WHERE input_type = 'audio'""")
def a10_fused_confidence(spark, sf):
    """A10: fused (ASR, translation) confidence of audio requests."""
    log = B.request_log(spark, sf).filter(F.col("input_type") == "audio")
    nmt = F.least(F.col("latency_ms") / 20000.0, F.lit(1.0))
    return log.select("event_id", fused_confidence(F.col("confidence"), nmt).alias("fused_confidence"))


@query("a11_resample_linear", r"""
WITH pts AS (SELECT event_type, epoch_us(ts) / 1000000.0 AS t, value AS v FROM events),
seg AS (SELECT event_type, t, v, lead(t) OVER w AS nt, lead(v) OVER w AS nv, min(t) OVER (PARTITION BY event_type) AS t0
        FROM pts WINDOW w AS (PARTITION BY event_type ORDER BY t)),
b AS (SELECT *, CAST(ceil((t - t0) / 3600.0) AS BIGINT) AS lo,
             CAST(CASE WHEN nt IS NULL THEN floor((t - t0) / 3600.0) ELSE ceil((nt - t0) / 3600.0) - 1 END AS BIGINT) AS hi FROM seg),
g AS (SELECT *, unnest(CASE WHEN hi >= lo THEN range(lo, hi + 1) ELSE []::BIGINT[] END) AS step_index FROM b)
SELECT event_type, step_index, round(t0 + step_index * 3600.0, 6) AS t,
       round(v + coalesce(nv - v, 0.0) * CASE WHEN nt IS NULL THEN 0.0 ELSE (t0 + step_index * 3600.0 - t) / (nt - t) END, 6) AS value
FROM g""")
def a11_resample_linear(spark, sf):
    """Hourly linear resampling of event values per event type."""
    ev = table(spark, sf, "events")
    e = ev.select("event_type", (epoch_micros(ev, "ts") / 1e6).alias("t"), "value")
    return profile.resample_linear(e, ["event_type"], "t", "value", 3600.0)


@query("a5_vector_moments_empty", """
SELECT CAST(d AS INTEGER) AS dim, CAST(0 AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS std, CAST((SELECT count(*) FROM embeddings WHERE label < 0) AS BIGINT) AS count
FROM range(0, 13) AS t(d)""")
def a5_vector_moments_empty(spark, sf):
    """A5 of no vectors: 13 zeros, count 0."""
    return profile.vector_moments(table(spark, sf, "embeddings").where("label < 0"), "embedding", dims=13)


@query("a9_sequence_confidence_all", r"""
WITH s AS (SELECT label, list_max(e) AS m, e FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label % 2 = 0)),
lp AS (SELECT label, m - (m + ln(list_sum(list_transform(e, lambda x: exp(x - m))))) AS lp FROM s),
c AS (SELECT label, round(least(1.0, greatest(0.0, exp(avg(lp)))), 3) AS confidence, CAST(count(*) AS BIGINT) AS steps FROM lp GROUP BY label)
SELECT label, coalesce(confidence, 0.5) AS confidence, coalesce(steps, 0) AS steps FROM (SELECT DISTINCT label FROM embeddings) LEFT JOIN c USING (label)""")
def a9_sequence_confidence_all(spark, sf):
    """Odd labels have no steps and get 0.5."""
    e = table(spark, sf, "embeddings")
    return quality.sequence_confidence(e.where("label % 2 = 0"), ["label"], "embedding", sequences=e)


@query("a9_sequence_confidence_none", "SELECT CAST(0.5 AS DOUBLE) AS confidence, CAST(count(*) AS BIGINT) AS steps FROM embeddings WHERE label < 0")
def a9_sequence_confidence_none(spark, sf):
    """A9 without a step."""
    return quality.sequence_confidence(table(spark, sf, "embeddings").where("label < 0"), [], "embedding")
