"""Registered queries of the training-data operators.

Each applies one operator with production parameters to its whole table and derives
the digest columns of its contract from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import centroids, infill, langid, licenses, neighbours, packing, pieces, pii, quality, shards, simhash, substrings, toxicity
from tessera.llm.common import fold, materialise, pieces_path, table

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, then decode the ids."""
    path = pieces_path(PIECES)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.decode(pieces.encode(docs, path), path)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"))


def span_text(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find personal data in every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *map(count, pii.BASE),
        sha256(F.array_join(F.transform(base, span_text), ",")).alias("base_sha256"),
        F.array_join(F.transform("spans", span_text), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenise, cut and pack every document into sequences of 4096 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces_ = packing.cut(docs, pieces_path(WORDS))
    light = materialise(pieces_.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packing.pack(light)


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the rows with a language outside fold 2 of 4."""
    return langid.fit(docs.where(fold(F.col("doc_id"), 4) != 2), pieces_path(PIECES))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    told = langid.identify(docs, language_model(docs))
    return told.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                       F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take out of every document what an earlier one holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substrings.remove_repeats(docs)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_words", n_removed.alias("n_removed"), sha256(F.col("kept")).alias("kept_sha256"))


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "outlier", F.round("distance", 3).alias("distance"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and signatures of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text; labels are learned outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 3) != 1)
    grammar = toxicity.fit(docs, labels)
    return toxicity.score(docs, grammar).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all vectors, five rounds."""
    return centroids.described(centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut every text at line ends and put the suffix before the middle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = infill.transform(docs).select("doc_id", "infill.*")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"),
                      sha256(infill.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query
def op12_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every text's ids into shards and read the documents back from the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    written = shards.write(docs, pieces_path(BYTES))
    return shards.read(written, docs.schema["doc_id"].dataType.simpleString()).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


ORACLE_SQL["op5_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
early AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN early USING (k) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


ORACLE_SQL["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
e AS (SELECT *, CAST(len(u) AS BIGINT) AS n,
             list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS g FROM d),
f AS (SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 100 THEN 'plain'
                  WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


def _rounds_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Lloyd's rounds one after another: centroids ``c0``, assignments ``a0``, centroids ``c1`` ..."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT row, min(d * 64 + cluster) % 64 AS cluster, min(d * 64 + cluster) // 64 AS distance FROM (
  SELECT row, cluster, list_sum(list_transform(generate_series(1, {dim}), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::HUGEINT AS d FROM x, c{r}) GROUP BY row)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(s.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
  SELECT cluster, list(z ORDER BY i) AS m FROM (
    SELECT cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS z
    FROM a{r} JOIN x USING (row), generate_series(1, {dim}) AS g(i) GROUP BY cluster, i) GROUP BY cluster) s USING (cluster))""")
    return f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS BIGINT) AS cluster, v AS m
  FROM x QUALIFY cluster < {k}),
{", ".join(steps)},
t AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, cluster_inertia,
       (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM t) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN x USING (row) JOIN t USING (cluster) JOIN c{rounds} USING (cluster)"""


ORACLE_SQL["op11_centroid_clustering"] = _rounds_sql()
