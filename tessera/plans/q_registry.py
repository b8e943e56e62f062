"""Queries for drift (D1–D5) and the run/registry tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import corpus, drift, matching, registry
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.sqlparts import LEX, RUNS, tokens_of, with_
from tessera.session import table

HALF = "CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'baseline' ELSE 'live' END"


def _half():
    return F.when(F.substring("source", 4, 10).cast("int") < 10, "baseline").otherwise("live")


D1_CTES = with_(LEX, f"""
toks AS (SELECT {HALF} AS side, unnest({tokens_of('lower(text)')}) AS token FROM documents),
vocab AS (SELECT DISTINCT lower(term) AS token FROM lex),
r AS (SELECT side, count(*) FILTER (WHERE v.token IS NULL) / count(*) AS rate
      FROM toks t LEFT JOIN vocab v USING (token) GROUP BY side),
d1 AS (SELECT coalesce(max(rate) FILTER (WHERE side = 'baseline'), 0.0) AS baseline_oov,
              coalesce(max(rate) FILTER (WHERE side = 'live'), 0.0) AS live_oov FROM r)""")


@query("d1_oov_drift", D1_CTES + """
SELECT round(baseline_oov, 6) AS baseline_oov, round(live_oov, 6) AS live_oov,
       live_oov > baseline_oov * (1 + 0.15) AS oov_drift FROM d1""")
def d1_oov_drift(spark, sf):
    """OOV drift of the second half of sources against the first half."""
    d = table(spark, sf, "documents").withColumn("side", _half())
    toks = matching.tokenise(d, "text", ["side"], lower=True)
    return drift.oov_drift(toks, B.lexicon(spark, sf))


def _emb_long(spark, sf):
    e = table(spark, sf, "embeddings")
    side = F.when(F.col("label") < 5, "reference").otherwise("current")
    return drift.vector_long(e, "embedding", side)


D2_CTES = """
WITH lv AS (SELECT CAST(dim AS VARCHAR) AS "column", side, x AS value FROM (
      SELECT CASE WHEN label < 5 THEN 'reference' ELSE 'current' END AS side,
             unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS dim FROM embeddings)),
tot AS (SELECT "column", count(*) FILTER (WHERE side = 'reference') AS n_ref, count(*) FILTER (WHERE side = 'current') AS n_cur,
               stddev_pop(value) FILTER (WHERE side = 'reference') AS ref_std FROM lv GROUP BY 1),
pv AS (SELECT "column", value, count(*) FILTER (WHERE side = 'reference') AS nr,
              count(*) FILTER (WHERE side = 'current') AS nc FROM lv GROUP BY 1, 2),
cu AS (SELECT p."column", value, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc,
              lead(value) OVER (PARTITION BY p."column" ORDER BY value) AS nv, n_ref, n_cur, ref_std
       FROM pv p JOIN tot USING ("column")
       WINDOW w AS (PARTITION BY p."column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st AS (SELECT "column", n_ref, n_cur, ref_std, max(abs(cr / n_ref - cc / n_cur)) AS ks_stat,
              sum(coalesce(nv - value, 0.0) * abs(cr / n_ref - cc / n_cur)) AS w1 FROM cu GROUP BY ALL),
ed AS (SELECT "column", quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
       FROM lv WHERE side = 'reference' GROUP BY 1),
hb AS (SELECT lv."column", len(list_filter(edges, lambda e: e < value)) AS bin,
              count(*) FILTER (WHERE side = 'reference') AS br, count(*) FILTER (WHERE side = 'current') AS bc
       FROM lv JOIN ed USING ("column") GROUP BY 1, 2),
ps AS (SELECT h."column", sum((greatest(bc / n_cur, 0.0001) - greatest(br / n_ref, 0.0001))
                  * ln(greatest(bc / n_cur, 0.0001) / greatest(br / n_ref, 0.0001))) AS psi
       FROM hb h JOIN tot USING ("column") GROUP BY 1),
lam AS (SELECT s.*, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur))) * ks_stat AS l
        FROM st s),
pv2 AS (SELECT "column", CASE WHEN l < 0.001 THEN 1.0 ELSE least(1.0, greatest(0.0,
          2.0 * (SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * l * l)) FROM range(1, 101) AS t(k)))) END AS p FROM lam),
d2 AS (SELECT s."column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, s.ks_stat, p AS ks_pvalue,
              CASE WHEN ref_std > 0 THEN w1 / ref_std ELSE w1 END AS wasserstein_norm, coalesce(psi, 0.0) AS psi,
              p < 0.05 AS drifted
       FROM st s JOIN pv2 USING ("column") LEFT JOIN ps USING ("column"))
"""


@query("d2_column_drift", D2_CTES + """
SELECT "column", n_ref, n_cur, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue,
       round(wasserstein_norm, 6) AS wasserstein_norm, round(psi, 6) AS psi, drifted FROM d2""")
def d2_column_drift(spark, sf):
    """Per-dimension drift of embeddings (labels < 5 vs ≥ 5)."""
    return drift.column_drift(_emb_long(spark, sf))


D3_SQL = """
d3 AS (SELECT CAST(count(*) AS BIGINT) AS n_columns, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) AS n_drifted,
              CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE drifted) / count(*) ELSE 0.0 END AS drift_share FROM d2)"""


@query("d3_dataset_drift", D2_CTES.rstrip() + "," + D3_SQL + """
SELECT n_columns, n_drifted, round(drift_share, 6) AS drift_share, drift_share >= 0.5 AS dataset_drift FROM d3""")
def d3_dataset_drift(spark, sf):
    """D3: share of drifted embedding dimensions and the dataset verdict."""
    return drift.dataset_drift(drift.column_drift(_emb_long(spark, sf)))


D4_SQL = (D1_CTES.rstrip() + ",\n" + D2_CTES.strip().replace("WITH lv AS", "lv AS", 1).rstrip() + "," + D3_SQL
          + f""",
nreq AS (SELECT CAST(count(*) FILTER (WHERE {HALF} = 'live') AS BIGINT) AS n_requests FROM documents)
SELECT CASE WHEN n_requests = 0 THEN false
            ELSE (live_oov > baseline_oov * (1 + 0.15)) OR coalesce(drift_share >= 0.5, false) END AS drift_detected,
       round(baseline_oov, 6) AS baseline_oov, round(live_oov, 6) AS live_oov,
       live_oov > baseline_oov * (1 + 0.15) AS oov_drift, n_drifted, round(drift_share, 6) AS drift_share,
       drift_share >= 0.5 AS dataset_drift,
       CASE WHEN n_requests = 0 THEN 'no_requests' WHEN coalesce(n_columns, 0) = 0 THEN 'insufficient_data' END AS reason
FROM d1, d3, nreq""")


@query("d4_drift_report", D4_SQL)
def d4_drift_report(spark, sf):
    """Combined verdict (OOV drift or dataset drift) with reason codes."""
    d = table(spark, sf, "documents").withColumn("side", _half())
    toks = matching.tokenise(d, "text", ["side"], lower=True)
    oov = drift.oov_drift(toks, B.lexicon(spark, sf))
    ds = drift.dataset_drift(drift.column_drift(_emb_long(spark, sf)))
    n_req = d.filter(F.col("side") == "live").agg(F.count(F.lit(1)).cast("bigint").alias("n_requests"))
    return drift.drift_report(oov, ds, n_req)


def _d5_sql() -> str:
    from tessera.plans.q_corpus import _split_sql
    return with_(LEX, f"""
sp AS ({_split_sql('lang')}),
docs AS (SELECT d.*, sp.split FROM documents d JOIN sp USING (doc_id)),
toks AS (SELECT unnest({tokens_of('lower(text)')}) AS token FROM docs WHERE split = 'val'),
vocab AS (SELECT DISTINCT lower(term) AS token FROM lex),
o AS (SELECT count(*) AS total, count(*) FILTER (WHERE v.token IS NULL) AS oov FROM toks t LEFT JOIN vocab v USING (token)),
du AS (SELECT n_chars / 1000.0 AS x FROM docs WHERE split = 'train'),
ve AS (SELECT embedding FROM embeddings JOIN docs ON doc_id = vec_id WHERE split = 'train'),
vs AS (SELECT dim, avg(x) + 1.5 AS m, stddev_pop(x) AS s FROM (
         SELECT CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(0, len(embedding))) AS dim FROM ve) GROUP BY dim)""") + """
SELECT round(CASE WHEN o.total > 0 THEN o.oov / o.total ELSE 0.0 END, 4) AS oov_rate,
       CAST(o.total AS BIGINT) AS total_tokens, CAST(o.oov AS BIGINT) AS oov_tokens,
       CAST((SELECT count(*) FROM vocab) AS BIGINT) AS vocab_size,
       (SELECT round(avg(x), 3) FROM du) AS duration_mean, (SELECT round(stddev_pop(x), 3) FROM du) AS duration_std,
       (SELECT round(quantile_cont(x, 0.25), 3) FROM du) AS duration_p25,
       (SELECT round(quantile_cont(x, 0.75), 3) FROM du) AS duration_p75,
       (SELECT round(min(x), 3) FROM du) AS duration_min, (SELECT round(max(x), 3) FROM du) AS duration_max,
       (SELECT CAST(count(*) AS BIGINT) FROM du) AS duration_count,
       (SELECT string_agg(printf('%.4f', m + 0.0), ' ' ORDER BY dim) FROM vs) AS vector_mean,
       (SELECT string_agg(printf('%.4f', s), ' ' ORDER BY dim) FROM vs) AS vector_std,
       (SELECT CAST(count(*) AS BIGINT) FROM ve) AS vector_count
FROM o"""


@query("d5_baseline_snapshot", _d5_sql())
def d5_baseline_snapshot(spark, sf):
    """Baseline document — OOV on the validation split, duration stats on the
    training split, embedding moments of the training split (as text, means shifted by 1.5)."""
    d = table(spark, sf, "documents")
    split = corpus.stratified_split(d.select("doc_id", "lang"), "doc_id", "lang")
    docs = d.join(split.select("doc_id", "split"), "doc_id")
    val_toks = matching.tokenise(docs.filter(F.col("split") == "val"), "text", [], lower=True)
    train = docs.filter(F.col("split") == "train").select((F.col("n_chars") / 1000.0).alias("duration_s"))
    ids = docs.filter(F.col("split") == "train").select(F.col("doc_id").alias("vec_id"))
    vectors = table(spark, sf, "embeddings").join(ids, "vec_id", "left_semi")
    snap = drift.baseline_snapshot(val_toks, B.lexicon(spark, sf), train, "duration_s", vectors, "embedding")

    def text(c: str, add: float = 0.0):  # shifted, so that no rounded zero has a sign
        return F.array_join(F.transform(c, lambda x: F.format_string("%.4f", x + add)), " ").alias(c)

    return snap.select(*[c for c in snap.columns if c not in ("vector_mean", "vector_std")], text("vector_mean", 1.5), text("vector_std"))


# ------------------------------------------------------------------ registry
def _runs(spark, sf):
    return B.runs(spark, sf)


@query("g2_latest_in_stage", with_(RUNS) + """
SELECT model, max(version) AS version FROM runs WHERE stage = 'Production' GROUP BY model""")
def g2_latest_in_stage(spark, sf):
    """Latest Production version per model."""
    return registry.latest_in_stage(_runs(spark, sf)).select("model", "version")


def _gate_sql(kind: str) -> str:
    better = "old - new >= 0.01" if kind == "wer" else "new - old >= 0.01"
    return with_(RUNS, f"""
champ AS (SELECT model, arg_max(metric, version) AS old FROM runs WHERE stage = 'Production' GROUP BY model),
cand AS (SELECT model, arg_max(version, version) AS version, arg_max(metric, version) AS new
         FROM runs WHERE stage = 'Staging' GROUP BY model)""") + f"""
SELECT c.model, c.version, round(c.new, 6) AS metric, round(h.old, 6) AS champion_metric,
       CASE WHEN h.old IS NULL THEN true ELSE coalesce({better.replace('old', 'h.old').replace('new', 'c.new')}, false) END AS promote,
       CASE WHEN h.old IS NULL THEN 'no_champion'
            WHEN coalesce({better.replace('old', 'h.old').replace('new', 'c.new')}, false) THEN 'better' ELSE 'not_better' END AS reason
FROM cand c LEFT JOIN champ h USING (model)"""


def _gate(spark, sf, kind):
    runs = _runs(spark, sf)
    cand = registry.latest_in_stage(runs, "Staging").select("model", "version", "metric")
    champ = registry.latest_in_stage(runs).select("model", "metric")
    return registry.promotion_gate(cand, champ, kind)


@query("g1_promotion_gate_wer", _gate_sql("wer"))
def g1_promotion_gate_wer(spark, sf):
    """G1: WER gate (lower is better) of the newest Staging run against the champion."""
    return _gate(spark, sf, "wer")


@query("g1_promotion_gate_bleu", _gate_sql("bleu"))
def g1_promotion_gate_bleu(spark, sf):
    """G1: BLEU gate (higher is better)."""
    return _gate(spark, sf, "bleu")


@query("g3_archive_previous", with_(RUNS, """
cand AS (SELECT model, max(version) AS pv FROM runs WHERE stage = 'Staging' GROUP BY model)""") + """
SELECT r.model, r.version, CASE WHEN r.version = c.pv THEN 'Production'
                                WHEN c.pv IS NOT NULL AND r.stage = 'Production' THEN 'Archived' ELSE r.stage END AS stage
FROM runs r LEFT JOIN cand c USING (model)""")
def g3_archive_previous(spark, sf):
    """Registry snapshot after promoting each model's newest Staging run."""
    runs = _runs(spark, sf)
    promoted = registry.latest_in_stage(runs, "Staging").select("model", "version")
    return registry.archive_previous(runs, promoted).select("model", "version", "stage")


@query("g4_resolve_source", with_(RUNS, """
models AS (SELECT DISTINCT model_type AS model FROM runs UNION SELECT DISTINCT model FROM runs),
reg AS (SELECT model, max(version) AS registry_version FROM runs WHERE stage = 'Production' AND p_size > 40 GROUP BY model),
loc AS (SELECT DISTINCT model FROM runs WHERE metric > 0.5)""") + """
SELECT m.model, r.registry_version,
       CASE WHEN r.registry_version IS NOT NULL THEN 'registry' WHEN l.model IS NOT NULL THEN 'local' ELSE 'base' END AS source
FROM models m LEFT JOIN reg r USING (model) LEFT JOIN loc l USING (model)""")
def g4_resolve_source(spark, sf):
    """Model source resolution — registry, else local artifact, else base."""
    runs = _runs(spark, sf)
    models = runs.select(F.col("model_type").alias("model")).union(runs.select("model")).distinct()
    reg = runs.filter(F.col("p_size") > 40)
    local = runs.filter(F.col("metric") > 0.5)
    return registry.resolve_source(models, reg, local)


@query("g5_latest_run_by_tag", """
SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at
FROM events GROUP BY event_type""")
def g5_latest_run_by_tag(spark, sf):
    """Newest run (event) per tag value (event type)."""
    e = table(spark, sf, "events")
    out = registry.latest_run_by_tag(e, ["event_type"], "event_id", "ts", tie="event_id")
    return out.withColumn("started_at", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# ------------------------------------------------------------------ branches
_REASONS = {"no_baselines": ("false", "true", "true"), "no_requests": ("true", "false", "true"), "insufficient_data": ("true", "true", "false")}
_AT = "(SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events)"
_RATE = "(SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE v.token IS NULL) / count(*) ELSE 0.0 END FROM toks LEFT JOIN vocab v USING (token) WHERE side = '{}' AND {})"


def _reasons_sql() -> str:
    rows = []
    for reason, (base, live, _) in _REASONS.items():
        b, l_ = _RATE.format("baseline", base), _RATE.format("live", live)
        drift_ = "false" if reason != "insufficient_data" else f"{l_} > {b} * 1.15"
        rows.append(f"SELECT {drift_} AS drift_detected, round({b}, 6) AS baseline_oov, round({l_}, 6) AS live_oov, {drift_} AS oov_drift, "
                    f"'{reason}' AS reason, {_AT} AS checked_at")
    return with_(LEX, f"""toks AS MATERIALIZED (SELECT {HALF} AS side, unnest({tokens_of('lower(text)')}) AS token FROM documents),
vocab AS MATERIALIZED (SELECT DISTINCT lower(term) AS token FROM lex)""") + " UNION ALL ".join(rows)


@query("d4_drift_reasons", _reasons_sql())
def d4_drift_reasons(spark, sf):
    """Reports without a baseline, without requests and without a testable column, with their time."""
    d = table(spark, sf, "documents").withColumn("side", _half())
    lex, emb = B.lexicon(spark, sf), _emb_long(spark, sf)
    at = table(spark, sf, "events").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("checked_at"))
    out = None
    for base, live, columns in _REASONS.values():
        docs = d.where(f"(side = 'baseline' and {base}) or (side = 'live' and {live})")
        count = lambda side, name: docs.agg(F.count_if(F.col("side") == side).cast("bigint").alias(name))
        report = drift.drift_report(drift.oov_drift(matching.tokenise(docs, "text", ["side"], lower=True), lex),
                                    drift.dataset_drift(drift.column_drift(emb.where(columns))), count("live", "n_requests"), count("baseline", "n_baseline"), at)
        report = report.select("drift_detected", "baseline_oov", "live_oov", "oov_drift", "reason", "checked_at")
        out = report if out is None else out.unionByName(report)
    return out


def _new_champions_sql(kind: str, zero: bool) -> str:
    """Champions only of the models whose newest Production run has an odd version; some without a metric."""
    old = "coalesce(h.old, 0.0)" if zero else "h.old"
    old = f"CASE WHEN h.model IS NOT NULL THEN {old} END"
    better = f"({old}) - c.new >= 0.01" if kind == "wer" else f"c.new - ({old}) >= 0.01"
    return with_(RUNS, """
prod AS (SELECT model, max(version) AS version FROM runs WHERE stage = 'Production' GROUP BY model),
champ AS (SELECT model, CASE WHEN p.version % 3 <> 0 THEN metric END AS old FROM prod p JOIN runs USING (model, version) WHERE p.version % 2 = 1),
cand AS (SELECT model, max(version) AS version, arg_max(metric, version) AS new FROM runs WHERE stage = 'Staging' GROUP BY model)""") + f"""
SELECT c.model, c.version, round(c.new, 6) AS metric, round({old}, 6) AS champion_metric,
       CASE WHEN ({old}) IS NULL THEN true ELSE {better} END AS promote,
       CASE WHEN ({old}) IS NULL THEN 'no_champion' WHEN {better} THEN 'better' ELSE 'not_better' END AS reason
FROM cand c LEFT JOIN champ h USING (model)"""


def _register_gate(kind: str, zero: bool) -> None:
    def run(spark, sf):
        runs = _runs(spark, sf)
        cand = registry.latest_in_stage(runs, "Staging").select("model", "version", "metric")
        champ = registry.latest_in_stage(runs).where("version % 2 = 1").select("model", F.when(F.col("version") % 3 != 0, F.col("metric")).alias("metric"))
        return registry.promotion_gate(cand, champ, kind, missing_as_zero=zero)
    run.__doc__ = f"G1: {kind} gate where some models have no champion and some champions no metric{' (read as 0)' if zero else ''}."
    run.__name__ = f"g1_promotion_gate_{kind}_{'zero' if zero else 'new'}"
    query(run.__name__, _new_champions_sql(kind, zero))(run)


for _kind in ("wer", "bleu"):
    for _zero in (False, True):
        _register_gate(_kind, _zero)


@query("g4_resolve_source_all", with_(RUNS, """
models AS (SELECT DISTINCT model_type AS model FROM runs UNION SELECT DISTINCT model FROM runs),
reg AS (SELECT model, max(version) AS registry_version FROM runs WHERE stage = 'Production' AND p_size > 40 GROUP BY model),
loc AS (SELECT DISTINCT model_type AS model FROM runs WHERE length(model_type) % 2 = 0)""") + """
SELECT m.model, r.registry_version,
       CASE WHEN r.registry_version IS NOT NULL THEN 'registry' WHEN l.model IS NOT NULL THEN 'local' ELSE 'base' END AS source
FROM models m LEFT JOIN reg r USING (model) LEFT JOIN loc l USING (model)""")
def g4_resolve_source_all(spark, sf):
    """Models from the registry, local ones, and those that only have a base."""
    runs = _runs(spark, sf)
    models = runs.select(F.col("model_type").alias("model")).union(runs.select("model")).distinct()
    local = runs.where(F.length("model_type") % 2 == 0).select(F.col("model_type").alias("model"))
    return registry.resolve_source(models, runs.filter(F.col("p_size") > 40), local)
