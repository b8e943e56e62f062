"""Run / model-registry tables as set-at-a-time jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Promotion thresholds and metric directions.
PROMOTION_THRESHOLD = {"wer": 0.01, "bleu": 0.01}
LOWER_IS_BETTER = {"wer": True, "bleu": False}
PRODUCTION = "Production"
ARCHIVED = "Archived"


def latest_in_stage(versions: DataFrame, stage: str = PRODUCTION, model: str = "model",
                    version: str = "version") -> DataFrame:
    """Highest integer version per model in ``stage``."""
    v = versions.filter(F.col("stage") == stage)
    row = F.struct(*[F.col(c) for c in versions.columns])
    return v.groupBy(model).agg(F.max_by(row, F.col(version).cast("bigint")).alias("r")).select("r.*")


def promotion_gate(candidates: DataFrame, champions: DataFrame, metric_kind: str,
                   model: str = "model", metric: str = "metric", missing_as_zero: bool = False) -> DataFrame:
    """G1: promote when the candidate beats the champion by the threshold
    (lower-is-better for WER, higher for BLEU); no champion → promote.

    ``missing_as_zero`` reproduces reading a missing champion metric as 0;
    by default a champion without a metric counts as no champion."""
    thr = PROMOTION_THRESHOLD[metric_kind]
    champ = champions.select(F.col(model), F.col(metric).alias("champion_metric"),
                             F.lit(True).alias("_has_champion"))
    j = candidates.join(champ, model, "left")
    old = F.col("champion_metric")
    if missing_as_zero:
        old = F.when(F.col("_has_champion"), F.coalesce(old, F.lit(0.0)))
    new = F.col(metric)
    better = (old - new >= thr) if LOWER_IS_BETTER[metric_kind] else (new - old >= thr)
    promote = F.when(old.isNull(), F.lit(True)).otherwise(F.coalesce(better, F.lit(False)))
    reason = F.when(old.isNull(), "no_champion").when(promote, "better").otherwise("not_better")
    return j.select(*candidates.columns, old.alias("champion_metric"), promote.alias("promote"),
                    reason.alias("reason"))


def archive_previous(versions: DataFrame, promoted: DataFrame, model: str = "model",
                     version: str = "version") -> DataFrame:
    """New registry snapshot — promoted versions become Production and the
    other Production versions of the same model become Archived."""
    p = promoted.select(F.col(model), F.col(version).alias("_pv"))
    j = versions.join(p, model, "left")
    stage = (F.when(F.col(version) == F.col("_pv"), F.lit(PRODUCTION))
             .when(F.col("_pv").isNotNull() & (F.col("stage") == PRODUCTION), F.lit(ARCHIVED))
             .otherwise(F.col("stage")))
    return j.withColumn("stage", stage).drop("_pv")


def resolve_source(models: DataFrame, registry: DataFrame, local: DataFrame, model: str = "model") -> DataFrame:
    """Registry if the model has a Production version, else local, else base."""
    reg = latest_in_stage(registry).select(F.col(model), F.col("version").alias("registry_version"))
    loc = local.select(F.col(model)).distinct().withColumn("_local", F.lit(True))
    j = models.join(reg, model, "left").join(loc, model, "left")
    src = (F.when(F.col("registry_version").isNotNull(), "registry")
           .when(F.col("_local"), "local").otherwise("base"))
    return j.select(*models.columns, "registry_version", src.alias("source"))


def latest_run_by_tag(runs: DataFrame, tag_cols: Sequence[str], run_col: str, ts: str,
                      tie: str | None = None) -> DataFrame:
    """Newest run per tag value (``max_by`` with partial aggregation)."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    return runs.groupBy(*tag_cols).agg(F.max_by(run_col, order).alias(run_col), F.max(ts).alias("started_at"))
