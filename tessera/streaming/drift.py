"""Drift of every micro-batch against a versioned baseline, safe under replays.

Everything lies below one folder on shared storage::

    baselines/version=N      one row: the A1 figures of the baseline corpus, and when it was published
    results/batch_id=N       one row: D1 of the micro-batch, the baseline's version, a reason
    ledger/batch_id=N/state=begun | done

A micro-batch first writes down which baseline it is judged by, then its result, then that it
is done.  A batch that comes again (a restart, a lost driver) finds its mark: if it is done
nothing happens, if it had only begun it is judged by the same baseline and its result is
overwritten in place.  So a replay neither adds a row nor changes one, and a baseline published
in between counts from the next batch on.  Readers see results that are done only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.drift import OOV_DRIFT_THRESHOLD, oov_drift_against
from tessera.operators.matching import tokenise
from tessera.operators.profile import oov_rate

BASELINE = "oov_rate double, total_tokens bigint, oov_tokens bigint, vocab_size bigint, published_at timestamp, version bigint"
LEDGER = "baseline_version bigint, batch_id bigint, state string"
RESULT = ("drift_detected boolean, baseline_oov double, live_oov double, oov_drift boolean, n_requests bigint, reason string, "
          "baseline_version bigint, checked_at timestamp, batch_id bigint")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def baselines(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/baselines", BASELINE)


def publish_baseline(folder: str, tokens: DataFrame, lex: DataFrame) -> int:
    """Store the A1 figures of a corpus as the next version; two publishers can't take the same one."""
    spark = tokens.sparkSession
    last = baselines(spark, folder).agg(F.max("version")).first()[0]
    version = 1 if last is None else last + 1
    (oov_rate(tokens, lex).select(F.coalesce("oov_rate", F.lit(0.0)).alias("oov_rate"), F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"),
                                  F.coalesce("oov_tokens", F.lit(0)).alias("oov_tokens"), "vocab_size", F.current_timestamp().alias("published_at"))
     .coalesce(1).write.mode("errorifexists").parquet(f"{folder}/baselines/version={version}"))
    return version


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/ledger", LEDGER)


def results(spark: SparkSession, folder: str) -> DataFrame:
    """One row for every micro-batch that is done."""
    done = ledger(spark, folder).where("state = 'done'").select("batch_id")
    return _read(spark, f"{folder}/results", RESULT).join(done, "batch_id", "left_semi")


def _mark(spark: SparkSession, folder: str, batch_id: int, state: str, version: int | None) -> None:
    row = spark.createDataFrame([(version,)], "baseline_version bigint")
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/ledger/batch_id={batch_id}/state={state}")


def judge_batch(batch: DataFrame, batch_id: int, lex: DataFrame, folder: str, text_col: str = "text", id_col: str = "request_id",
                threshold: float = OOV_DRIFT_THRESHOLD) -> None:
    """What ``stream_drift`` does with a micro-batch; may be called again with the same one."""
    spark = batch.sparkSession
    marks = {r["state"]: r["baseline_version"] for r in ledger(spark, folder).where(F.col("batch_id") == batch_id).collect()}
    if "done" in marks:
        return
    if "begun" in marks:
        version = marks["begun"]
    else:
        version = baselines(spark, folder).agg(F.max("version")).first()[0]
        _mark(spark, folder, batch_id, "begun", version)
    stored = baselines(spark, folder).where(F.col("version") == version).select("oov_rate").first() if version is not None else None
    n = batch.agg(F.count(F.lit(1)).alias("n_requests"))
    d = oov_drift_against(tokenise(batch, text_col, [id_col], lower=True), lex, stored and stored[0], threshold)
    reason = F.lit("no_baselines") if stored is None else F.when(F.col("n_requests") == 0, "no_requests")
    row = d.withColumn("_k", F.lit(1)).join(n.withColumn("_k", F.lit(1)), "_k").select(
        (F.col("oov_drift") & reason.isNull()).alias("drift_detected"), "baseline_oov", "live_oov", "oov_drift", "n_requests", reason.cast("string").alias("reason"),
        F.lit(version).cast("bigint").alias("baseline_version"), F.current_timestamp().alias("checked_at"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/results/batch_id={batch_id}")
    _mark(spark, folder, batch_id, "done", version)


def stream_drift(requests: DataFrame, lex: DataFrame, folder: str, checkpoint: str, text_col: str = "text", id_col: str = "request_id",
                 threshold: float = OOV_DRIFT_THRESHOLD, trigger: dict | None = None):
    """Judge every micro-batch of requests by D1 against the newest baseline of the folder.  Returns the
    started query; ``results`` reads what it has found."""
    def job(batch: DataFrame, batch_id: int) -> None:
        judge_batch(batch, batch_id, lex, folder, text_col, id_col, threshold)

    return (requests.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
