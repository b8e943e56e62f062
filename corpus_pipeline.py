"""From raw documents to packed training sequences.

Five stages, each one operator applied to everything its predecessor kept: language
identification, SimHash near-duplicates, repeated passages, personal data, packing.  All but
the last return the columns of ``documents``; where a text changes, ``n_chars`` follows.

Null and empty texts have no language and go in the first stage.  Rows with a null id are
kept like others; of rows that repeat one another one stays.  Extra columns are passed
through, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, packing, pii, simhash, substrings
from tessera.llm.common import materialise, pieces_path, release, table
from tessera.llm.queries import WORDS, language_model

#: A text stays if the posterior of its language is at least this.
SURE = 0.5
#: Rows of a batch that goes to a Python worker, and bytes of a chunk and of a slice of texts: stages follow one another in
#: the same executors, whose memory they share with what the ones before have left.
BATCH, CHUNK, SLICE = 1000, 4 << 20, 2 << 20
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _apart(docs: DataFrame) -> DataFrame:
    """Columns beside id and text under names that no operator uses."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names)


def _back(df: DataFrame, docs: DataFrame, changed=None) -> DataFrame:
    """The columns of ``docs`` again, ``n_chars`` counted anew where a text has changed."""
    out = []
    for i, c in enumerate(docs.columns):
        own = F.col(c) if c in ("doc_id", "text") else F.col(f"__c{i}")
        if c == "n_chars" and changed is not None:
            own = F.when(changed, F.length("text")).otherwise(own).cast(docs.schema[c].dataType)
        out.append(own.alias(c))
    return df.select(*out)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and those of no clear language go."""
    told = langid.identify(_apart(docs), language_model(docs), out="__told")
    sure = (F.col("__told.lang") != langid.UNDETERMINED) & (F.col("__told.score") >= SURE)
    return _back(told.where(sure), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return _back(simhash.representatives(_apart(docs)), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; texts of which nothing is left go.
    Texts without such a passage stay as they are, white space included."""
    done = substrings.remove_repeats(_apart(docs), chunk=CHUNK)
    cut = F.size("removed") > 0
    done = done.where(~(cut & (F.col("kept") == ""))).withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text")))
    return _back(done, docs, cut)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    return _back(pii.redact(_apart(docs)), docs, F.lit(True))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 ids."""
    pieces = packing.cut(docs, pieces_path(WORDS), most=SLICE)
    return packing.pack(materialise(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.conf.get(ROWS)
    spark.conf.set(ROWS, str(BATCH))
    try:
        docs, written = table(spark, sf_dir, "documents"), None
        for _, stage in STAGES[:-1]:
            before, docs = written, materialise(stage(spark, docs, sf_dir))
            written = docs
            if before is not None:  # the next stage's rows are written: nothing reads these any more
                release(before)
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        spark.conf.set(ROWS, rows)
