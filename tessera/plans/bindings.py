"""Bindings of the driver tables to the shapes the jobs expect.

Each binding is a plain DataFrame derivation of the given tables, so every
registered query's work grows with the data.  The DuckDB oracles in
``tessera.plans.sqlparts`` restate the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import word_tokens
from tessera.session import table


def _packed(high: str, low):
    """Two whole numbers in one: the low one has 32 bits to itself."""
    return F.shiftleft(F.col(high).cast("bigint"), 32) + low


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """B1: ``(seq, term, gloss, term_type)`` from benchmark tokens."""
    b = table(spark, sf, "benchmark").select("item_id", "text")
    toks = b.select("item_id", F.posexplode(word_tokens(F.lower("text"))).alias("p", "tok"))
    terms = toks.select(_packed("item_id", F.col("p") + 1).alias("seq"),
                        F.regexp_replace("tok", "[^a-z]", "").alias("term")).filter(F.col("term") != "")
    first = terms.groupBy("term").agg(F.min("seq").alias("seq"))
    return first.select(
        "seq", "term",
        F.concat(F.col("term"), F.lit("-g; alt "), F.col("term")).alias("gloss"),
        F.concat(F.lit("len"), F.length("term").cast("string")).alias("term_type"))


def rich_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """B1 with what real dictionaries hold: terms told twice with another gloss, in brackets
    with a stress mark, or with a capital (before the plain entry)."""
    lex = lexicon(spark, sf)
    n = F.length("term")
    entries = F.array_compact(F.array(
        F.struct("seq", "term", "gloss"),
        F.when(n % 2 == 0, F.struct((F.col("seq") + 1000000).alias("seq"),
                                    F.concat(F.lit("["), F.substring("term", 1, 1), F.lit("]/"), F.expr("substring(term, 2)")).alias("term"),
                                    F.concat("term", F.lit("-second; more")).alias("gloss"))),
        F.when(n % 3 == 0, F.struct((F.col("seq") - 1000000).alias("seq"), F.initcap("term").alias("term"),
                                    F.concat("term", F.lit("-first")).alias("gloss")))))
    return lex.select(F.explode(entries).alias("e"), "term_type").select("e.*", "term_type")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """B2: ``(request_id, user_id, text)`` from user turns of conversations."""
    c = table(spark, sf, "conversations")
    return (c.filter(F.col("role") == "user")
            .select(_packed("conv_id", F.col("turn")).alias("request_id"),
                    (F.col("conv_id") % 50).alias("user_id"), "text"))


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Request log rows from events."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type").isin("click", "view"), "audio").otherwise("text").alias("input_type"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") * 40.0).alias("latency_ms"),
        (k / 100.0).alias("confidence"),
        ((k % 3) == 0).alias("missed"),
        (F.col("event_type") == "signup").alias("is_submission"))


def text_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(reference, hypothesis) = text of turn t and t+1 of a conversation."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis"))
    return (c.join(nxt, ["conv_id", "turn"])
            .select(_packed("conv_id", F.col("turn")).alias("pair_id"),
                    (F.col("conv_id") % 50).alias("user_id"),
                    F.col("text").alias("reference"), "hypothesis"))


def media_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a media manifest."""
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("item_id"), (F.col("n_chars") / 1000.0).alias("duration_s"),
                    F.col("lang").alias("speaker"), F.col("source").alias("source_dir"), "text")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run / registry table from part."""
    p = table(spark, sf, "part")
    return p.select(F.col("p_brand").alias("model"), F.col("p_partkey").alias("version"),
                    F.when(F.col("p_size") % 3 == 0, "Production").otherwise("Staging").alias("stage"),
                    ((F.col("p_retailprice") / 1000.0) % 1.0).alias("metric"),
                    F.col("p_type").alias("model_type"), F.col("p_size").alias("p_size"))
