"""Queries over sources and sinks: what the readers make of text that Spark writes from the given
tables, into folders below the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import corpus, lexicon
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.q_corpus import _split_sql
from tessera.plans.sqlparts import LEX, LOG, with_
from tessera.session import ensure_checkpoint_dir, table
from tessera.sources import io
from tessera.streaming import jobs


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/source-{uuid.uuid4().hex}"


def _document(lines: DataFrame, first: str, last: str) -> str:
    """One text file: ``first``, the lines ``(o, line)`` in their order, each but the first after a comma, ``last``."""
    spark = lines.sparkSession
    least = lines.agg(F.min("o").alias("_least"))
    body = lines.join(least, F.lit(True), "left").select("o", F.concat(F.when(F.col("o") > F.col("_least"), ",\n").otherwise(""), "line").alias("line"))
    ends = spark.createDataFrame([(-1, first), (2**62, last)], "o bigint, line string")
    path = _folder(spark)
    body.unionByName(ends).repartition(1).sortWithinPartitions("o").select("line").write.option("lineSep", "\n").text(path)
    return path


def _gloss_json(n) -> Column:
    """The gloss as a string, as a list of its parts or as an object, by turns."""
    whole = F.to_json(F.array("gloss"))
    parts = F.to_json(F.split("gloss", "; "))
    return (F.when(n % 3 == 0, F.regexp_replace(whole, r"^\[|\]$", "")).when(n % 3 == 1, parts)
            .otherwise(F.to_json(F.struct(F.col("gloss").alias("en")))))


def _quoted(c: str) -> Column:
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


ENTRIES_SQL = with_(LEX) + """
SELECT CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS seq, term, gloss, term_type FROM lex"""


@query("s1_read_lexicon", ENTRIES_SQL)
def s1_read_lexicon(spark, sf):
    """A JSON array of entries with glosses as string, list and object, then L1."""
    lex = B.lexicon(spark, sf)
    entry = F.concat(F.lit('{"navi": '), _quoted("term"), F.lit(', "en": '), _gloss_json(F.length("term")), F.lit(', "type": '), _quoted("term_type"), F.lit("}"))
    path = _document(lex.select(F.col("seq").alias("o"), entry.alias("line")), "[", "]")
    return lexicon.normalise_lexicon(io.read_lexicon(spark, path)).select("seq", "term", "gloss", "term_type")


@query("s2_read_keyed_lexicon", with_(LEX, """
e AS (SELECT seq * 2 AS o, term, gloss, term_type FROM lex
      UNION ALL SELECT seq * 2 + 1, term || ', {2}', gloss, term_type FROM lex WHERE length(term) % 2 = 0)""") + """
SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS BIGINT) AS seq, term, gloss, term_type FROM e""")
def s2_read_keyed_lexicon(spark, sf):
    """A JSON object of entries: single ones, lists with a second entry of its own name (with comma and
    brackets in it) and a number that is dropped."""
    lex = B.lexicon(spark, sf)
    rest = F.concat(F.lit('"en": '), _gloss_json(F.length("term") + 1), F.lit(', "type": '), _quoted("term_type"), F.lit("}"))
    own = F.concat(F.lit("{\"na'vi\": "), F.regexp_replace(_quoted("term"), '"$', ', {2}"'), F.lit(", "), rest)
    value = F.when(F.length("term") % 2 == 0, F.concat(F.lit("[{"), rest, F.lit(", 5, "), own, F.lit("]"))).otherwise(F.concat(F.lit("{"), rest))
    path = _document(lex.select(F.col("seq").alias("o"), F.concat(_quoted("term"), F.lit(": "), value).alias("line")), "{", "}")
    return lexicon.normalise_lexicon(io.read_keyed_lexicon(spark, path)).select("seq", "term", "gloss", "term_type")


@query("s3_s4_pairs_round_trip", """
SELECT p_name || chr(9) || p_brand AS src, '"' || p_type || '", ' || chr(10) || p_size AS tgt FROM part WHERE p_size % 5 <> 0""")
def s3_s4_pairs_round_trip(spark, sf):
    """Pairs with tabs, quotes and line breaks written and read again; blank sides are dropped."""
    p = table(spark, sf, "part")
    target = F.concat(F.lit('"'), "p_type", F.lit('", \n'), F.col("p_size").cast("string"))
    path = _folder(spark)
    io.write_pairs(p.select(F.concat(F.lit(" "), "p_name", F.lit("\t"), "p_brand").alias("src"), F.when(F.col("p_size") % 5 == 0, " ").otherwise(target).alias("tgt")), path)
    return io.read_pairs(spark, path)


@query("s5_manifest_round_trip", """
SELECT doc_id AS item_id, round(n_chars / 1000.0, 6) AS duration_s, lang AS speaker, source AS source_dir FROM documents""")
def s5_manifest_round_trip(spark, sf):
    """Manifest records written and read again."""
    path = _folder(spark)
    io.write_manifest(B.media_manifest(spark, sf).drop("text"), path)
    return io.read_manifest(spark, path, "item_id BIGINT, duration_s DOUBLE, speaker STRING, source_dir STRING")


@query("s8_request_stream", with_(LOG) + """
SELECT input_type, status, CAST(count(*) AS BIGINT) AS requests, CAST(sum(event_id) AS BIGINT) AS ids FROM log GROUP BY 1, 2""")
def s8_request_stream(spark, sf):
    """Every request of the log once, through the stream."""
    log, path = B.request_log(spark, sf), _folder(spark)
    log.write.parquet(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema)
    seen = jobs.available_now(io.request_stream(spark, path, schema, 1).select("event_id", "input_type", "status"))
    return seen.groupBy("input_type", "status").agg(F.count(F.lit(1)).cast("bigint").alias("requests"), F.sum("event_id").cast("bigint").alias("ids"))


def _split(spark, sf):
    return corpus.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", "lang").select("doc_id", "lang", "split")


@query("s9_write_splits", f"SELECT doc_id, lang, split FROM ({_split_sql('lang')})")
def s9_write_splits(spark, sf):
    """One folder a split, read again."""
    path = _folder(spark)
    io.write_splits(_split(spark, sf), path)
    return spark.read.schema("doc_id BIGINT, lang STRING, split STRING").parquet(path)


@query("s10_write_summary", f"""
SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train, CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) AS val,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test, CAST(count(*) AS BIGINT) AS total FROM ({_split_sql('lang')})""")
def s10_write_summary(spark, sf):
    """A nested one-row summary, read again."""
    path = _folder(spark)
    n = F.struct(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")])
    io.write_summary(_split(spark, sf).agg(F.struct(n.alias("splits"), F.count(F.lit(1)).alias("total")).alias("text")), path)
    back = spark.read.schema("text STRUCT<splits: STRUCT<train: BIGINT, val: BIGINT, test: BIGINT>, total: BIGINT>").json(path)
    return back.select("text.splits.*", "text.total")
