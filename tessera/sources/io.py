"""Readers and writers.

Polymorphic JSON fields are read as STRING: Spark keeps a nested array or
object as its raw JSON text, so the normalisers parse them with
``from_json`` — no Python per row.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.functions.text import strip_ws
from tessera.plans.scale import running_sum

log = logging.getLogger(__name__)

AUDIO = "ARRAY<STRUCT<file: STRING, speaker: STRING>>"
RAW_ENTRY_SCHEMA = (
    "`na'vi` STRING, navi STRING, word STRING, en STRING, translations STRING, type STRING, "
    f"pronunciation ARRAY<STRUCT<audio: {AUDIO}>>"
)
MEDIA_EXTENSIONS = (".wav", ".mp3", ".ogg", ".flac", ".m4a")
MIN_DONE_BYTES = 100


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of raw entries; ``seq`` follows file order."""
    df = spark.read.schema(RAW_ENTRY_SCHEMA).option("multiLine", True).json(path)
    return _in_file_order(df)


def _in_file_order(df: DataFrame) -> DataFrame:
    """Add ``seq``, dense from 0: by file name, then position in the file.  A multi-line file
    is one split, so ids given in a task rise along each file; how files are dealt to tasks
    does not show."""
    columns = df.columns
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    # one row for each file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return placed.join(files, "_file").select(*columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("seq"))


def read_keyed_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects ``term → entry | [entries]``, one a file, read by as many tasks as the files have
    splits.  The key fills ``na'vi`` only when the entry lacks it; values that are not objects are
    dropped; of a key told twice the last value counts, at the first one's place.  ``seq`` follows
    file names and the order in each file."""
    pieces = (spark.read.option("lineSep", ",").text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                      F.monotonically_increasing_id().alias("nth"), "value"))
    return keyed_entries(pieces)


def _in_a_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Dense numbers from 0 over groups that are many and small, in the order of ``keys``."""
    before = running_sum(df.withColumn("_one", F.lit(1)), "_one", order, keys, name="_upto")
    return before.withColumn(name, F.col("_upto") - 1).drop("_one", "_upto")


def keyed_entries(pieces: DataFrame) -> DataFrame:
    """S2 for JSON text in pieces ``(file, start, nth, value)``: the text of each file cut at its commas, in
    the order of ``start`` and ``nth``.

    Which commas part entries follows from what is open at them: running sums over the pieces
    tell whether a piece begins inside a string and how deep it lies in brackets.  A piece that
    begins at depth 1 outside a string begins an entry, and the pieces up to the next one are
    put together again."""
    order = ["start", "nth"]
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    p = pieces.withColumn("_bare", bare).withColumn("_quotes", F.length(F.regexp_replace("_bare", r'(?s)[^"]+', "")))
    p = running_sum(p, "_quotes", order, ["file"], name="_upto")
    inside = (F.col("_upto") - F.col("_quotes")) % 2 == 1
    # from a quote on, if the piece begins in a string; then without strings, the last of which may stay open
    code = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), "_bare")).otherwise(F.col("_bare")), r'(?s)"[^"]*("|$)', "")
    p = p.withColumn("_in", inside).withColumn("_code", code)

    def count(chars: str):
        return F.length("_code") - F.length(F.translate("_code", chars, ""))

    p = p.withColumn("_deeper", count("{[") - count("}]")).drop("_bare", "_code", "_quotes", "_upto")
    p = running_sum(p, "_deeper", order, ["file"], name="_depth")
    begins = ~F.col("_in") & (F.col("_depth") - F.col("_deeper") <= 1)
    p = running_sum(p.withColumn("_begins", begins.cast("int")), "_begins", order, ["file"], name="entry")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "nth", "value"))), lambda x: x["value"]), ",")
    entries = p.groupBy("file", "entry").agg(text.alias("text"), F.min("_depth").alias("_least"))
    # the file's own brackets go with its first and last entry
    body = F.when(F.col("entry") == 1, F.regexp_replace("text", r"^[\s\x{FEFF}]*\{", "")).otherwise(F.col("text"))
    body = F.when(F.col("_least") <= 0, F.regexp_replace(body, r"\}\s*$", "")).otherwise(body)
    kv = entries.select("file", "entry", F.explode(F.from_json(F.concat(F.lit("{"), body, F.lit("}")), "map<string,string>")).alias("key", "raw"))
    kv = kv.groupBy("file", "key").agg(F.min("entry").alias("entry"), F.max_by("raw", "entry").alias("raw"))
    t = F.ltrim("raw")
    items = (F.when(F.startswith(t, F.lit("[")), F.from_json("raw", "array<string>"))
             .when(F.startswith(t, F.lit("{")), F.array("raw")))
    objects = kv.select("file", "entry", "key", F.posexplode(items).alias("i", "obj")).filter(F.ltrim("obj").startswith("{"))
    parsed = objects.select("file", "entry", "i", "key", F.from_json("obj", RAW_ENTRY_SCHEMA).alias("e"),
                            F.map_contains_key(F.from_json("obj", "map<string,string>"), F.lit("na'vi")).alias("_has"))
    out = parsed.select("file", "entry", "i", "key", "e.*", "_has").withColumn("na'vi", F.when(F.col("_has"), F.col("`na'vi`")).otherwise(F.col("key")))
    columns = [f"`{c}`" for c in out.columns if c not in ("file", "entry", "i", "key", "_has")]
    numbered = _in_a_row(out, ["file"], ["entry", "i"], "_at")
    files = out.groupBy("file").agg(F.count(F.lit(1)).alias("_rows"))
    # one row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return numbered.join(files, "file").select(*columns, (F.col("_before") + F.col("_at")).alias("seq"))


def read_pairs(spark: SparkSession, path: str, training: bool = True, sep: str = "\t") -> DataFrame:
    """S3: delimited pairs with a header and CSV quoting (``sep=","`` for the manifest): the
    columns ``navi`` and ``en`` or ``english`` are found by name, others are ignored, and a
    quoted field may hold line breaks.  The training read strips both sides and drops rows
    with an empty side."""
    df = (spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
          .option("multiLine", True).option("inferSchema", False).csv(path))
    names = {c.strip().lower(): c for c in df.columns}
    src, tgt = names.get("navi"), names.get("en") or names.get("english")
    if not src or not tgt:
        raise ValueError(f"no navi and en/english columns in {df.columns}")
    df = df.select(F.col(f"`{src}`").alias("src"), F.col(f"`{tgt}`").alias("tgt"))
    if training:
        df = (df.select(strip_ws(F.coalesce("src", F.lit(""))).alias("src"),
                        strip_ws(F.coalesce("tgt", F.lit(""))).alias("tgt"))
              .filter((F.col("src") != "") & (F.col("tgt") != "")))
    return df


def write_pairs(pairs: DataFrame, path: str) -> None:
    """TSV with header ``navi<TAB>en`` (UTF-8)."""
    (pairs.select(F.col("src").alias("navi"), F.col("tgt").alias("en"))
     .write.mode("overwrite").option("sep", "\t").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))


def read_manifest(spark: SparkSession, path: str, schema: str | None = None, array_file: bool = False) -> DataFrame:
    """Manifest records as JSON lines (or one JSON array with ``array_file``)."""
    r = spark.read.option("multiLine", array_file)
    if schema:
        r = r.schema(schema)
    return r.json(path)


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def list_media(spark: SparkSession, roots: Sequence[str], extensions: Sequence[str] = MEDIA_EXTENSIONS) -> DataFrame:
    """Recursive media listing over several roots (missing root → warning, skipped).

    Only ``path``, ``length`` and ``modificationTime`` are selected, so the
    binary content column is pruned and never read."""
    pattern = "(?i)\\.(" + "|".join(e.lstrip(".") for e in extensions) + ")$"
    parts = []
    for root in roots:
        try:  # Spark's file system decides, not the driver's disk
            df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        except AnalysisException:
            log.warning("media root does not exist: %s", root)
            continue
        name = os.path.basename(root.rstrip("/"))
        parts.append(df.select("path", "length", "modificationTime")
                     .filter(F.col("path").rlike(pattern))
                     .withColumn("source_dir", F.lit(name)))
    if not parts:
        return spark.createDataFrame([], "path STRING, length BIGINT, modificationTime TIMESTAMP, source_dir STRING")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recent_requests(log_df: DataFrame, n: int = 500, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The newest ``n`` rows (TakeOrderedAndProject: a per-partition top-n, then a merge)."""
    return log_df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def request_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The request log as a stream (file source; a Kafka source plugs in the same way)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One output directory per split value (overwrite replaces delete-and-rewrite)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Nested summary rows as JSON."""
    df.write.mode("overwrite").json(path)


def only_new(items: DataFrame, done: DataFrame, key: str | Sequence[str], size_col: str | None = None,
             min_bytes: int = MIN_DONE_BYTES) -> DataFrame:
    """Items without a finished output; outputs of at most ``min_bytes`` count as missing."""
    keys = [key] if isinstance(key, str) else list(key)
    d = done if size_col is None else done.filter(F.col(size_col) > min_bytes)
    return items.join(d.select(*keys).distinct(), keys, "left_anti")
