"""Lexicon load and cleaning jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import canonical_form, slug_ascii, slug_speaker, strip_ws

# request/submission limits and media rules of the service.
TEXT_MAX_CHARS = 500
TERM_MAX_CHARS = 100
GLOSS_MAX_CHARS = 200
ALLOWED_MEDIA_TYPES = ("audio/wav", "audio/mpeg", "audio/ogg", "audio/x-wav", "audio/wave")
ALLOWED_MEDIA_SUFFIXES = (".wav", ".mp3", ".ogg")
MAX_MEDIA_BYTES = 30 * 16000 * 4
MIN_DURATION_S = 0.3
MAX_DURATION_S = 10.0


def _nonblank(c):
    return F.nullif(c, F.lit(""))


def _json_kind(c):
    """'list' / 'object' / 'string' for a field read as raw JSON text."""
    t = F.ltrim(c)
    is_list = F.startswith(t, F.lit("[")) & F.from_json(c, "array<string>").isNotNull()
    is_obj = F.startswith(t, F.lit("{")) & F.from_json(c, "map<string,string>").isNotNull()
    return F.when(c.isNull(), F.lit(None)).when(is_list, "list").when(is_obj, "object").otherwise("string")


def normalise_lexicon(raw: DataFrame, seq_col: str | None = "seq") -> DataFrame:
    """L1: polymorphic raw entries → ``(seq, term, gloss, term_type)``.

    ``raw`` carries ``na'vi``/``navi``/``word`` (strings), ``en`` and
    ``translations`` as raw JSON text (string, list or object) and ``type``.
    Rows without a term or a gloss are dropped.
    """
    cols = set(raw.columns)

    def col(name):
        return F.col(f"`{name}`") if name in cols else F.lit(None).cast("string")

    df = raw if (seq_col and seq_col in cols) else raw.withColumn("seq", F.monotonically_increasing_id())
    seq = F.col(seq_col) if (seq_col and seq_col in cols) else F.col("seq")
    term = strip_ws(F.coalesce(_nonblank(col("na'vi")), _nonblank(col("navi")), col("word"), F.lit("")))

    en = col("en")
    kind = _json_kind(en)
    en_list = F.transform(F.from_json(en, "array<string>"), strip_ws)
    gloss_en = (F.when(kind == "string", strip_ws(en))
                .when(kind == "list", F.array_join(F.filter(en_list, lambda x: x != ""), "; "))
                .when(kind == "object", strip_ws(F.get_json_object(en, "$.en"))))
    tr = col("translations")
    tkind = _json_kind(tr)
    tr_list = F.transform(F.from_json(tr, "array<string>"),
                          lambda x: strip_ws(F.coalesce(F.get_json_object(x, "$.en"), F.lit(""))))
    gloss_tr = (F.when(tkind == "list", F.array_join(F.filter(tr_list, lambda x: x != ""), "; "))
                .when(tkind == "object", strip_ws(F.get_json_object(tr, "$.en"))))
    gloss = F.coalesce(_nonblank(F.coalesce(gloss_en, F.lit(""))), gloss_tr, F.lit(""))
    typ = F.coalesce(_nonblank(col("type")), F.lit("unknown"))
    out = df.select(seq.cast("bigint").alias("seq"), term.alias("term"), gloss.alias("gloss"),
                    typ.alias("term_type"))
    return out.filter((F.col("term") != "") & (F.col("gloss") != ""))


def validate_lexicon(lex: DataFrame) -> DataFrame:
    """L2: strip fields, blank type → ``unknown``, tag rejects with a reason.

    Accepted rows have ``reason`` null; ``reason_counts`` summarises."""
    t = strip_ws(F.coalesce(F.col("term"), F.lit("")))
    g = strip_ws(F.coalesce(F.col("gloss"), F.lit("")))
    ty = strip_ws(F.coalesce(F.col("term_type"), F.lit("")))
    return lex.select(
        "seq", t.alias("term"), g.alias("gloss"),
        F.when(ty == "", "unknown").otherwise(ty).alias("term_type"),
        F.when(t == "", "empty_term").when(g == "", "empty_gloss").alias("reason"))


def reason_counts(tagged: DataFrame, reason_col: str = "reason") -> DataFrame:
    return (tagged.groupBy(F.coalesce(F.col(reason_col), F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def enrich_lexicon(raw: DataFrame) -> DataFrame:
    """L3: copy ``na'vi`` into ``navi`` when missing; gloss = first translation's ``en``."""
    cols = set(raw.columns)
    navi = F.coalesce(F.col("navi") if "navi" in cols else F.lit(None), F.col("`na'vi`"))
    first_en = F.get_json_object(F.col("translations"), "$[0].en")
    has_tr = F.coalesce(F.size(F.from_json(F.col("translations"), "array<string>")), F.lit(0)) > 0
    en = F.when(has_tr, F.coalesce(first_en, F.col("en"), F.lit(""))).otherwise(F.col("en"))
    return raw.withColumn("navi", navi).withColumn("en", en)


def build_lookup(lex: DataFrame) -> DataFrame:
    """Keys ``lower(term)`` and ``lower(canonical_form(term))`` per entry.

    Gloss = last writer, ``pos`` = first insertion (entries in ``seq`` order,
    raw key before canonical key)."""
    keys = F.array(
        F.struct(F.lower(F.col("term")).alias("key"), (F.col("seq") * 2).alias("ord")),
        F.struct(F.lower(canonical_form(F.col("term"))).alias("key"), (F.col("seq") * 2 + 1).alias("ord")))
    exploded = lex.select(F.explode(keys).alias("k"), "gloss").select("k.key", "k.ord", "gloss")
    return exploded.groupBy("key").agg(F.max_by("gloss", "ord").alias("gloss"),
                                       F.min("ord").alias("pos"))


def first_entry_by_term(lex: DataFrame) -> DataFrame:
    entry = F.struct("seq", "term", "gloss", "term_type")
    return (lex.groupBy(F.lower("term").alias("lkey"))
            .agg(F.min_by(entry, F.col("seq")).alias("e"))
            .select("lkey", "e.*"))


def lookup_exact(words: DataFrame, lex: DataFrame, word_col: str = "word") -> DataFrame:
    """Case-insensitive lookup on ``lower(strip(word))``; first entry wins."""
    first = first_entry_by_term(lex).select("lkey", F.col("term").alias("match_term"),
                                            F.col("gloss").alias("match_gloss"),
                                            F.col("term_type").alias("match_type"))
    return (words.withColumn("lkey", F.lower(strip_ws(F.col(word_col))))
            .join(first, "lkey", "left").drop("lkey"))


def explode_pronunciations(raw: DataFrame) -> DataFrame:
    """One row per audio file of each entry's pronunciations."""
    cols = set(raw.columns)
    navi = F.coalesce(_nonblank(F.col("`na'vi`")) if "na'vi" in cols else F.lit(None),
                      _nonblank(F.col("navi")) if "navi" in cols else F.lit(None))
    typ = F.coalesce(F.col("type"), F.lit("x"))
    step = (raw.select(navi.alias("term"), typ.alias("word_type"),
                       F.explode("pronunciation").alias("p"))
            .filter(F.col("term").isNotNull())
            .select("term", "word_type", F.explode("p.audio").alias("a")))
    speaker = F.coalesce(F.col("a.speaker"), F.lit("unknown"))
    return (step.filter(F.coalesce(F.col("a.file"), F.lit("")) != "")
            .select("term", speaker.alias("speaker"), "word_type",
                    F.col("a.file").alias("remote_file"),
                    slug_speaker(F.col("term"), speaker, F.col("word_type")).alias("local_stem")))


def slug_collisions(df: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Slugs shared by more than one item (the reference overwrites silently)."""
    return (df.select(slug_ascii(F.col(name_col)).alias("slug"), F.col(id_col).alias("id"))
            .groupBy("slug")
            .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
            .filter(F.col("n") > 1))


def validate_requests(df: DataFrame, id_col: str) -> DataFrame:
    """One row per (item, failed rule) for the request/response limits."""
    cols = set(df.columns)
    rules = []
    if "text" in cols:
        n = F.length("text")
        rules += [F.when(F.col("text").isNull() | (n < 1), "text_empty"),
                  F.when(n > TEXT_MAX_CHARS, "text_too_long")]
    if "term" in cols:
        n = F.length("term")
        rules += [F.when(F.col("term").isNull() | (n < 1), "term_empty"),
                  F.when(n > TERM_MAX_CHARS, "term_too_long")]
    if "gloss" in cols:
        n = F.length("gloss")
        rules += [F.when(F.col("gloss").isNull() | (n < 1), "gloss_empty"),
                  F.when(n > GLOSS_MAX_CHARS, "gloss_too_long")]
    if "confidence" in cols:
        c = F.col("confidence")
        rules += [F.when((c < 0) | (c > 1), "confidence_out_of_range")]
    reasons = F.array_compact(F.array(*rules))
    return df.select(F.col(id_col), F.explode(reasons).alias("reason"))


def media_gate(df: DataFrame, content_type: str, filename: str, n_bytes: str) -> DataFrame:
    """415 for an unsupported type (unless the name ends in an audio suffix),
    413 above the byte limit, else 200."""
    ct = F.coalesce(F.col(content_type), F.lit(""))
    suffix_ok = F.lit(False)
    for s in ALLOWED_MEDIA_SUFFIXES:
        suffix_ok = suffix_ok | F.endswith(F.col(filename), F.lit(s))
    bad_type = (ct != "") & ~ct.isin(*ALLOWED_MEDIA_TYPES) & ~suffix_ok
    status = (F.when(bad_type, 415).when(F.col(n_bytes) > MAX_MEDIA_BYTES, 413).otherwise(200))
    return df.withColumn("status", status.cast("int"))


def duration_filter(df: DataFrame, duration_col: str, min_s: float = MIN_DURATION_S,
                    max_s: float = MAX_DURATION_S) -> DataFrame:
    """Tag each row ``ok`` / ``too_short`` / ``too_long`` / ``unknown_duration`` (null:
    the file could not be read); keep with ``reason == 'ok'``."""
    d = F.col(duration_col)
    return df.withColumn("reason", F.when(d.isNull(), "unknown_duration").when(d < min_s, "too_short").when(d > max_s, "too_long").otherwise("ok"))
