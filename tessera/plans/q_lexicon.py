"""Queries for lexicon loading/cleaning (L1–L17), sources (S7, S11) and U1."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import (
    TERM_CHARSET,
    canonical_form,
    clean_gloss,
    clean_oov_word,
    client_id,
    in_charset,
    primary_gloss,
    slug_ascii,
    slug_speaker,
)
from tessera.operators import lexicon, matching, scoring
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.q_matching import _lookup, clean_sql
from tessera.plans.sqlparts import LEX, REQUESTS, tokens_of, with_
from tessera.session import table
from tessera.sources import io


def _raw_lexicon(spark, sf):
    """Raw polymorphic entries derived from the lexicon: ``en`` as string, list
    or object, or only a ``translations`` list (kind = seq mod 4)."""
    lex = B.lexicon(spark, sf)
    kind = F.col("seq") % 4
    parts = F.split("gloss", "; ")
    en = (F.when(kind == 0, F.col("gloss"))
          .when(kind == 1, F.to_json(parts))
          .when(kind == 2, F.to_json(F.struct(F.col("gloss").alias("en")))))
    tr = F.when(kind == 3, F.to_json(F.transform(parts, lambda p: F.struct(p.alias("en"), F.lit("x").alias("de")))))
    return lex.select("seq", F.col("term").alias("na'vi"), en.alias("en"), tr.alias("translations"),
                      F.col("term_type").alias("type"))


@query("l1_normalise_lexicon", with_(LEX) + "SELECT seq, term, gloss, term_type FROM lex")
def l1_normalise_lexicon(spark, sf):
    """L1: polymorphic raw entries (string / list / object gloss, translations) → flat lexicon."""
    return lexicon.normalise_lexicon(_raw_lexicon(spark, sf))


@query("l2_validate_lexicon", """
SELECT CASE WHEN t = '' THEN 'empty_term' WHEN g = '' THEN 'empty_gloss' ELSE 'accepted' END AS reason,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT regexp_replace(coalesce(CASE WHEN p_partkey % 11 = 0 THEN '  ' WHEN p_partkey % 13 <> 0 THEN p_name END, ''), '^\\s+|\\s+$', '', 'g') AS t,
             regexp_replace(coalesce(CASE WHEN p_partkey % 7 <> 0 THEN p_type END, ''), '^\\s+|\\s+$', '', 'g') AS g FROM part) GROUP BY 1""")
def l2_validate_lexicon(spark, sf):
    """L2: validation reasons over part rows read as lexicon entries, some with blank or missing fields."""
    i = F.col("p_partkey")
    p = table(spark, sf, "part").select(i.alias("seq"), F.when(i % 11 == 0, "  ").when(i % 13 != 0, F.col("p_name")).alias("term"),
                                        F.when(i % 7 != 0, F.col("p_type")).alias("gloss"), F.col("p_brand").alias("term_type"))
    return lexicon.reason_counts(lexicon.validate_lexicon(p))


@query("l3_enrich_lexicon", with_(LEX) + """
SELECT seq, term AS navi, CASE seq % 4 WHEN 3 THEN split_part(gloss, '; ', 1) WHEN 0 THEN gloss
                               WHEN 1 THEN CAST(to_json(string_split(gloss, '; ')) AS VARCHAR)
                               ELSE CAST(to_json({'en': gloss}) AS VARCHAR) END AS en
FROM lex""")
def l3_enrich_lexicon(spark, sf):
    """L3: alternative normaliser — gloss = first translation's ``en``, else the entry's own
    ``en`` as it stands (string, list or object)."""
    return lexicon.enrich_lexicon(_raw_lexicon(spark, sf)).select("seq", "navi", "en")


@query("l4_canonical_form", r"""
SELECT page_id, regexp_replace(translate(url, '[]/', ''), '^\s+|\s+$', '', 'g') AS canonical FROM pages""")
def l4_canonical_form(spark, sf):
    """L4: canonical form (drop [ ] /, strip) of page URLs."""
    return table(spark, sf, "pages").select("page_id", canonical_form(F.col("url")).alias("canonical"))


def _charset_class_sql() -> str:
    cls = "".join("\\" + c if c in "\\[]^-" else c for c in TERM_CHARSET).replace("'", "''")
    return f"'^[{cls}]*$'"


@query("l5_in_charset", with_(REQUESTS, f"""
toks AS (SELECT request_id, unnest(t) AS token, unnest(range(0, len(t))) AS pos
         FROM (SELECT request_id, {tokens_of('text')} AS t FROM requests))""") + f"""
SELECT request_id, CAST(pos AS INTEGER) AS pos, token, regexp_matches(token, {_charset_class_sql()}) AS in_charset FROM toks""")
def l5_in_charset(spark, sf):
    """Term-charset check of every request token."""
    toks = matching.tokenise(B.requests(spark, sf), "text", ["request_id"], lower=False)
    return toks.withColumn("in_charset", in_charset(F.col("token")))


@query("l8_explode_pronunciations", """
SELECT 'c' || CAST(conv_id AS VARCHAR) AS term, role AS speaker, 'x' AS word_type,
       CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.mp3' AS remote_file,
       role || '__c' || CAST(conv_id AS VARCHAR) || '__x' AS local_stem
FROM conversations WHERE role <> 'system'""")
def l8_explode_pronunciations(spark, sf):
    """Conversations folded into nested pronunciation arrays, then exploded."""
    c = table(spark, sf, "conversations")
    audio = F.array(F.struct(
        F.when(F.col("role") != "system", F.concat_ws("", F.col("conv_id").cast("string"), F.lit("_"),
                                                     F.col("turn").cast("string"), F.lit(".mp3"))).alias("file"),
        F.col("role").alias("speaker")))
    raw = (c.groupBy("conv_id").agg(F.collect_list(F.struct(audio.alias("audio"))).alias("pronunciation"))
           .select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("na'vi"),
                   F.lit(None).cast("string").alias("type"), "pronunciation"))
    return lexicon.explode_pronunciations(raw)


@query("l9_slugs", r"""
SELECT p_partkey,
       p_brand || '__' || replace(regexp_replace(p_name, '[/\\:*?"<>|]', '_', 'g'), ' ', '_') || '__' ||
       coalesce(nullif(p_type, ''), 'x') AS speaker_slug,
       substr(trim(regexp_replace(p_name, '[^a-zA-Z0-9äìÄÌ]', '_', 'g'), '_'), 1, 100) AS ascii_slug
FROM part""")
def l9_slugs(spark, sf):
    """Speaker and ASCII file slugs of part names."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", slug_speaker(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("speaker_slug"),
                    slug_ascii(F.col("p_name")).alias("ascii_slug"))


@query("l10_slug_collisions", r"""
SELECT slug, CAST(count(*) AS BIGINT) AS n, min(p_partkey) AS first_id, max(p_partkey) AS last_id FROM (
  SELECT substr(trim(regexp_replace(p_name, '[^a-zA-Z0-9äìÄÌ]', '_', 'g'), '_'), 1, 100) AS slug, p_partkey FROM part)
GROUP BY slug HAVING count(*) > 1""")
def l10_slug_collisions(spark, sf):
    """Slugs shared by several part names (silent overwrites made visible)."""
    return lexicon.slug_collisions(table(spark, sf, "part"), "p_name", "p_partkey")


@query("l11_primary_gloss", r"""
SELECT doc_id, nullif(regexp_replace(split_part(text, ';', 1), '^\s+|\s+$', '', 'g'), '') AS primary_gloss,
       nullif(regexp_replace(split_part(split_part(text, ';', 1), ',', 1), '^\s+|\s+$', '', 'g'), '') AS lookup_gloss
FROM documents""")
def l11_primary_gloss(spark, sf):
    """Primary gloss (and the lookup variant cut at the first comma) of documents."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", primary_gloss(F.col("text")).alias("primary_gloss"),
                    primary_gloss(F.col("text"), cut_comma=True).alias("lookup_gloss"))


@query("l12_clean_gloss", f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents")
def l12_clean_gloss(spark, sf):
    """Gloss clean-up applied to whole document texts."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", clean_gloss(F.col("text")).alias("cleaned"))


@query("l13_clean_oov_word", f"""
SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM (
  SELECT conv_id, turn, pos,
         nullif(substr(regexp_replace(lower(token), '[^\\p{{L}}\\p{{N}}ìäáéíóúñ]', '', 'g'), 1, 20), '') AS word
  FROM (SELECT conv_id, turn, unnest(t) AS token, unnest(range(0, len(t))) AS pos
        FROM (SELECT conv_id, turn, {tokens_of('text')} AS t FROM conversations)))
WHERE word IS NOT NULL""")
def l13_clean_oov_word(spark, sf):
    """Metric-label cleaning of every conversation token."""
    c = table(spark, sf, "conversations")
    toks = matching.tokenise(c, "text", ["conv_id", "turn"], lower=False)
    return (toks.select("conv_id", "turn", "pos", clean_oov_word(F.col("token")).alias("word"))
            .filter(F.col("word").isNotNull()))


@query("l14_validate_requests", """
WITH r AS (SELECT conv_id * 4294967296 + turn AS item_id, turn AS t,
                  CASE WHEN turn % 5 = 0 THEN '' WHEN turn % 7 <> 0 THEN text END AS text,
                  CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN substr(text, 1, 150) ELSE role END AS term,
                  CASE WHEN turn % 4 = 1 THEN '' WHEN turn % 4 = 2 THEN text || text ELSE role END AS gloss,
                  (conv_id % 13) / 10.0 - 0.1 AS confidence FROM conversations)
SELECT item_id, reason FROM (
  SELECT item_id, unnest([CASE WHEN text IS NULL OR length(text) < 1 THEN 'text_empty' END, CASE WHEN length(text) > 500 THEN 'text_too_long' END,
                          CASE WHEN length(term) < 1 THEN 'term_empty' END, CASE WHEN length(term) > :term_max THEN 'term_too_long' END,
                          CASE WHEN length(gloss) < 1 THEN 'gloss_empty' END, CASE WHEN length(gloss) > :gloss_max THEN 'gloss_too_long' END,
                          CASE WHEN confidence < 0 OR confidence > 1 THEN 'confidence_out_of_range' END]) AS reason FROM r)
WHERE reason IS NOT NULL""".replace(":term_max", str(lexicon.TERM_MAX_CHARS)).replace(":gloss_max", str(lexicon.GLOSS_MAX_CHARS)))
def l14_validate_requests(spark, sf):
    """All limits, over conversation turns with missing, empty and long fields."""
    t = F.col("turn")
    c = table(spark, sf, "conversations").select(
        B._packed("conv_id", t).alias("item_id"), F.when(t % 5 == 0, "").when(t % 7 != 0, F.col("text")).alias("text"),
        F.when(t % 3 == 0, "").when(t % 3 == 1, F.substring("text", 1, 150)).otherwise(F.col("role")).alias("term"),
        F.when(t % 4 == 1, "").when(t % 4 == 2, F.concat("text", "text")).otherwise(F.col("role")).alias("gloss"),
        ((F.col("conv_id") % 13) / 10.0 - 0.1).alias("confidence"))
    return lexicon.validate_requests(c, "item_id")


@query("l15_media_gate", """
SELECT page_id, CAST(CASE WHEN ct <> '' AND ct NOT IN ('audio/wav', 'audio/mpeg', 'audio/ogg', 'audio/x-wav', 'audio/wave')
                               AND NOT (suffix(name, '.wav') OR suffix(name, '.mp3') OR suffix(name, '.ogg')) THEN 415
                          WHEN n_bytes > 1920000 THEN 413 ELSE 200 END AS INTEGER) AS status
FROM (SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '.wav' WHEN 1 THEN '.ogg' ELSE '' END AS name,
             CASE page_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'audio/mpeg' ELSE '' END AS ct,
             strlen(html) * CASE WHEN page_id % 7 = 0 THEN 5000 ELSE 1 END AS n_bytes FROM pages)""")
def l15_media_gate(spark, sf):
    """Upload gate (415 / 413 / 200) applied to pages as uploads of several types and sizes."""
    i = F.col("page_id")
    name = F.concat("url", F.when(i % 5 == 0, ".wav").when(i % 5 == 1, ".ogg").otherwise(""))
    ct = F.when(i % 3 == 0, "text/html").when(i % 3 == 1, "audio/mpeg").otherwise("")
    p = table(spark, sf, "pages").select("page_id", name.alias("url"), ct.alias("content_type"),
                                         (F.octet_length("html") * F.when(i % 7 == 0, 5000).otherwise(1)).alias("n_bytes"))
    return lexicon.media_gate(p, "content_type", "url", "n_bytes").select("page_id", "status")


@query("l16_duration_filter", """
SELECT lang, CASE WHEN d IS NULL THEN 'unknown_duration' WHEN d < 0.3 THEN 'too_short' WHEN d > 10.0 THEN 'too_long' ELSE 'ok' END AS reason,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT lang, CASE WHEN doc_id % 17 <> 0 THEN n_chars / 1000.0 END AS d FROM documents) GROUP BY 1, 2""")
def l16_duration_filter(spark, sf):
    """Duration gate reasons per language (documents as media, some of unknown length)."""
    m = B.media_manifest(spark, sf)
    known = F.when(F.col("item_id") % 17 != 0, F.col("duration_s"))
    tagged = lexicon.duration_filter(m.withColumn("duration_s", known), "duration_s")
    return tagged.groupBy(F.col("speaker").alias("lang"), "reason").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("l17_client_id", r"""
SELECT page_id, CASE WHEN coalesce(fwd, '') <> '' THEN regexp_replace(split_part(fwd, ',', 1), '^\s+|\s+$', '', 'g')
                     ELSE coalesce(host, 'unknown') END AS client
FROM (SELECT page_id, CASE WHEN starts_with(url, 'https') THEN regexp_extract(url, '://([^/:?#]+)', 1) || ', 10.0.0.1' END AS fwd,
             nullif(regexp_extract(url, '://([^/:?#]+)', 1), '') AS host FROM pages)""")
def l17_client_id(spark, sf):
    """Client id from a forwarded-for header (https pages) or the host."""
    p = table(spark, sf, "pages")
    host = F.nullif(F.regexp_extract("url", "://([^/:?#]+)", 1), F.lit(""))
    fwd = F.when(F.startswith("url", F.lit("https")), F.concat(F.regexp_extract("url", "://([^/:?#]+)", 1),
                                                                F.lit(", 10.0.0.1")))
    return p.select("page_id", client_id(fwd, host).alias("client"))


@query("s7_recent_requests", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 500""")
def s7_recent_requests(spark, sf):
    """The newest 500 requests."""
    e = io.recent_requests(table(spark, sf, "events").select("event_id", "ts"))
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("s11_only_new", """
SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (
  SELECT l.doc_id FROM labels l JOIN documents x ON x.doc_id = l.doc_id WHERE x.n_chars > 100)""")
def s11_only_new(spark, sf):
    """Documents without a finished label (labels of ≤ 100-char documents count as missing)."""
    d = table(spark, sf, "documents")
    done = table(spark, sf, "labels").join(d.select("doc_id", "n_chars"), "doc_id")
    return io.only_new(d.select("doc_id"), done, "doc_id", size_col="n_chars")


@query("u1_score_batches", with_(REQUESTS) + f"""
SELECT request_id, coalesce(text, '') AS model_text,
       least(1.0, len({tokens_of("coalesce(text, '')")}) / 50.0) AS model_confidence FROM requests""")
def u1_score_batches(spark, sf):
    """Bring-your-own scorer over request texts (Arrow batches, model loaded per task)."""
    req = B.requests(spark, sf)
    return scoring.score_batches(req, scoring.length_scorer_factory(),
                                 "request_id BIGINT, model_text STRING, model_confidence DOUBLE",
                                 ["request_id", "text"])


def _j6_model_sql() -> str:
    from tessera.plans.q_matching import BREAKDOWN_SQL
    eng = clean_sql("CASE WHEN use_dict AND hits > 0 THEN dict_text WHEN use_dict AND model_text = '' THEN text "
                    "ELSE model_text END")
    return BREAKDOWN_SQL.rstrip() + f""",
agg AS (
  SELECT request_id, count(*) AS n, count(*) FILTER (WHERE found) AS hits, count(*) FILTER (WHERE fuzzy) AS nf,
         string_agg(gloss, ' ' ORDER BY pos) AS dict_text, string_agg(corrected, ' ' ORDER BY pos) AS corrected_text
  FROM breakdown GROUP BY request_id),
sc AS (SELECT request_id, text, coalesce(text, '') AS model_text,
              least(1.0, len({tokens_of("coalesce(text, '')")}) / 50.0) AS conf0 FROM requests),
j AS (SELECT sc.*, sc.conf0 < 0.4 AS use_dict, coalesce(a.n, 0) AS n, coalesce(a.hits, 0) AS hits,
             coalesce(a.nf, 0) AS nf, a.dict_text, a.corrected_text FROM sc LEFT JOIN agg a USING (request_id))
SELECT request_id, text, {eng} AS english,
       round(CASE WHEN use_dict AND hits > 0 THEN greatest(conf0, 0.5 + 0.45 * hits / n) ELSE conf0 END, 3) AS confidence,
       CAST(CASE WHEN use_dict THEN n ELSE 0 END AS BIGINT) AS n_tokens,
       CAST(CASE WHEN use_dict THEN hits ELSE 0 END AS BIGINT) AS found_tokens,
       CASE WHEN use_dict THEN coalesce(corrected_text, '') ELSE '' END AS corrected_text,
       CAST(CASE WHEN use_dict THEN nf ELSE 0 END AS BIGINT) AS fuzzy_corrections
FROM j"""


@query("j6_translate_with_model", _j6_model_sql())
def j6_translate_with_model(spark, sf):
    """J6 with model scores from U1: dictionary only below the 0.4 threshold."""
    req = B.requests(spark, sf)
    lk = _lookup(spark, sf)
    scores = u1_score_batches(spark, sf)
    return matching.translate_requests(req, matching.gloss_tokens(req, lk), scores).drop("breakdown")

