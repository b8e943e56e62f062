"""Queries for tokenising, matching and OOV."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import word_tokens
from tessera.operators import corpus, lexicon, matching, profile
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.sqlparts import LEX, LOOKUP, REQUESTS, RICH, tokens_of, with_
from tessera.session import cut_lineage, table

SUFFIX_VALUES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(matching.SUFFIXES))

# SQL for the gloss ladder (J2→J3→J4) over the distinct lower-cased words of `words(low)`.
LADDER = rf"""
sfx(rank, suffix) AS (VALUES {SUFFIX_VALUES}),
exact AS (SELECT w.low FROM words w JOIN lookup k ON k.key = w.low),
suf AS (
  SELECT w.low, arg_min(left(w.low, length(w.low) - length(s.suffix)), s.rank) AS stem
  FROM words w JOIN sfx s ON suffix(w.low, s.suffix) AND length(w.low) - length(s.suffix) >= 2
  JOIN lookup k ON k.key = left(w.low, length(w.low) - length(s.suffix))
  WHERE w.low NOT IN (SELECT low FROM exact) GROUP BY w.low
),
open AS (
  SELECT low, regexp_replace(low, '[^\x00-\x7F]', '#', 'g') AS a FROM words
  WHERE low NOT IN (SELECT low FROM exact) AND low NOT IN (SELECT low FROM suf) AND length(low) >= 3
),
fz AS (
  SELECT low, arg_min(key, (d, pos)) AS fuzzy_key, min(d) AS edit_distance FROM (
    SELECT o.low, k.key, k.pos, levenshtein(o.a, k.key) AS d
    FROM open o JOIN lookup k ON abs(length(o.low) - length(k.key)) <= 2
  ) WHERE d <= 2 GROUP BY low
),
resolved AS (
  SELECT w.low,
         CASE WHEN e.low IS NOT NULL THEN w.low WHEN s.stem IS NOT NULL THEN s.stem ELSE f.fuzzy_key END AS key,
         coalesce(f.edit_distance, 0) AS edit_distance
  FROM words w LEFT JOIN exact e ON e.low = w.low LEFT JOIN suf s ON s.low = w.low LEFT JOIN fz f ON f.low = w.low
)"""


def clean_sql(x: str) -> str:
    t = f"regexp_replace({x}, '\\s*\\([^)]*\\)', '', 'g')"
    t = f"regexp_replace({t}, '\\[[A-Za-z]?\\]', '', 'g')"
    t = f"trim(regexp_replace({t}, '\\s+', ' ', 'g'), ' ,;.')"
    return f"coalesce(nullif({t}, ''), '(no translation)')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


FIRST_MEANING = strip_sql("split_part(split_part(coalesce(k.gloss, '[' || t.token || ']'), ';', 1), ',', 1)")

BREAKDOWN_SQL = with_(LOOKUP, REQUESTS, rf"""
toks AS (
  SELECT request_id, unnest(t) AS token, unnest(range(0, len(t))) AS pos
  FROM (SELECT request_id, {tokens_of(strip_sql('text'))} AS t FROM requests)
),
words AS (SELECT DISTINCT lower(token) AS low FROM toks),""", LADDER, r"""
breakdown AS (
  SELECT t.request_id, t.pos, t.token,
         CASE WHEN r.edit_distance > 0 THEN r.key ELSE t.token END AS corrected,
         CAST(r.edit_distance AS INTEGER) AS edit_distance,
         """ + clean_sql(FIRST_MEANING) + r""" AS gloss,
         r.key IS NOT NULL AS found, r.edit_distance > 0 AS fuzzy
  FROM toks t JOIN resolved r ON r.low = lower(t.token) LEFT JOIN lookup k ON k.key = r.key
)""")


def _lookup(spark, sf):
    """The lookup is a small dimension read by up to five branches of the
    ladder: materialise it once (reliable checkpoint) instead of re-deriving it."""
    return cut_lineage(lexicon.build_lookup(B.lexicon(spark, sf)))


def _doc_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return matching.tokenise(d, "text", ["doc_id", "lang"], lower=True)


@query("a1_oov_rate_by_lang", with_(LEX, rf"""
toks AS (SELECT lang, unnest({tokens_of('lower(text)')}) AS token FROM documents),
vocab AS (SELECT DISTINCT lower(term) AS token FROM lex)
""") + r"""
SELECT lang, CAST(count(*) AS BIGINT) AS total_tokens,
       CAST(count(*) FILTER (WHERE v.token IS NULL) AS BIGINT) AS oov_tokens,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE v.token IS NULL) / count(*) ELSE 0 END, 6) AS oov_rate,
       CAST((SELECT count(*) FROM vocab) AS BIGINT) AS vocab_size
FROM toks t LEFT JOIN vocab v ON v.token = t.token GROUP BY lang""")
def a1_oov_rate_by_lang(spark, sf):
    """A1: OOV rate of document tokens against the lexicon, per language."""
    return profile.oov_rate(_doc_tokens(spark, sf), B.lexicon(spark, sf), by=["lang"])


@query("j1_tokenise", rf"""
SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT conv_id, turn, unnest(t) AS token, unnest(range(0, len(t))) AS pos
  FROM (SELECT conv_id, turn, {tokens_of('lower(text)')} AS t FROM conversations))""")
def j1_tokenise(spark, sf):
    """Lower-cased whitespace tokens with positions."""
    c = table(spark, sf, "conversations")
    return matching.tokenise(c, "text", ["conv_id", "turn"], lower=True)


@query("l6_build_lookup", with_(LOOKUP) + "SELECT key, gloss, pos FROM lookup")
def l6_build_lookup(spark, sf):
    """Lookup keys (raw + canonical), last gloss, first position."""
    return _lookup(spark, sf)


RICH_LOOKUP = RICH + LOOKUP[len(LEX):].replace("FROM lex", "FROM rich")


@query("l6_build_lookup_rich", with_(RICH_LOOKUP) + "SELECT key, gloss, pos FROM lookup")
def l6_build_lookup_rich(spark, sf):
    """L6 where terms repeat: the last gloss and the first position come from different entries."""
    return lexicon.build_lookup(B.rich_lexicon(spark, sf))


@query("l7_lookup_exact_rich", with_(RICH, REQUESTS, rf"""
toks AS (
  SELECT request_id, unnest(t) AS word, unnest(range(0, len(t))) AS pos
  FROM (SELECT request_id, {tokens_of('text')} AS t FROM requests)),
firsts AS (
  SELECT lower(term) AS lkey, arg_min(term, seq) AS match_term, arg_min(gloss, seq) AS match_gloss,
         arg_min(term_type, seq) AS match_type FROM rich GROUP BY lower(term))
""") + r"""
SELECT request_id, CAST(pos AS INTEGER) AS pos, word, match_term, match_gloss, match_type
FROM toks t LEFT JOIN firsts f ON f.lkey = lower(regexp_replace(t.word, '^\s+|\s+$', '', 'g'))""")
def l7_lookup_exact_rich(spark, sf):
    """L7 where capitalised entries come before plain ones: the first wins."""
    toks = matching.tokenise(B.requests(spark, sf), "text", ["request_id"], lower=False)
    return lexicon.lookup_exact(toks.withColumnRenamed("token", "word"), B.rich_lexicon(spark, sf))


@query("l7_lookup_exact", with_(LEX, REQUESTS, rf"""
toks AS (
  SELECT request_id, unnest(t) AS word, unnest(range(0, len(t))) AS pos
  FROM (SELECT request_id, {tokens_of('text')} AS t FROM requests)),
firsts AS (
  SELECT lower(term) AS lkey, arg_min(term, seq) AS match_term, arg_min(gloss, seq) AS match_gloss,
         arg_min(term_type, seq) AS match_type FROM lex GROUP BY lower(term))
""") + r"""
SELECT request_id, CAST(pos AS INTEGER) AS pos, word, match_term, match_gloss, match_type
FROM toks t LEFT JOIN firsts f ON f.lkey = lower(regexp_replace(t.word, '^\s+|\s+$', '', 'g'))""")
def l7_lookup_exact(spark, sf):
    """Case-insensitive exact lookup, first lexicon entry wins."""
    toks = matching.tokenise(B.requests(spark, sf), "text", ["request_id"], lower=False)
    return lexicon.lookup_exact(toks.withColumnRenamed("token", "word"), B.lexicon(spark, sf))


@query("j2_match_exact_by_doc", with_(LOOKUP, rf"""
toks AS (SELECT doc_id, unnest({tokens_of('text')}) AS token FROM documents)
""") + r"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, CAST(count(k.key) AS BIGINT) AS n_exact
FROM toks t LEFT JOIN lookup k ON k.key = lower(t.token) GROUP BY doc_id""")
def j2_match_exact_by_doc(spark, sf):
    """Exact (lower-cased) lookup hits per document."""
    d = table(spark, sf, "documents")
    toks = matching.tokenise(d, "text", ["doc_id"], lower=False)
    m = matching.match_exact(toks, _lookup(spark, sf))
    return m.groupBy("doc_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
                                   F.count("match_gloss").cast("bigint").alias("n_exact"))


@query("j3_match_suffix", with_(LOOKUP, rf"""
words AS (SELECT DISTINCT lower(unnest({tokens_of('text')})) AS low FROM documents),
sfx(rank, suffix) AS (VALUES {SUFFIX_VALUES})
""") + r"""
SELECT w.low, arg_min(left(w.low, length(w.low) - length(s.suffix)), s.rank) AS stem,
       CAST(min(s.rank) AS INTEGER) AS suffix_rank
FROM words w JOIN sfx s ON suffix(w.low, s.suffix) AND length(w.low) - length(s.suffix) >= 2
JOIN lookup k ON k.key = left(w.low, length(w.low) - length(s.suffix))
WHERE w.low NOT IN (SELECT key FROM lookup)
GROUP BY w.low""")
def j3_match_suffix(spark, sf):
    """Suffix-stripped lookup of distinct document words that miss exactly."""
    d = table(spark, sf, "documents")
    words = matching.tokenise(d, "text", [], lower=False).select(F.lower("token").alias("low")).distinct()
    lk = _lookup(spark, sf)
    open_words = words.join(lk.select(F.col("key").alias("low")), "low", "left_anti")
    return matching.match_suffix(open_words, lk)


@query("j4_match_fuzzy", with_(LOOKUP, rf"""
words AS (SELECT DISTINCT lower(unnest({tokens_of('text')})) AS low FROM documents),
open AS (SELECT low, regexp_replace(low, '[^\x00-\x7F]', '#', 'g') AS a FROM words
         WHERE low NOT IN (SELECT key FROM lookup) AND length(low) >= 3)
""") + r"""
SELECT low, arg_min(key, (d, pos)) AS fuzzy_key, CAST(min(d) AS INTEGER) AS edit_distance FROM (
  SELECT o.low, k.key, k.pos, levenshtein(o.a, k.key) AS d
  FROM open o JOIN lookup k ON abs(length(o.low) - length(k.key)) <= 2
) WHERE d <= 2 GROUP BY low""")
def j4_match_fuzzy(spark, sf):
    """Nearest key within 2 edits (ties → earliest key) for distinct document
    words with no exact hit, by deletion-neighbourhood blocking."""
    d = table(spark, sf, "documents")
    words = matching.tokenise(d, "text", [], lower=False).select(F.lower("token").alias("low")).distinct()
    lk = _lookup(spark, sf)
    open_words = words.join(lk.select(F.col("key").alias("low")), "low", "left_anti")
    return matching.match_fuzzy(open_words, lk)


@query("j5_gloss_tokens", BREAKDOWN_SQL + "SELECT * FROM breakdown")
def j5_gloss_tokens(spark, sf):
    """Per-token gloss ladder (exact → suffix → fuzzy → miss) over requests."""
    return matching.gloss_tokens(B.requests(spark, sf), _lookup(spark, sf))


J6_SQL = BREAKDOWN_SQL.rstrip() + r""",
agg AS (
  SELECT request_id, count(*) AS n, count(*) FILTER (WHERE found) AS hits,
         count(*) FILTER (WHERE fuzzy) AS nf,
         string_agg(gloss, ' ' ORDER BY pos) AS dict_text,
         string_agg(corrected, ' ' ORDER BY pos) AS corrected_text
  FROM breakdown GROUP BY request_id
)
SELECT r.request_id, r.text,
       """ + clean_sql("CASE WHEN coalesce(a.hits, 0) > 0 THEN a.dict_text ELSE r.text END") + r""" AS english,
       round(CASE WHEN coalesce(a.hits, 0) > 0 THEN greatest(0.0, 0.5 + 0.45 * a.hits / a.n) ELSE 0.0 END, 3) AS confidence,
       CAST(coalesce(a.n, 0) AS BIGINT) AS n_tokens, CAST(coalesce(a.hits, 0) AS BIGINT) AS found_tokens,
       coalesce(a.corrected_text, '') AS corrected_text, CAST(coalesce(a.nf, 0) AS BIGINT) AS fuzzy_corrections
FROM requests r LEFT JOIN agg a ON a.request_id = r.request_id"""


@query("j6_translate_requests", J6_SQL)
def j6_translate_requests(spark, sf):
    """J6+J7: per-request dictionary translation, confidence and corrected text."""
    lk = _lookup(spark, sf)
    req = B.requests(spark, sf)
    out = matching.translate_requests(req, matching.gloss_tokens(req, lk))
    return out.drop("breakdown")


@query("j8_oov_tokens", with_(LEX, rf"""
toks AS (
  SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS pos
  FROM (SELECT doc_id, {tokens_of('lower(text)')} AS t FROM documents))
""") + r"""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM toks
WHERE token NOT IN (SELECT lower(term) FROM lex)""")
def j8_oov_tokens(spark, sf):
    """Document tokens outside the vocabulary (left anti join)."""
    d = table(spark, sf, "documents")
    toks = matching.tokenise(d, "text", ["doc_id"], lower=True)
    return matching.oov_tokens(toks, B.lexicon(spark, sf))


@query("j9_attach_tier", with_(LEX, r"""
tc AS (SELECT term_type, count(*) AS n, min(seq) AS first_seq FROM lex GROUP BY term_type),
tr AS (SELECT term_type, row_number() OVER (ORDER BY n DESC, first_seq) - 1 AS i,
              count(*) OVER () AS nt FROM tc),
tiers AS (SELECT l.term, arg_max(CASE WHEN tr.i < tr.nt * 0.3 THEN 'common'
                                      WHEN tr.i < tr.nt * 0.7 THEN 'mid' ELSE 'rare' END, l.seq) AS tier
          FROM lex l JOIN tr ON tr.term_type = l.term_type GROUP BY l.term)
""") + r"""
SELECT d.doc_id, coalesce(t.tier, 'rare') AS tier
FROM documents d LEFT JOIN tiers t
  ON t.term = list_filter(string_split_regex(d.text, '\s+'), lambda x: x <> '')[1]""")
def j9_attach_tier(spark, sf):
    """Frequency tier of each document's first token (default rare)."""
    tiered = corpus.frequency_tier(B.lexicon(spark, sf))
    d = table(spark, sf, "documents").select("doc_id", "text")
    return matching.attach_tier(d, tiered).select("doc_id", "tier")


@query("j10_resolve_label", with_(LEX, r"""
wm AS (SELECT lower(term) AS lk, arg_max(term, seq) AS term FROM lex GROUP BY lower(term)),
man AS (
  SELECT l.doc_id, CASE WHEN l.quality = 1 THEN '' ELSE d.lang END AS label,
         lower(list_filter(string_split_regex(d.text, '\s+'), lambda x: x <> '')[1]) AS stem
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
""") + r"""
SELECT m.doc_id, m.label, m.stem, coalesce(nullif(m.label, ''), w.term, m.stem) AS resolved_label
FROM man m LEFT JOIN wm w ON w.lk = lower(m.stem)""")
def j10_resolve_label(spark, sf):
    """Manifest label, else lexicon term for the stem, else the stem."""
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents")
    from tessera.functions.text import word_tokens
    man = lab.join(d, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 1, "").otherwise(F.col("lang")).alias("label"),
        F.lower(F.element_at(word_tokens(F.col("text")), 1)).alias("stem"))
    return matching.resolve_label(man, B.lexicon(spark, sf))


@query("j6_breakdown", BREAKDOWN_SQL + "SELECT request_id, pos, token, corrected, edit_distance, gloss, found, fuzzy FROM breakdown")
def j6_breakdown(spark, sf):
    """The breakdown that goes with each translation, a row for each token."""
    req = B.requests(spark, sf)
    out = matching.translate_requests(req, matching.gloss_tokens(req, _lookup(spark, sf)))
    return out.select("request_id", F.posexplode("breakdown").alias("pos", "b")).select("request_id", "pos", *[
        F.col(f"b.{c}").alias(c) for c in ("token", "corrected", "edit_distance", "gloss", "found", "fuzzy")])


BENCH_ITEMS = r"""
items AS (SELECT item_id, CASE WHEN item_id % 2 = 0 THEN lower(text) ELSE text END AS text FROM benchmark),
firsts AS (SELECT item_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')[1] AS word FROM items)"""


def _bench_items(spark, sf):
    b = table(spark, sf, "benchmark")
    return b.select("item_id", F.when(F.col("item_id") % 2 == 0, F.lower("text")).otherwise(F.col("text")).alias("text"))


@query("j9_attach_tier_terms", with_(LEX, BENCH_ITEMS, r"""
tc AS (SELECT term_type, count(*) AS n, min(seq) AS first_seq FROM lex GROUP BY term_type),
tr AS (SELECT term_type, row_number() OVER (ORDER BY n DESC, first_seq) - 1 AS i, count(*) OVER () AS nt FROM tc),
tiers AS (SELECT l.term, CASE WHEN tr.i < tr.nt * 0.3 THEN 'common' WHEN tr.i < tr.nt * 0.7 THEN 'mid' ELSE 'rare' END AS tier
          FROM lex l JOIN tr ON tr.term_type = l.term_type)
""") + "SELECT f.item_id, coalesce(t.tier, 'rare') AS tier FROM firsts f LEFT JOIN tiers t ON t.term = f.word")
def j9_attach_tier_terms(spark, sf):
    """J9 over texts that begin with terms, half of them capitalised (no exact match)."""
    tiered = corpus.frequency_tier(B.lexicon(spark, sf))
    return matching.attach_tier(_bench_items(spark, sf), tiered).select("item_id", "tier")


@query("j10_resolve_label_terms", with_(RICH, BENCH_ITEMS, r"""
wm AS (SELECT lower(term) AS lk, arg_max(term, seq) AS term FROM rich WHERE term_type <> 'len2' GROUP BY lower(term)),
man AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'told' WHEN item_id % 3 = 1 THEN '' END AS label, upper(word) AS stem FROM firsts)
""") + r"""
SELECT m.item_id, m.stem, coalesce(nullif(m.label, ''), w.term, m.stem) AS resolved_label
FROM man m LEFT JOIN wm w ON w.lk = lower(m.stem)""")
def j10_resolve_label_terms(spark, sf):
    """J10 where label, term and stem differ, and some stems are no terms."""
    first = F.element_at(word_tokens(F.col("text")), 1)
    i = F.col("item_id") % 3
    man = _bench_items(spark, sf).select("item_id", F.when(i == 0, "told").when(i == 1, "").alias("label"), F.upper(first).alias("stem"))
    lex = B.rich_lexicon(spark, sf).where("term_type <> 'len2'")
    return matching.resolve_label(man, lex).select("item_id", "stem", "resolved_label")
