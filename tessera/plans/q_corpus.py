"""Queries for corpus building."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import (
    ENGLISH_STARTERS,
    HTML_ENTITIES,
    clean_source,
    quoted_target,
    strip_ws,
    word_tokens,
)
from tessera.operators import corpus
from tessera.plans import bindings as B
from tessera.plans.catalog import query
from tessera.plans.sqlparts import LEX, tokens_of, with_
from tessera.session import table


def _strip(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_BR = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def html_lines_sql(html: str) -> str:
    t = f"regexp_replace({html}, '</(?:p|br|div|li|blockquote|h[1-6])[^>]*>', chr(10), 'gi')"
    t = f"regexp_replace({t}, '<br\\s*/?>', chr(10), 'gi')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    for a, b in HTML_ENTITIES:
        t = f"replace({t}, {_sq(a)}, {_sq(b)})"
    t = f"regexp_replace({t}, '(?:{_BR})\\z', '')"
    return (f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE "
            f"list_transform(string_split_regex({t}, '{_BR}'), lambda x: {_strip('x')}) END")


def looks_like_source_sql(x: str) -> str:
    starters = " OR ".join(f"starts_with(lower({x}), {_sq(s)})" for s in ENGLISH_STARTERS)
    return (f"(length({x}) >= 4 AND len({tokens_of(x)}) >= 2 AND NOT ({starters})"
            f" AND NOT (starts_with(lower({x}), 'http') OR starts_with(lower({x}), '©'))"
            f" AND (regexp_matches({x}, '[ìäéù'']') OR regexp_matches({x}, '\\w''\\w')))")


def quoted_target_sql(x: str) -> str:
    whole = "'^''(.+?)''\\.?\\s*$'"
    inner = "'''([A-Z][^'']{5,}[.!?])'''"
    return (f"nullif(CASE WHEN regexp_matches({x}, {whole}) THEN {_strip(f'regexp_extract({x}, {whole}, 1)')}"
            f" WHEN regexp_matches({x}, {inner}) THEN {_strip(f'regexp_extract({x}, {inner}, 1)')} END, '')")


def clean_source_sql(x: str) -> str:
    t = _strip(f"regexp_replace({x}, '^[\\d.\\-*•–—\\s]+', '')")
    return (f"CASE WHEN NOT regexp_matches({t}, '\\([a-z]+\\.,?\\s')"
            f" AND NOT regexp_matches({t}, '\\((?:n|v|adj|adv|intj|part|conj|adp)\\.')"
            f" AND len({tokens_of(t)}) >= 2 THEN {t} END")


REGISTRY_SQL = {"c1": with_(LEX) + r"""
SELECT seq, term AS src, nullif(regexp_replace(split_part(gloss, ';', 1), '^\s+|\s+$', '', 'g'), '') AS tgt
FROM lex WHERE nullif(regexp_replace(split_part(gloss, ';', 1), '^\s+|\s+$', '', 'g'), '') IS NOT NULL"""}


@query("c1_word_pairs", REGISTRY_SQL["c1"])
def c1_word_pairs(spark, sf):
    """(term, primary gloss) pairs."""
    return corpus.word_pairs(B.lexicon(spark, sf))


def _phrase_sql() -> str:
    m, o = (7919, 104729, 1299709), (1, 17, 401)

    def picks(width):
        out = []
        for j in range(width):
            p = f"(({m[j]} * i + {o[j]}) % n)"
            for _ in range(2):
                for e in out:
                    p = f"(CASE WHEN {p} = {e} THEN ({p} + 1) % n ELSE {p} END)"
            out.append(p)
        return out

    parts = []
    for width, cnt, kind in ((2, "least(500, n)", "phrase2"), (3, "least(200, n // 2)", "phrase3")):
        ps = picks(width)
        cols = ", ".join(f"{p} AS w{j}" for j, p in enumerate(ps))
        joins = " ".join(f"JOIN idx x{j} ON x{j}.idx = r.w{j}" for j in range(width))
        src = " || ' ' || ".join(f"x{j}.term" for j in range(width))
        tgt = " || ' ' || ".join(f"coalesce(x{j}.pg, '')" for j in range(width))
        parts.append(f"""SELECT '{kind}' AS kind, r.i AS phrase_id, {src} AS src, {tgt} AS tgt
FROM (SELECT i, {cols} FROM (SELECT range AS i, (SELECT count(*) FROM lex) AS n FROM range(0, 500))
      WHERE i < {cnt}) r {joins}""")
    return with_(LEX, r"""
idx AS (SELECT row_number() OVER (ORDER BY seq) - 1 AS idx, term,
               nullif(regexp_replace(split_part(gloss, ';', 1), '^\s+|\s+$', '', 'g'), '') AS pg FROM lex)
""") + "\nUNION ALL\n".join(parts)


@query("c2_phrase_pairs", _phrase_sql())
def c2_phrase_pairs(spark, sf):
    """Deterministic 2- and 3-word phrase synthesis."""
    return corpus.phrase_pairs(B.lexicon(spark, sf))


def _c3_sql() -> str:
    c1 = REGISTRY_SQL["c1"]
    return f"""
WITH p AS ({_phrase_sql()}),
w AS ({c1}),
u AS (SELECT 'word' AS kind, seq, src, tgt FROM w
      UNION ALL
      SELECT kind, CASE WHEN kind = 'phrase2' THEN 1000000000000000 ELSE 2000000000000000 END + phrase_id, src, tgt FROM p)
SELECT arg_min(kind, seq) AS kind, min(seq) AS seq, arg_min(src, seq) AS src, arg_min(tgt, seq) AS tgt
FROM u GROUP BY lower(src), lower(tgt)"""


@query("c3_combine_c4_dedupe", _c3_sql())
def c3_combine_c4_dedupe(spark, sf):
    """C3+C4: union all of word and phrase pairs, then case-insensitive dedupe."""
    lex = B.lexicon(spark, sf)
    words = corpus.word_pairs(lex).select(F.lit("word").alias("kind"), "seq", "src", "tgt")
    ph = corpus.phrase_pairs(lex).select(
        "kind", (F.when(F.col("kind") == "phrase2", F.lit(10 ** 15)).otherwise(F.lit(2 * 10 ** 15))
                 + F.col("phrase_id")).alias("seq"), "src", "tgt")
    return corpus.dedupe_pairs(corpus.combine(words, ph))


@query("c4_dedupe_pairs", r"""
SELECT arg_min(doc_id, doc_id) AS seq, arg_min(text, doc_id) AS src, arg_min(lang, doc_id) AS tgt
FROM documents GROUP BY lower(text), lower(lang)""")
def c4_dedupe_pairs(spark, sf):
    """C4: first pair per case-insensitive (src, tgt); documents as (text, lang)."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("src"),
                                             F.col("lang").alias("tgt"))
    return corpus.dedupe_pairs(d)


@query("c5_dedupe_by_source", r"""
SELECT arg_min(doc_id, doc_id) AS seq, arg_min(text, doc_id) AS src, arg_min(source, doc_id) AS tgt
FROM documents GROUP BY lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))""")
def c5_dedupe_by_source(spark, sf):
    """First pair per lower(strip(src))."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("src"),
                                             F.col("source").alias("tgt"))
    return corpus.dedupe_by_source(d)


C6_SQL = f"""
SELECT page_id, CAST(line_no AS INTEGER) AS line_no, line FROM (
  SELECT page_id, unnest(l) AS line, unnest(range(0, len(l))) AS line_no
  FROM (SELECT page_id, {html_lines_sql('html')} AS l FROM pages))"""


@query("c6_html_lines", C6_SQL)
def c6_html_lines(spark, sf):
    """Text lines of every page."""
    return corpus.html_lines(table(spark, sf, "pages"))


def _c7_sql(src_pred, tgt_fn, clean_fn):
    return f"""
WITH pl AS (SELECT page_id, {html_lines_sql('html')} AS l FROM pages),
e AS (
  SELECT page_id, i - 1 AS line_no, l[i] AS line,
         coalesce(nullif(l[i + 1], ''), nullif(l[i + 2], ''), nullif(l[i + 3], '')) AS next_line
  FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM pl))
SELECT page_id, CAST(line_no AS INTEGER) AS line_no, src, tgt FROM (
  SELECT page_id, line_no, {clean_fn('line')} AS src, {tgt_fn('next_line')} AS tgt
  FROM e WHERE {src_pred('line')})
WHERE src IS NOT NULL AND tgt IS NOT NULL"""


@query("c7_line_pairs", _c7_sql(looks_like_source_sql, quoted_target_sql, clean_source_sql))
def c7_line_pairs(spark, sf):
    """C7 with the reference predicates (C8 source, C9 quoted target, C10 clean)."""
    return corpus.adjacent_line_pairs(table(spark, sf, "pages"))


#: Benchmark texts as pages of two languages: marked lines, some numbered, each followed by an
#: empty line and a quotation in one of three forms, or by none.
QUOTED_PAGES = r"""(SELECT item_id AS page_id,
  '<p>' || CASE item_id % 3 WHEN 0 THEN '1. ' WHEN 1 THEN '- ' ELSE '' END || 'tse' || chr(39) || 'a ' || substr(text, 1, 60) || '</p>\n\n<p>' ||
  CASE item_id % 4 WHEN 0 THEN chr(39) || substr(text, 1, 50) || chr(39) || '.'
                   WHEN 1 THEN 'or ' || chr(39) || 'The ' || substr(text, 10, 30) || '.' || chr(39) || ' so'
                   WHEN 2 THEN 'no quotation' ELSE chr(39) || substr(text, 5, 20) || chr(39) END || '</p>' AS html FROM benchmark)"""


def _quoted_pages(spark, sf):
    i, t = F.col("item_id"), F.col("text")
    line = F.concat(F.when(i % 3 == 0, "1. ").when(i % 3 == 1, "- ").otherwise(""), F.lit("tse'a "), F.substring(t, 1, 60))
    quote = (F.when(i % 4 == 0, F.concat(F.lit("'"), F.substring(t, 1, 50), F.lit("'.")))
             .when(i % 4 == 1, F.concat(F.lit("or 'The "), F.substring(t, 10, 30), F.lit(".' so")))
             .when(i % 4 == 2, "no quotation").otherwise(F.concat(F.lit("'"), F.substring(t, 5, 20), F.lit("'"))))
    html = F.concat(F.lit("<p>"), line, F.lit("</p>\n\n<p>"), quote, F.lit("</p>"))
    return table(spark, sf, "benchmark").select(i.alias("page_id"), html.alias("html"))


_QUOTED_PAGES_SQL = QUOTED_PAGES.replace("\\n\\n", "' || chr(10) || chr(10) || '")


@query("c7_line_pairs_quoted", _c7_sql(looks_like_source_sql, quoted_target_sql, clean_source_sql).replace("FROM pages", "FROM " + _QUOTED_PAGES_SQL))
def c7_line_pairs_quoted(spark, sf):
    """C7 with the real predicates over pages that hold marked lines and quotations."""
    return corpus.adjacent_line_pairs(_quoted_pages(spark, sf))


@query("c9_quoted_targets_pages", f"""
SELECT page_id, tgt FROM (SELECT page_id, {quoted_target_sql("line")} AS tgt FROM (
  SELECT page_id, regexp_replace(split_part(html, '<p>', 3), '</p>$', '') AS line FROM {_QUOTED_PAGES_SQL})) WHERE tgt IS NOT NULL""")
def c9_quoted_targets_pages(spark, sf):
    """Whole-line and inner quotations of the same pages."""
    line = F.regexp_replace(F.split("html", "<p>")[2], "</p>$", "")
    return (_quoted_pages(spark, sf).select("page_id", quoted_target(line).alias("tgt")).filter(F.col("tgt").isNotNull()))


def _gen_src_sql(x):
    return f"len({tokens_of(x)}) >= 2"


def _gen_tgt_sql(x):
    return f"CASE WHEN regexp_matches({x}, '[.!?]$') THEN {x} END"


@query("c7_line_pairs_generic", _c7_sql(_gen_src_sql, _gen_tgt_sql, lambda x: x))
def c7_line_pairs_generic(spark, sf):
    """C7 with generic predicates: any multi-word line followed by a sentence line."""
    return corpus.adjacent_line_pairs(
        table(spark, sf, "pages"),
        is_source=lambda c: F.size(word_tokens(c)) >= 2,
        extract_target=lambda c: F.when(c.rlike("[.!?]$"), c),
        clean=lambda c: c)


DOC_LINES_SQL = r"""
WITH dl AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS line_no
  FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l
        FROM documents))"""


def _doc_lines(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(F.transform(F.split("text", "\n"), strip_ws)).alias("line_no", "line"))


@query("c8_source_lines", DOC_LINES_SQL + f"""
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM dl WHERE {looks_like_source_sql('line')}""")
def c8_source_lines(spark, sf):
    """Document lines that look like source-language lines."""
    from tessera.functions.text import looks_like_source
    return _doc_lines(spark, sf).filter(looks_like_source(F.col("line")))


@query("c9_quoted_targets", DOC_LINES_SQL + f"""
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, tgt FROM (
  SELECT doc_id, line_no, {quoted_target_sql('line')} AS tgt FROM dl) WHERE tgt IS NOT NULL""")
def c9_quoted_targets(spark, sf):
    """Quoted translations found on document lines."""
    return (_doc_lines(spark, sf).select("doc_id", "line_no", quoted_target(F.col("line")).alias("tgt"))
            .filter(F.col("tgt").isNotNull()))


@query("c10_clean_source", DOC_LINES_SQL + f"""
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, src FROM (
  SELECT doc_id, line_no, {clean_source_sql('line')} AS src FROM dl) WHERE src IS NOT NULL""")
def c10_clean_source(spark, sf):
    """Cleaned source lines (bullets stripped, vocabulary entries rejected)."""
    return (_doc_lines(spark, sf).select("doc_id", "line_no", clean_source(F.col("line")).alias("src"))
            .filter(F.col("src").isNotNull()))


TIERS_SQL = r"""
tc AS (SELECT term_type, count(*) AS n, min(seq) AS first_seq FROM lex GROUP BY term_type),
tr AS (SELECT term_type, row_number() OVER (ORDER BY n DESC, first_seq) - 1 AS i, count(*) OVER () AS nt FROM tc)"""


@query("c11_frequency_tier", with_(LEX, TIERS_SQL) + r"""
SELECT l.seq, l.term, l.term_type, CASE WHEN tr.i < tr.nt * 0.3 THEN 'common'
       WHEN tr.i < tr.nt * 0.7 THEN 'mid' ELSE 'rare' END AS tier
FROM lex l JOIN tr ON tr.term_type = l.term_type""")
def c11_frequency_tier(spark, sf):
    """C11: frequency tier of each lexicon entry's type."""
    return corpus.frequency_tier(B.lexicon(spark, sf)).select("seq", "term", "term_type", "tier")


def _split_sql(stratum: str) -> str:
    return f"""
WITH items AS (SELECT doc_id, {stratum} AS stratum, ((doc_id % 4294967291) * 1000003 + 42) % 4294967291 AS ok FROM documents),
r AS (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY ok, doc_id) AS rn,
             count(*) OVER (PARTITION BY stratum) AS n FROM items),
c AS (SELECT *, greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS nt,
             CASE WHEN n > 2 THEN greatest(1, floor(n * CAST(0.1 AS DOUBLE))) ELSE 0 END AS nv FROM r)
SELECT doc_id, stratum AS {stratum}, CASE WHEN rn <= nt THEN 'train' WHEN rn <= nt + nv THEN 'val' ELSE 'test' END AS split
FROM c"""


@query("c12_split_by_lang", _split_sql("lang"))
def c12_split_by_lang(spark, sf):
    """Stratified 80/10/10 split of documents by language (few, uneven strata)."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return corpus.stratified_split(d, "doc_id", "lang")


@query("c12_split_null_stratum", _split_sql("lang").replace("FROM documents", "FROM (SELECT doc_id, nullif(lang, 'fr') AS lang FROM documents)"))
def c12_split_null_stratum(spark, sf):
    """The items without a stratum are split like one stratum."""
    d = table(spark, sf, "documents").select("doc_id", F.nullif("lang", F.lit("fr")).alias("lang"))
    return corpus.stratified_split(d, "doc_id", "lang")


@query("c12_split_by_source", _split_sql("source"))
def c12_split_by_source(spark, sf):
    """Stratified split of documents by source (many, even strata)."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    return corpus.stratified_split(d, "doc_id", "source")


@query("c13_split_summary", f"""
WITH a AS ({_split_sql('lang')}), b AS ({_split_sql('source')}),
u AS (SELECT 'lang' AS kind, split FROM a UNION ALL SELECT 'source', split FROM b)
SELECT kind, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train,
       CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) AS val,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test
FROM u GROUP BY kind""")
def c13_split_summary(spark, sf):
    """Split counts per kind (lang- and source-stratified splits)."""
    d = table(spark, sf, "documents")
    a = corpus.stratified_split(d.select("doc_id", "lang"), "doc_id", "lang").select(F.lit("lang").alias("kind"), "split")
    b = corpus.stratified_split(d.select("doc_id", "source"), "doc_id", "source").select(F.lit("source").alias("kind"), "split")
    return corpus.split_summary(a.unionByName(b))


@query("c14_corpus_manifest", f"""
WITH d AS ({_c3_sql()})
SELECT CAST(count(*) AS BIGINT) AS total_pairs, CAST(count(*) FILTER (WHERE kind = 'word') AS BIGINT) AS word_pairs,
       CAST(count(*) FILTER (WHERE starts_with(kind, 'phrase')) AS BIGINT) AS phrase_pairs,
       CAST(sum(len(string_split(src, ' '))) AS BIGINT) AS source_words FROM d""")
def c14_corpus_manifest(spark, sf):
    """C14: totals over the combined, deduplicated pairs."""
    return corpus.corpus_manifest(c3_combine_c4_dedupe(spark, sf))
