"""String and scalar column expressions.

All of these are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import round_fp

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference behaviour.
# ---------------------------------------------------------------------------
# Characters allowed in a submitted term (the configured term charset).
TERM_CHARSET = "abcdefghijklmnoprstuvwyzäìABCDEFGHIJKLMNOPRSTUVWYZÄÌ'ʼ "
# Characters kept in out-of-vocabulary metric labels besides letters/digits.
OOV_EXTRA_CHARS = "ìäáéíóúñ"
# Characters that mark a line as a source-language line.
SOURCE_MARK_CHARS = "ìäéù'"
# Lower-cased line openings that mark a line as English (not a source line).
ENGLISH_STARTERS = (
    "the ", "a ", "an ", "this ", "that ", "it ", "he ", "she ",
    "we ", "they ", "you ", "i ", "in ", "on ", "at ", "for ",
    "note:", "see ", "from ", "as ", "but ", "so ", "if ",
)
# Part-of-speech abbreviations that mark a vocabulary entry line.
POS_MARKERS = ("n", "v", "adj", "adv", "intj", "part", "conj", "adp")
# HTML entity decoding, applied in this order after tags are removed.
HTML_ENTITIES = (
    ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
    ("&#8216;", "‘"), ("&#8217;", "’"),
    ("&nbsp;", " "), ("&#39;", "'"),
    ("‘", "'"), ("’", "'"),
    ("“", '"'), ("”", '"'),
)
# Line terminators recognised when splitting text into lines.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"

WS = "(?U)\\s"


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing (Unicode) whitespace."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def word_tokens(text: Column) -> Column:
    """Whitespace tokens of a text as an array (empty strings dropped)."""
    return F.filter(F.split(text, f"{WS}+"), lambda x: x != F.lit(""))


def first_token(text: Column) -> Column:
    """First whitespace token of a text, the rest of which is not split; null if there is none."""
    return F.nullif(F.regexp_extract(text, "(?U)\\S+", 0), F.lit(""))


def canonical_form(c: Column) -> Column:
    """L4: drop ``[``, ``]`` and ``/`` then strip."""
    return strip_ws(F.translate(c, "[]/", ""))


def _char_class(chars: str) -> str:
    return "".join("\\" + ch if ch in "\\[]^-&" else ch for ch in chars)


def in_charset(c: Column, chars: str = TERM_CHARSET) -> Column:
    """Every character in ``chars`` (empty string counts as inside)."""
    return c.rlike(rf"\A[{_char_class(chars)}]*\z")


def slug_speaker(term: Column, speaker: Column, term_type: Column) -> Column:
    """``speaker__term__type`` with path-unsafe characters replaced."""
    safe = F.replace(F.regexp_replace(term, '[/\\\\:*?"<>|]', "_"), F.lit(" "), F.lit("_"))
    typ = F.coalesce(F.nullif(term_type, F.lit("")), F.lit("x"))
    return F.concat_ws("__", speaker, safe, typ)


def slug_ascii(term: Column, max_len: int = 100) -> Column:
    """Non ``[a-zA-Z0-9äìÄÌ]`` → ``_``, strip ``_``, cut to ``max_len``."""
    return F.substring(F.btrim(F.regexp_replace(term, "[^a-zA-Z0-9äìÄÌ]", "_"), F.lit("_")), 1, max_len)


def primary_gloss(c: Column, cut_comma: bool = False) -> Column:
    """Text before the first ``;`` (and ``,`` for lookups), stripped; null if empty."""
    first = F.substring_index(c, ";", 1)
    if cut_comma:
        first = F.substring_index(first, ",", 1)
    return F.nullif(strip_ws(first), F.lit(""))


def clean_gloss(c: Column) -> Column:
    """Drop parentheticals and ``[X]`` echoes, collapse whitespace, trim `` ,;.``."""
    t = F.regexp_replace(c, f"{WS}*\\([^)]*\\)", "")
    t = F.regexp_replace(t, "\\[[A-Za-z]?\\]", "")
    t = F.btrim(F.regexp_replace(t, f"{WS}+", " "), F.lit(" ,;."))
    return F.coalesce(F.nullif(t, F.lit("")), F.lit("(no translation)"))


def clean_oov_word(c: Column, max_len: int = 20) -> Column:
    """Lower, keep letters/digits, cut to ``max_len``; null when empty."""
    kept = F.regexp_replace(F.lower(c), f"[^\\p{{L}}\\p{{N}}{OOV_EXTRA_CHARS}]", "")
    return F.nullif(F.substring(kept, 1, max_len), F.lit(""))


def client_id(forwarded: Column, host: Column) -> Column:
    """First part of a forwarded-for header, else host, else ``unknown``."""
    first = strip_ws(F.substring_index(forwarded, ",", 1))
    return (F.when(F.coalesce(forwarded, F.lit("")) != "", first)
            .otherwise(F.coalesce(host, F.lit("unknown"))))


def fused_confidence(a: Column, b: Column) -> Column:
    """A10: mean of two confidences rounded to 3 digits."""
    return round_fp((a + b) / 2.0, 3)


def html_to_lines(html: Column) -> Column:
    """HTML → array of stripped text lines (block closers become breaks)."""
    t = F.regexp_replace(html, "(?i)</(?:p|br|div|li|blockquote|h[1-6])[^>]*>", "\n")
    t = F.regexp_replace(t, "(?i)<br\\s*/?>", "\n")
    t = F.regexp_replace(t, "<[^>]+>", "")
    for entity, char in HTML_ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    # splitlines(): no trailing empty element for a final terminator; "" → []
    t = F.regexp_replace(t, f"(?:{LINE_BREAK})\\z", "")
    lines = F.transform(F.split(t, LINE_BREAK), strip_ws)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(lines)


def looks_like_source(line: Column, min_words: int = 2) -> Column:
    """Multi-word, not an English/metadata opening, carries source marks."""
    low = F.lower(line)
    english = F.lit(False)
    for s in ENGLISH_STARTERS:
        english = english | F.startswith(low, F.lit(s))
    meta = F.startswith(low, F.lit("http")) | F.startswith(low, F.lit("©"))
    marks = line.rlike(f"[{_char_class(SOURCE_MARK_CHARS)}]") | line.rlike("(?U)\\w'\\w")
    return ((F.length(line) >= 4) & (F.size(word_tokens(line)) >= min_words)
            & ~english & ~meta & marks)


def quoted_target(line: Column) -> Column:
    """Single-quoted translation on a line, or null."""
    whole = "^'(.+?)'\\.?(?U)\\s*$"
    inner = "'([A-Z][^']{5,}[.!?])'"
    got = (F.when(line.rlike(whole), strip_ws(F.regexp_extract(line, whole, 1)))
           .when(line.rlike(inner), strip_ws(F.regexp_extract(line, inner, 1))))
    return F.nullif(got, F.lit(""))


def clean_source(line: Column, min_words: int = 2) -> Column:
    """Strip bullets/numbers; null for vocabulary entries or < ``min_words`` words."""
    t = strip_ws(F.regexp_replace(line, "(?U)^[\\d.\\-*•–—\\s]+", ""))
    pos = "|".join(POS_MARKERS)
    reject = t.rlike("\\([a-z]+\\.,?(?U)\\s") | t.rlike(f"\\((?:{pos})\\.")
    return F.when(~reject & (F.size(word_tokens(t)) >= min_words), t)
