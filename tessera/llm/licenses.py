"""Licence scan with ordered signature rules, with DataFrame functions only.

Texts are normalised to lower-case words with one space between them.  A keyword prefilter
decides which rules see a text at all: a rule's pattern runs only if its keyword occurs.
Detections then compete: one that lies inside a longer one goes, and of two that cover the
same words the rule of higher priority (the earlier line) stays.  The labels of what is
left, and of the base phrases, are the text's labels; its score is the largest weight among
them (a base phrase: 0.5).

Nothing is shuffled: a text's detections are arrays in its own row.  Null text counts as
empty and has no words, no places and no labels.  Whole texts are scanned, in time linear in
their detections (up to sorting).  Repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.license_rules import Rule, rules

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_WEIGHT = 0.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RULE = "array<struct<kw:string,rules:array<struct<p:int,rx:string,label:string,w:double>>>>"
_HIT = "struct<s:int,ne:int,p:int,label:string,w:double>"


def normalised(text: Column) -> Column:
    """`` w1 w2 ... `` with a space on either side; one space for no words."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    flat = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(flat == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _spaces(x: Column) -> Column:
    return (F.length(x) - F.length(F.translate(x, " ", ""))).cast("long")


def _phrase(n: Column, phrase: str) -> Column:
    """How often a phrase stands, and the words before its first and last place."""
    around = f" {phrase} "
    count = (F.length(n) - F.length(F.regexp_replace(n, f"(?<= ){phrase}(?= )", ""))) / len(phrase)
    first = F.locate(around, n)
    last = F.length(n) - F.locate(around[::-1], F.reverse(n)) - len(around) + 2
    return F.when(n.contains(around), F.struct(
        count.cast("long").alias("n"), (_spaces(F.substring(n, F.lit(1), first)) - 1).alias("first"),
        (_spaces(F.substring(n, F.lit(1), last)) - 1).alias("last"), F.lit(PHRASES.get(phrase, phrase)).alias("label")))


#: Items that are scanned one by one.  A step of an aggregation copies what it carries, so long
#: arrays are scanned in blocks, each from the value that the blocks before it give.
_BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scanned(items: Column, total, combine, step) -> Column:
    """Hits that ``step(number so far, item)`` (the new number, a hit, whether it is wanted) gives in turn; ``total``
    is a block's number, ``combine`` puts two together."""
    def in_block(block: Column, first: Column) -> Column:
        def one(a: Column, item: Column) -> Column:
            number, hit, wanted = step(a["number"], item)
            return F.struct(number.alias("number"), F.when(wanted, F.concat(a["hits"], F.array(hit))).otherwise(a["hits"]).alias("hits"))

        return F.aggregate(block, F.struct(first.alias("number"), F.array().cast(f"array<{_HIT}>").alias("hits")), one, lambda a: a["hits"])

    def in_blocks(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("number"), F.array().cast("array<int>").alias("firsts"))
        firsts = F.aggregate(F.transform(blocks, total), start, lambda a, n: F.struct(
            combine(a["number"], n).alias("number"), F.concat(a["firsts"], F.array(a["number"])).alias("firsts")), lambda a: a["firsts"])
        return _let(firsts, lambda f: F.flatten(F.transform(blocks, lambda block, i: in_block(block, F.get(f, i)))))

    def cut(every: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / _BLOCK).cast("int"))
        return F.when(F.size(every) <= _BLOCK, in_block(every, F.lit(0))).otherwise(
            _let(F.transform(numbers, lambda b: F.slice(every, b * _BLOCK + 1, _BLOCK)), in_blocks))

    return _let(items, cut)


def _detections(n: Column, rule: Column) -> Column:
    """All places of a rule's pattern: start and (negated, so that longer ones sort first) end."""
    # the parts between the matches and the matches themselves, in turn, add up to the text
    turns = F.arrays_zip(F.split(n, rule["rx"], -1).alias("part"), F.regexp_extract_all(n, rule["rx"], F.lit(0)).alias("hit"))

    def length(t: Column) -> Column:
        return F.length(t["part"]) + F.coalesce(F.length(t["hit"]), F.lit(0))

    def step(at: Column, t: Column):
        hit = F.struct((at + F.length(t["part"])).alias("s"), (-(at + length(t))).alias("ne"), rule["p"].alias("p"), rule["label"].alias("label"), rule["w"].alias("w"))
        return at + length(t), hit, t["hit"].isNotNull()

    return _scanned(turns, lambda block: F.aggregate(block, F.lit(0), lambda a, t: a + length(t)), lambda a, b: a + b, step)


def _survivors(hits: Column) -> Column:
    """Detections that lie in no other.  In order of start, longest and highest priority first,
    a detection lies in an earlier one exactly if that one ends no sooner; the furthest end so
    far is enough to tell."""
    def step(end: Column, h: Column):
        return F.greatest(end, -h["ne"]), h, end < -h["ne"]

    return _scanned(F.sort_array(hits), lambda block: F.array_max(F.transform(block, lambda h: -h["ne"])), F.greatest, step)


def scan(df: DataFrame, text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """``df`` without ``text``, with ``n_words``, ``n_base`` (places of base phrases),
    ``first_word``, ``last_word``, ``base_labels``, ``detections`` (start, end as characters of
    the normalised text, label, weight), ``labels`` and ``score``; columns of these names are
    replaced."""
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score"]
    keep = [F.col(f"`{c}`") for c in df.columns if c != text and c not in made]
    by_keyword: dict[str, list] = {}
    for r in signatures if signatures is not None else rules():
        by_keyword.setdefault(r.keyword, []).append({"p": r.priority, "rx": r.pattern, "label": r.label, "w": r.weight})
    book = F.from_json(F.lit(json.dumps([{"kw": k, "rules": v} for k, v in by_keyword.items()])), _RULE)
    n = F.col("__n")
    words = df.select(*keep, normalised(F.col(f"`{text}`")).alias("__n"))
    gated = words.select("*", F.flatten(F.transform(F.filter(book, lambda b: n.contains(b["kw"])), lambda b: b["rules"])).alias("__rules"),
                         F.array_compact(F.array(*[_phrase(n, p) for p in PHRASES])).alias("__base"))
    found = gated.select(*keep, (_spaces(n) - 1).alias("n_words"), "__base",
                         F.when(F.size("__rules") == 0, F.array().cast(f"array<{_HIT}>"))
                         .otherwise(_survivors(F.flatten(F.transform("__rules", lambda r: _detections(n, r))))).alias("__hits"))
    base, hits = F.col("__base"), F.col("__hits")
    base_labels = F.array_sort(F.transform(base, lambda b: b["label"]))
    weights = F.concat(F.transform(hits, lambda h: h["w"]), F.transform(base, lambda b: F.lit(BASE_WEIGHT)))
    return found.select(
        *keep, "n_words", F.aggregate(base, F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda b: b["last"])).alias("last_word"), base_labels.alias("base_labels"),
        F.transform(hits, lambda h: F.struct(h["s"].alias("start"), (-h["ne"]).alias("end"), h["label"].alias("label"), h["w"].alias("weight"))).alias("detections"),
        F.array_sort(F.array_distinct(F.concat(base_labels, F.transform(hits, lambda h: h["label"])))).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"))
