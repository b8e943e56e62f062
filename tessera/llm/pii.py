"""Personal data: patterns propose spans, checks confirm them, context words adjust the score.

Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are matched leftmost and without
overlap inside a kind; a match that fails its check is dropped and not tried again shorter.
``iban`` (length of its country, mod-97; tried from every place where one may start) and
``ssn`` (issued ranges, and a context word) are proposed as well.  Every span has a score: the prior of its kind, raised by words like
"call" or "account" shortly before it and lowered by words like "version" or "order".
``email``, ``ip``, ``card`` and ``phone`` stay whatever the score; the others need 0.5.

Null text counts as empty and has no spans.  Positions are code points, the end exclusive.
All patterns run in time linear in the text, long runs of digits or letters included; texts are
searched whole.  Rows that repeat one another are searched each, an empty table gives no rows,
and other columns are passed through whatever their names (but that of the result).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hold, nothing

#: Base kinds in the order in which spans are listed, then the method's own.
BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "ssn")
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: No match starts inside a run of digits: the first number takes the whole run or fails.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGITS = re.compile("[0-9]")

#: Length of an IBAN by country (public registry).
_IBAN_LENGTH = {"AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
                "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27,
                "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
                "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26}
#: Prior score of a confirmed span, and the words before it that raise or lower it.
_PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.75, "iban": 0.9, "ssn": 0.4}
_RAISE = {"email": "mail contact write address kontakt correo courriel",
          "ip": "ip host server address adresse login logged",
          "card": "card credit visa mastercard amex payment pay karte tarjeta carte",
          "phone": "call phone tel telephone mobile fax contact telefon teléfono téléphone",
          "iban": "iban bank account transfer konto cuenta compte",
          "ssn": "ssn social security taxpayer"}
_LOWER = {"email": "example noreply", "ip": "version release v section", "card": "order tracking isbn serial invoice",
          "phone": "order part isbn", "iban": "example", "ssn": "part order serial isbn"}
_CONTEXT = re.compile(r"[^\W\d_]+")
_REACH = 40
_RAISE, _LOWER = ({k: frozenset(v.split()) for k, v in t.items()} for t in (_RAISE, _LOWER))


def luhn(digits: str) -> bool:
    """The check sum of payment cards."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    """The check sum of account numbers."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str):
    """From each ``@``: the run of local characters before it, back to the last match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def cards(text: str):
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m[0])) <= 15:
            yield m.span()


def ibans(text: str):
    """A proposal may run on into what follows, 34 characters at most: the search goes on from
    the confirmed end, or just after the start of a failed one."""
    m = _IBAN.search(text)
    while m:
        want, end, have = _IBAN_LENGTH.get(m[0][:2]), m.start(), 0
        while want and end < m.end() and have < want:
            have += text[end] != " "
            end += 1
        if want and have == want and not text[end:end + 1].isalnum() and mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end
        else:
            end = m.start() + 1
        m = _IBAN.search(text, end)


def ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


_FINDERS = dict(zip(KINDS, (emails, ips, cards, phones, ibans, ssns)))


def score(text: str, kind: str, start: int) -> float:
    near = {w.lower() for w in _CONTEXT.findall(text, max(0, start - _REACH), start)}
    return round(min(1.0, max(0.0, _PRIOR[kind] + 0.2 * bool(near & _RAISE[kind]) - 0.3 * bool(near & _LOWER[kind]))), 3)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans of a text: by kind as listed, then start."""
    if not text:
        return []
    found = [(k, a, b, score(text, k, a)) for k, finder in _FINDERS.items() for a, b in finder(text)]
    return [s for s in found if s[0] in BASE or s[3] >= 0.5]


def spans_column(text: Column) -> Column:
    @F.arrow_udf(SPANS)
    def spans(column: pa.Array) -> pa.Array:
        hold("pii", nothing)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        rows = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t.as_py())] for t in column]
        return pa.array(rows, pa.list_(kind))

    return spans(text)


def detect(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add the spans of ``text`` as column ``out``."""
    return df.withColumn(out, spans_column(F.col(text)))


def hide(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first
    (the longer, if both start together) names the whole stretch."""
    out, at, end, label = [], 0, -1, ""
    for k, a, b, _ in sorted(find(text), key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            out.append(label)
            at = end
        out.append(text[at:a])
        label, end = f"[{k.upper()}]", b
    if end < 0:
        return text
    return "".join([*out, label, text[end:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the spans of ``text`` in place; texts without any stay as they are, null stays null."""

    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        hold("pii", nothing)
        return pa.array([hide(t.as_py()) for t in column], pa.string())

    return df.withColumn(text, clean(F.col(text)))
