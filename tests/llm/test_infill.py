"""Fill-in-middle against regular expressions and slices of strings."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import infill, queries
from tests.llm.conftest import ROWS

from conftest import SF_SMALL

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?]*[\n.!?]|[^\n.!?]+", "word": r"[^\n \t]*[\n \t]|[^\n \t]+", "char": r"(?s)."}


def plain(doc_id, text, unit="line", rate=100, spm=50, seed=7):
    t = text or ""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(PATTERNS[unit], t)
    assert "".join(units) == t
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(m in t for m in infill.MARKERS) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts(n, seed):
    rnd = random.Random(seed)
    kinds = [list("ab\n"), list("a. !\n\té日\U0001F600"), ["<", "P", "S", "M", ">", "\n"], ["\n"], ["word ", "line\n", "end. ", "\r\n"], ["é", "\U0001F600"]]
    return ["".join(rnd.choices(kinds[i % len(kinds)], k=rnd.randint(0, 25))) for i in range(n)]


@pytest.mark.parametrize("unit", list(PATTERNS))
def test_op13_equals_string_slices(spark, unit):
    rows = [(i, t) for i, t in enumerate(texts(1500, 4))] + [(9001, "one\ntwo <P> three\n"), (9002, "x\n" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    done = infill.transform(df, unit, rate=80, spm=30, seed=11)
    got = done.select("doc_id", "text", "infill.*", infill.restore(F.col("infill.output"), F.col("infill.form")).alias("again")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text, unit, 80, 30, 11), (r.doc_id, r.text)
        assert r.again == r.text
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", list(PATTERNS))
def test_op13_every_cut(unit):
    """Every number of units of every text, all texts in one matrix."""
    for part in (texts(60, 5), ["", "", "\n", "a", "é", "\n\n.", ""]):
        raw = [t.encode() for t in part]
        ends = np.cumsum([len(r) for r in raw])
        start = ends - [len(r) for r in raw]
        units = infill.Boundaries(np.frombuffer(b"".join(raw), np.uint8), start, ends, unit)
        found = [re.findall(PATTERNS[unit], t) for t in part]
        assert units.n.tolist() == [len(f) for f in found]
        for k in range(30):
            k_each = np.array([min(k, len(f)) for f in found])
            want = [s + len("".join(f[:j]).encode()) for s, f, j in zip(start, found, k_each)]
            got = units.cut(k_each)
            assert got.tolist() == want
            assert units.chars(start, got).tolist() == [len("".join(f[:j])) for f, j in zip(found, k_each)]


def test_op13_odd_rows(spark, odd, none):
    done = infill.transform(odd, out="made").collect()
    assert len(done) == len(ROWS) and all(r.ids == "keep" and r.score == "keep" for r in done)
    for r in done:
        assert tuple(r.made) == plain(r.doc_id, r.text)
    assert infill.transform(none).count() == 0
    with pytest.raises(ValueError):
        infill.transform(odd, "page")


def test_op13_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op13_fill_in_middle"]).fetchall()
    got = queries.op13_fill_in_middle(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} >= {"psm", "spm"}
