"""Piece encoding, packing and personal data against the libraries and plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, pieces, pii, queries
from tessera.llm.common import table
from tests.llm.conftest import ROWS

from conftest import SF_SMALL

MODEL, WORDS = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
ALPHABETS = [list("aeinstrth \n"), list("aab "), list("  \t.x"), [chr(c) for c in range(1, 300)],
             list("日本語のあア中 ▁é́\U0001F600aа"), ["the", " ", "of", "ing", "<s>", "▁"]]


def texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABETS[i % len(ALPHABETS)], k=rnd.randint(0, 30))) for i in range(n)]


def test_op1_encodes_and_decodes_as_the_library():
    sp, model = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.load(MODEL)
    for t in [*texts(6000, 1), "a" * 20_000, " " * 5000, "x y" * 3000]:
        assert model.encode(t) == sp.encode(t), t[:80]
    rnd = random.Random(2)
    for _ in range(4000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), 28705, 0, 1, 2]) for _ in range(rnd.randint(0, 8))]
        assert model.decode(ids) == sp.decode(ids)


def test_op1_backtracking_equals_merging():
    model = pieces.load(MODEL)
    rnd = random.Random(3)
    for _ in range(1500):
        word = "▁" + "".join(rnd.choices("aeinstrhlo", k=rnd.randint(1, 25)))
        assert [model.names[i] for i in model.backtrack(word)] == model.merge(word) == model._merge_long(word)


def test_op1_odd_rows(spark, odd, none):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    done = pieces.decode(pieces.encode(odd, MODEL, out="ids2"), MODEL, "ids2")
    got = done.collect()
    assert len(got) == len(ROWS) and all(r.ids == "keep" for r in got)
    for r in got:
        assert r.ids2 == sp.encode(r.text or "") and r.decoded == sp.decode(sp.encode(r.text or ""))
    assert pieces.decode(pieces.encode(none, MODEL), MODEL).count() == 0


def test_op1_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    for r in queries.op1_sentencepiece(spark, SF_SMALL).collect():
        ids = sp.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def plain_pieces(docs, size=4096):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out += [(i, k, a, len(ids[a:a + size]), zlib.crc32(np.array(ids[a:a + size], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), size))]
    return out


def order(rows):
    return sorted(rows, key=repr)


def check_packed(rows, size=4096):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_op9_ids_as_the_library():
    words, tokenizer = packing.load(WORDS), Tokenizer.from_file(WORDS)
    some = [*texts(4000, 4), "it's we'll I'd, x'st", "<|endoftext|> <|STARTOFTEXT|>a<|startoftext|>", "İstanbul ΣΑΣ. \x1c\x85\xa0x", LONG_WORD]
    for t, raw in zip(some, words.encode(some)):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


LONG_WORD = "ab" * 9000


def test_op9_best_two_fit_is_tight():
    # greedy takes 60 + 30 and leaves 10; in place of the 30, two of 20 fill the sequence
    assert packing.layouts({60: 1, 30: 1, 20: 2}, 100)[0] == ([(60, 1), (20, 2)], 1)
    rnd = random.Random(5)
    for _ in range(60):
        size = rnd.choice([7, 64, 500])
        counts = {n: rnd.randint(1, 30) for n in rnd.sample(range(1, size + 1), rnd.randint(1, min(size, 40)))}
        rows = packing.layouts(counts, size)
        used = {}
        for layout, times in rows:
            assert sum(n * k for n, k in layout) <= size
            for n, k in layout:
                used[n] = used.get(n, 0) + k * times
        assert used == counts
    assert packing.layouts({}, 10) == []


def test_op9_odd_rows_and_ties(spark, odd, none):
    got = packing.pack(packing.cut(odd, WORDS).withColumn("crc", F.crc32("ids"))).collect()
    assert order([(r.doc_id, r.piece, r.start, r.length, r.crc) for r in got]) == order(plain_pieces([(r[0], r[1]) for r in ROWS]))
    check_packed(got)
    assert packing.pack(packing.cut(none, WORDS)).count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    assert check_packed(packing.pack(packing.cut(same, WORDS, 16), 16).collect(), 16) == 125
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(5,)], "length long"), 4)


def test_op9_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = queries.op9_best_fit_packing(spark, SF_SMALL).collect()
    want = plain_pieces(docs)
    assert order([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]) == order(want)
    assert check_packed(got) <= 1.02 * sum(w[3] for w in want) / 4096 + 1


def plain_spans(t):
    """The base kinds straight from their patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_op3_base_spans():
    rnd = random.Random(6)
    for i in range(12_000):
        t = "".join(rnd.choices(["a@b.c-_% 1..@", "0123 -.", "+12 ().-345", "1.2.255.3.256.0"][i % 4], k=rnd.randint(0, 40)))
        assert [s[:3] for s in pii.find(t) if s[0] in pii.BASE] == plain_spans(t), t
    for c in ("a", "1", "a@", "1.", "+1", "A1", "1-", "@", "DE00 "):  # no pattern takes more than linear time
        pii.find(c * 60_000)


def test_op3_method_spans():
    iban, text = "DE89 3704 0044 0532 0130 00", "Bitte auf Konto {} zahlen."
    assert [(s[0], s[3]) for s in pii.find(text.format(iban)) if s[0] == "iban"] == [("iban", 1.0)]
    assert not [s for s in pii.find(text.format(iban.replace("89", "88"))) if s[0] == "iban"]
    assert [s[0] for s in pii.find("my social security number is 219-09-9999")] == ["ssn"]
    assert not pii.find("part no 219-09-9999")
    assert pii.hide("mail a@b.cd or 1.2.3.4!") == "mail [EMAIL] or [IP]!"


def plain_ibans(t):
    """From every place, past the end of the last one found."""
    out, done = [], 0
    for i in range(len(t)):
        want = pii._IBAN_LENGTH.get(t[i:i + 2])
        if i < done or not want or (i and re.match("[A-Za-z0-9]", t[i - 1])):
            continue
        m = re.compile(f"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{want - 4}}}").match(t, i)
        if m and not t[m.end():m.end() + 1].isalnum() and pii.mod97(m[0].replace(" ", "")):
            out.append(m.span())
            done = m.end()
    return out


def test_op3_ibans_beside_each_other_and_after_codes():
    one, two = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    assert [one, two, one] == [t[a:b] for t in [f"{one} {two} {one}"] for a, b in pii.ibans(t)]
    for before in ("AB12", "DE12", "NO93 1234", "REF 2024 XX99 ABC", "DE88370400440532013000"):
        assert [two] == [t[a:b] for t in [f"{before} {two}"] for a, b in pii.ibans(t)], before
    assert pii.hide(f"{one} {two}") == "[IBAN] [IBAN]"
    rnd = random.Random(8)
    bits = [one, two, "NO9386011117947", "BE68 5390 0754 7034", "MT84MALT011000012345MTLCAST001S", "AB12", "DE12", "GB82", "X", "7", "a", "-", "\n", "\xe9"]
    for _ in range(5_000):
        t = "".join(rnd.choice(bits) + rnd.choice(["", " ", " ", " ", "  "]) for _ in range(rnd.randint(0, 8)))
        assert list(pii.ibans(t)) == plain_ibans(t), t


def test_op3_odd_rows(odd, none):
    found = pii.detect(odd, out="found").collect()
    assert len(found) == len(ROWS) and all(r.found == [] and r.spans == "keep" for r in found)
    clean = pii.redact(odd).collect()
    assert order([r.text for r in clean]) == order([r[1] for r in ROWS])
    assert pii.redact(pii.detect(none)).count() == 0


def test_op3_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    got = queries.op3_pii(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain_spans(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.BASE]


def test_stages_release_what_others_hold(monkeypatch):
    """A worker that goes from one operator to the next keeps none of the former's memo and models."""
    from tessera.llm import common, langid, packing, simhash
    from tessera.llm.queries import PIECES, WORDS

    monkeypatch.setattr(common, "_memos", {})
    path = common.pieces_path(PIECES)
    table = np.full((langid.load(path).size + 1, 1), 1e-4)
    assert langid._scorer(langid.Model(path, ["en"], table))(["some words"])[0][0] == "en"
    assert langid._live and langid.load.cache_info().currsize
    common.hold("simhash", common.nothing)
    assert not langid._live and not langid.load.cache_info().currsize
    common.hold("packing", packing.load.cache_clear)
    packing.load(common.pieces_path(WORDS)).encode(["some words"])
    common.hold("langid", langid._forget)
    assert not packing.load.cache_info().currsize and list(common._memos) == ["langid"]


def test_op9_small_slices_give_the_same_pieces(odd):
    """Slices of one text each, and of all texts."""
    rows = [sorted(map(repr, packing.cut(odd, WORDS, 64, most=most).collect())) for most in (1, 1 << 23)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
