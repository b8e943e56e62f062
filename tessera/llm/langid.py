"""Language identification by unigrams over a fixed public vocabulary, with the
segmentation marginalised out.

Every language has a probability for each piece of the vocabulary.  The probability of a
word is the sum over *all* ways to cut it into pieces, which a forward pass gives; a text is
scored by the product over its words, and the score of the prediction is its posterior under
equal priors.  Piece probabilities are fitted by expectation maximisation (forward-backward)
over the words of a bounded sample of the labelled rows.

Words are runs of letters, lower-cased; words of over 48 letters are scored in stretches of
48.  Sums are scaled by a constant for each character, so that no word's probability underflows,
letters outside the vocabulary (the floor) included.  Null texts and texts without a letter are ``und`` with score 0, and so is every text if
there is nothing to learn from.  Ties go to the language first in order of name.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, hold, materialise

MARK = "▁"
LONGEST = 48
#: Probability of a character by itself where the vocabulary has none; the same for all languages.
FLOOR = 1e-7
#: Factor for each character of a piece; 48 letters lie between 1e-192 (all floors) and 1e144.
SCALE = 1e3
#: Added to the expected count of every piece.
PRIOR = 0.05
#: Words whose probabilities a worker keeps, and texts that are scored in one step.
KEPT, STEP = 180_000, 250
UNDETERMINED = "und"

_WORDS = re.compile(r"[^\W\d_]+").findall
_LETTER = regex.compile(r"\p{L}").search


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.size = len(names)
        #: the factor of each piece, the floor's in the end
        self.scale = np.append(SCALE ** np.array([len(p) for p in names], float), SCALE)[:, None]
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(names):
            self.automaton.add_word(p, len(p) << 20 | i)
        self.automaton.make_automaton()

    def lattice(self, words: list[str]):
        """All pieces inside ``words``: rows (start, end, piece) with nodes numbered through all
        words, in order of the end inside a word, and the bounds of each such end."""
        first = np.zeros(len(words) + 1, np.int64)  # node before each word's first character
        np.cumsum([len(w) + 1 for w in words], out=first[1:])
        found = np.fromiter((end << 32 | v for end, v in self.automaton.iter("\n".join(words))), np.int64)
        end = (found >> 32) + 1
        edges = np.stack([end - (found >> 20 & 0xFFF), end, found & 0xFFFFF], 1)
        nodes = np.arange(first[-1])
        inner = np.setdiff1d(nodes, first[:-1], assume_unique=True)
        edges = np.concatenate([edges, np.stack([inner - 1, inner, np.full(len(inner), -1)], 1)])
        depth = edges[:, 1] - first[np.searchsorted(first, edges[:, 1], "right") - 1]
        order = np.lexsort((edges[:, 1], depth))
        edges, depth = edges[order], depth[order]
        return first, edges, np.searchsorted(depth, np.arange(1, LONGEST + 3))

    def forward(self, words: list[str], model: np.ndarray):
        """Scaled node sums (nodes x languages) and the lattice; ``model``: (pieces + 1) x languages,
        the last row being the floor."""
        first, edges, bounds = self.lattice(words)
        model = model * self.scale
        alpha = np.zeros((first[-1], model.shape[1]))
        alpha[first[:-1]] = 1.0
        for a, b in zip(bounds, bounds[1:]):
            if a < b:
                step = edges[a:b]
                ends = np.flatnonzero(np.r_[True, step[1:, 1] != step[:-1, 1]])
                alpha[step[ends, 1]] = np.add.reduceat(alpha[step[:, 0]] * model[step[:, 2]], ends, axis=0)
        return alpha, first, edges, bounds

    def log_likelihood(self, words: list[str], model: np.ndarray) -> np.ndarray:
        alpha, first, _, _ = self.forward(words, model)
        return np.log(alpha[first[1:] - 1]) - (np.diff(first) - 1)[:, None] * np.log(SCALE)

    def expected(self, words: list[str], weight: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces (one language), each word with its weight."""
        alpha, first, edges, bounds = self.forward(words, model)
        alpha = alpha[:, 0]
        beta = np.zeros(len(alpha))
        beta[first[1:] - 1] = weight / alpha[first[1:] - 1]
        p = (model * self.scale)[:, 0]
        for a, b in reversed(list(zip(bounds, bounds[1:]))):
            np.add.at(beta, edges[a:b, 0], beta[edges[a:b, 1]] * p[edges[a:b, 2]])
        share = alpha[edges[:, 0]] * p[edges[:, 2]] * beta[edges[:, 1]]
        known = edges[:, 2] >= 0
        return np.bincount(edges[known, 2], share[known], self.size)


@functools.lru_cache(2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def stretches(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Marked words in stretches of bounded length, and the word that each belongs to."""
    out, owner = [], []
    for i, w in enumerate(words):
        w = MARK + w
        for a in range(0, len(w), LONGEST):
            out.append(w[a:a + LONGEST])
            owner.append(i)
    return out, np.array(owner, np.int64)


class Model:
    """Piece probabilities of each language: at most vocabulary x languages numbers."""

    def __init__(self, path: str, languages: list[str], table: np.ndarray):
        self.path, self.languages, self.table = path, languages, table

    def scorer(self):
        """Function of a text giving (language, posterior); one for each task."""
        vocabulary, table, names = load(self.path), self.table, self.languages
        known: dict[str, int] = {}
        rows = np.zeros((0, len(names)))

        def many(texts: list[str | None]) -> list[tuple[str, float]]:
            nonlocal rows
            words = [words_of(t) if t and _LETTER(t) else [] for t in texts]
            if len(known) > KEPT:
                known.clear()
                rows = rows[:0]
            new = list(set().union(*words).difference(known))
            for a in range(0, len(new), 5000):
                part = new[a:a + 5000]
                cut, owner = stretches(part)
                known.update(zip(part, range(len(rows), len(rows) + len(part))))
                own = np.zeros((len(part), len(names)))
                np.add.at(own, owner, vocabulary.log_likelihood(cut, table))
                rows = np.concatenate([rows, own])
            out = []
            for w in words:
                if not w or not names:
                    out.append((UNDETERMINED, 0.0))
                    continue
                x = rows[np.fromiter(map(known.__getitem__, w), np.int64, len(w))].sum(0)
                best = int(x.argmax())
                out.append((names[best], float(1 / np.exp(x - x[best]).sum())))
            return out

        return many


def drawn(labelled: DataFrame, per_language: int, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``lang`` and ``text`` of about ``per_language`` rows of each language (all, if it has fewer), chosen by a
    hash of the text and, where there is one, the row's ``doc_id``: copies of a text are chosen one
    by one."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")) if doc_id in labelled.columns else F.lit("")
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), key.alias("key")).dropna()
    # one number for each language: less than the model itself
    n_rows = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if n_rows:
        share = F.create_map(*[F.lit(x) for g, n in n_rows.items() for x in (g, min(1.0, per_language / n))])[F.col("lang")]
    else:
        share = F.lit(0.0)
    draw = F.pmod(F.xxhash64("text", "key", F.lit("langid")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return rows.where(draw < share).select("lang", "text")


def fit(labelled: DataFrame, path: str, per_language: int = 1500, rounds: int = 2,
        text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Learn from the rows that ``drawn`` chooses among those with a text and a language."""
    sample = drawn(labelled, per_language, text, lang, doc_id)

    def count(source):
        for batch in source:
            n: dict[tuple[str, str], int] = {}
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in words_of(t):
                    n[g, w] = n.get((g, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.string()),
                                              pa.array(list(n.values()), pa.int64())], ["lang", "word", "n"])

    words = materialise(sample.mapInArrow(count, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    size = load(path).size
    # languages x vocabulary: the size of the model itself
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    table = np.full((size + 1, len(languages)), 1.0 / size)
    for _ in range(rounds if languages else 0):
        now = Model(path, languages, table)

        def expect(source):
            hold("langid", _forget)
            vocabulary = load(now.path)
            at = {g: i for i, g in enumerate(now.languages)}
            total = np.zeros((vocabulary.size, len(now.languages)))
            for batch in source:
                frame = batch.to_pandas()
                for g, part in frame.groupby("lang"):
                    own = now.table[:, [at[g]]].copy()
                    own[-1] = FLOOR
                    cut, owner = stretches(part["word"].tolist())
                    total[:, at[g]] += vocabulary.expected(cut, part["n"].to_numpy(float)[owner], own)
            i, j = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(i, pa.int32()), pa.array(total[i, j])], ["lang", "piece", "n"])

        got = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        n = np.full((size, len(languages)), PRIOR)
        n[got["piece"], got["lang"]] += got["n"]
        table = np.vstack([n / n.sum(0), np.full((1, len(languages)), FLOOR)])
        if not np.isfinite(table).all():
            raise FloatingPointError("piece probabilities that are no numbers")
    return Model(path, languages, table)


def predict_column(text: Column, model: Model) -> Column:
    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(source: pa.Array) -> pa.Array:
        many = _scorer(model)
        out = []
        for a in range(0, len(source), STEP):
            out += many(source[a:a + STEP].to_pylist())
            if (a // STEP) % 4 == 3 or a + STEP >= len(source):
                give_back()
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["lang", "score"])

    return predict(text)


_live: dict = {}


def _forget() -> None:
    _live.clear()
    load.cache_clear()


def _scorer(model: Model):
    """The worker's scorer of a model; it and its memo go when another model comes."""
    hold("langid", _forget)
    key = (model.path, tuple(model.languages), hash(model.table.tobytes()))
    if key not in _live:
        _live.clear()
        _live[key] = model.scorer()
    return _live[key]


def identify(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Add a struct of the predicted language and its posterior as column ``out``."""
    return df.withColumn(out, predict_column(F.col(text), model))
