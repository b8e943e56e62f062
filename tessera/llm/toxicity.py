"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses, and each word gets a class - insult, threat, target ("you"),
negation, reported speech, or none.  Five small transducers, given as transition tables,
read the classes one after another: the target's marks insults and threats in its scope as
aimed, the negation's those in its scope as denied, reported speech those up to the end of the
clause as reported; the insult's lets insults out along the arc of their marks, the threat's
threats, but only aimed ones.  Their composition is one table, built once, that a clause is run
through.  What comes out is matched clauses: a weight on one of eight arcs (aimed or not,
denied or not, reported or not).  The arcs' weights, as sums and as shares of the text, are
all that the logistic model sees; an insult that nothing aims at has an arc of its own, whose
weight is learned like the others.

Target, negation, report and threat words are fixed lists.  Insults are learned: whole words
and word beginnings, weighted by the log odds of the documents that hold them.  Learning
uses a bounded sample of the labelled rows (``TOXIC`` and ``CLEAN`` of them), two thirds for
the words and the rest for the weights of the arcs; copies of a text count once, as toxic if
one of them is.

Null and empty texts have no clause and get the score of that; very long texts are read whole.
Repeated rows are scored each, an empty table gives no rows, other columns are passed through
whatever their names but ``out``.  If the labelled rows lack
one of the classes, every score is the smoothed share of toxic ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hold, materialise

#: Labelled rows that are looked at, of either class.
TOXIC, CLEAN = 4000, 12_000
#: Documents that must hold a learned term, and its least log odds.
SUPPORT, ODDS = 3, 3.0
SHORTEST, LONGEST = 3, 8

TARGETS = frozenset("you your you're youre u he she they him her them his their du dich dir dein deine ihr euch sie er tu te toi ton ta "
                    "vous votre il elle ils tú usted ustedes ti vosotros él ella ellos".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't doesn't nobody without nicht kein keine nie niemals ne pas jamais aucun "
                      "nunca jamás sin tampoco".split())
REPORTS = frozenset("said says say told wrote writes quoted quote called claimed reported according sagte sagt schrieb nannte dit disait "
                    "écrit appelé dijo dice escribió llamó".split())
THREATS = frozenset("kill murder hurt destroy beat shoot stab die strangle töten umbringen verletzen schlagen tuer frapper détruire matar "
                    "golpear herir morir".split())
#: Words that a target or a negation reaches.
AIM, DENY = 6, 3
ARCS = 8
THREAT_WEIGHT = 2.0

_CLAUSES = regex.compile(r"[.!?;:\n]+|(?<=\s)-(?=\s)").split
_WORDS = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}]+)?").findall


#: Word classes, and the marks that a symbol collects on its way.
NONE, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
AIMED, DENIED, REPORTED = 1, 2, 4
SYMBOLS = 6 * ARCS  # a class with its marks
GONE = SYMBOLS


class Transducer:
    """Tables ``next[state][symbol]`` and ``out[state][symbol]``; a clause starts in state 0."""

    def __init__(self, next_: list[list[int]], out: list[list[int]]):
        self.next, self.out = next_, out

    @classmethod
    def marking(cls, opener: int, reach: int, mark: int) -> Transducer:
        """Marks insults and threats that stand up to ``reach`` words after an opener (0: to the end of the
        clause).  The state is how many words the scope still has."""
        states = range(max(reach, 1) + 1)
        next_ = [[(reach or 1) if s // ARCS == opener else state if not reach else max(state - 1, 0) for s in range(SYMBOLS)] for state in states]
        out = [[s | mark if state and s // ARCS in (INSULT, THREAT) else s for s in range(SYMBOLS)] for state in states]
        return cls(next_, out)

    @classmethod
    def matching(cls, kind: int, needs: int) -> Transducer:
        """Lets symbols of a class through if they have the marks it needs, drops them otherwise."""
        return cls([[0] * SYMBOLS], [[GONE if s // ARCS == kind and s % ARCS & needs != needs else s for s in range(SYMBOLS)]])


TRANSDUCERS = (Transducer.marking(TARGET, AIM, AIMED), Transducer.marking(NEGATION, DENY, DENIED), Transducer.marking(REPORT, 0, REPORTED),
               Transducer.matching(INSULT, 0), Transducer.matching(THREAT, AIMED))


def compose(transducers=TRANSDUCERS) -> tuple[list[list[int]], list[list[int]]]:
    """One table for the cascade: ``next[state][class]`` and the arc on which a word of the class goes out
    (-1: on none).  States are those that can be reached."""
    start = (0,) * len(transducers)
    number, todo, next_, arcs = {start: 0}, [start], [], []
    for states in todo:
        row, out = [], []
        for kind in range(6):
            symbol, after = kind * ARCS, []
            for t, state in zip(transducers, states):
                after.append(t.next[state][symbol] if symbol != GONE else state)
                symbol = t.out[state][symbol] if symbol != GONE else GONE
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
            out.append(symbol % ARCS if symbol != GONE and symbol // ARCS in (INSULT, THREAT) else -1)
        next_.append(row)
        arcs.append(out)
    return next_, arcs


NEXT, ARC = compose()


def terms(word: str) -> list[str]:
    """A word, and its beginnings marked with a star."""
    return [word, *[word[:k] + "*" for k in range(SHORTEST, min(LONGEST, len(word)) + 1)]]


class Grammar:
    """Learned words and arc weights."""

    def __init__(self, insults: dict[str, float], scale: np.ndarray | None = None, weights: np.ndarray | None = None, bias: float = 0.0):
        self.insults, self.scale, self.weights, self.bias = insults, scale, weights, bias
        self.known: dict[str, tuple[int, float]] = {}

    def _class(self, word: str) -> tuple[int, float]:
        """Class and weight of a word."""
        w = max((self.insults[t] for t in terms(word) if t in self.insults), default=0.0)
        if w:
            out = (INSULT, w)
        else:
            out = next(((k, THREAT_WEIGHT) for k, s in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) if word in s), (NONE, 0.0))
        if len(self.known) >= 300_000:
            self.known.clear()
        self.known[word] = out
        return out

    def matched(self, text: str | None) -> tuple[list[float], int]:
        """Weight that the clauses send out along each arc, and the words of the text."""
        arcs, n, known = [0.0] * ARCS, 0, self.known
        for clause in _CLAUSES(text.lower()) if text else ():
            words = _WORDS(clause)
            n += len(words)
            found = [known.get(w) or self._class(w) for w in words]
            if not any(c in (INSULT, THREAT) for c, _ in found):
                continue  # nothing can come out
            state = 0
            for c, w in found:
                arc = ARC[state][c]
                if arc >= 0:
                    arcs[arc] += w
                state = NEXT[state][c]
        return arcs, n

    def features(self, text: str | None) -> np.ndarray:
        """The arcs' weights as sums and by thousand words."""
        arcs, n = self.matched(text)
        arcs = np.array(arcs)
        return np.log1p(np.concatenate([arcs, 1000.0 * arcs / max(n, 20)]))

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return float(1 / (1 + np.exp(-self.bias)))
        return float(1 / (1 + np.exp(-np.clip(self.features(text) / self.scale @ self.weights + self.bias, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Scale of the features, weights and bias, by Newton steps."""
    scale = np.maximum(x.std(0), 0.1)
    a = np.c_[x / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9), a.T @ (p - y) + penalty * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return scale, w[:-1], float(w[-1])


def _constant(n: dict[int, int]) -> Grammar:
    """A grammar without words that gives everything the smoothed share of toxic labels."""
    share = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1.0) if n else 0.1
    return Grammar({}, bias=float(np.log(share / (1 - share))))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        most_toxic: int = TOXIC, most_clean: int = CLEAN) -> Grammar:
    """Learn from the texts of ``docs`` whose id has a label of 0 or 1 in ``labels``."""
    told = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    n = {r["y"]: r["n"] for r in told.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return _constant(n)
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    wanted = F.when(F.col("y") == 1, F.lit(most_toxic / n[1])).otherwise(F.lit(most_clean / n[0]))
    # ids and labels only, and a bounded number of them: the texts aren't shuffled to be chosen
    chosen = F.broadcast(told.where(draw < wanted).limit(2 * (most_toxic + most_clean)))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null")
    sample = materialise(rows.join(chosen, "id").groupBy("text").agg(F.max("y").alias("y"))
                         .withColumn("part", F.pmod(F.xxhash64(F.substring("text", 1, 40)), F.lit(3))))

    def count(source):
        for batch in source:
            n: dict[str, list[int]] = {}
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in {s for w in set(_WORDS(t.lower())) for s in terms(w)}:
                    n.setdefault(term, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([v[0] for v in n.values()], pa.int64()),
                                              pa.array([v[1] for v in n.values()], pa.int64())], ["term", "n0", "n1"])

    learn = sample.where("part < 2")
    size = {r["y"]: r["n"] for r in learn.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    # at most a few terms for each toxic document of the bounded sample
    got = (learn.select("text", "y").mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
           .where((F.col("n1") >= SUPPORT) & (odds >= ODDS)).select("term", odds.alias("w")).toPandas())
    grammar = Grammar(dict(zip(got["term"], got["w"].round(6))))
    held = sample.where("part = 2")

    def features(source):
        for batch in source:
            x = [grammar.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    seen = held.select("text", "y").mapInArrow(features, "y int, x array<double>").toPandas()  # bounded by the sample
    y = seen["y"].to_numpy(float)
    if 0 < y.sum() < len(y):
        x = np.array(seen["x"].tolist())
    else:  # too few rows to keep some for the arcs
        seen = sample.select("text", "y").mapInArrow(features, "y int, x array<double>").toPandas()
        x, y = np.array(seen["x"].tolist()), seen["y"].to_numpy(float)
        if not 0 < y.sum() < len(y):  # the labelled documents are not there
            return _constant(n)
    return Grammar(grammar.insults, *_logistic(x, y))


def score_column(text: Column, grammar: Grammar) -> Column:
    """Score from 0 to 1."""
    parts = (grammar.insults, grammar.scale, grammar.weights, grammar.bias)

    @F.arrow_udf("double")
    def score(source: pa.Array) -> pa.Array:
        g = _live(parts)
        return pa.array([g.score(t.as_py()) for t in source], pa.float64())

    return score(text)


_grammars: dict[tuple, Grammar] = {}


def _live(parts: tuple) -> Grammar:
    """The worker's grammar with its memo of words."""
    hold("toxicity", _grammars.clear)
    key = (len(parts[0]), hash(frozenset(parts[0].items())), parts[3])
    if key not in _grammars:
        _grammars.clear()
        _grammars[key] = Grammar(*parts)
    return _grammars[key]


def score(df: DataFrame, grammar: Grammar, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of ``text`` as column ``out``."""
    return df.withColumn(out, score_column(F.col(text), grammar))
