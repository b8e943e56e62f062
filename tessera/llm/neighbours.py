"""Nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE`` vectors) and every vector is filed under
one of its leaves, of which there are about ``LEAVES`` at most: visits are rows to shuffle.  A query walks the tree best bin first: a priority queue holds the nodes
by how large an inner product they promise (that with the centre, plus the query's length
times the node's spread), and leaves are visited in the order in which they come out.  How
many are visited is calibrated: for up to ``CALIBRATION`` queries the true neighbours are
found by comparing with all vectors, and the visits are widened until the mean recall
reaches ``RECALL``.

Equal vectors are one entry with its ``k + 1`` smallest ids, more than which no answer can
hold; equal queries are searched once.  Leaves are split into blocks of ``BLOCK`` entries and
their visitors into blocks of as many queries, and a pair of blocks gives only the best
``k + 1`` of each query, so neither a crowded leaf nor a crowded query lands in one task.

Vectors that are null, zero, of another length than most (the shorter, if two lengths are as
frequent) or hold a null or non-finite component take no part, nor do rows without an id.
Rows that repeat an id and vector count once.  Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

SAMPLE = 20_000
CALIBRATION = 200
RECALL = 0.97
BRANCH = 12
#: Sampled vectors in a leaf, and how many leaves there are at most, about.
LEAF, LEAVES = 160, 64
BLOCK = 4096


class Tree:
    """Nodes as arrays: centre, spread, first child and number of children (0: a leaf)."""

    def __init__(self, sample: np.ndarray, leaf: int = LEAF, branch: int = BRANCH, seed: int = 7):
        self.rng = np.random.RandomState(seed)
        self.centre, self.spread, self.child, self.children = [], [], [], []
        self._add(sample)
        todo = [(0, sample)]
        while todo:
            node, x = todo.pop()
            if len(x) <= leaf:
                continue
            label = self._split(x, branch)
            parts = [x[label == j] for j in np.unique(label)]
            if len(parts) < 2:
                continue
            self.child[node], self.children[node] = len(self.centre), len(parts)
            for p in parts:
                todo.append((len(self.centre), p))
                self._add(p)
        self.centre = np.array(self.centre)
        self.spread = np.array(self.spread)
        del self.rng

    def _add(self, x: np.ndarray) -> None:
        c = x.mean(0)
        self.centre.append(c)
        self.spread.append(float(np.sqrt(((x - c) ** 2).sum(1).mean())))
        self.child.append(0)
        self.children.append(0)

    def _split(self, x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
        c = x[self.rng.choice(len(x), min(k, len(x)), replace=False)]
        for _ in range(rounds):
            label = ((c ** 2).sum(1) - 2 * x @ c.T).argmin(1)
            c = np.array([x[label == j].mean(0) if (label == j).any() else c[j] for j in range(len(c))])
        return ((c ** 2).sum(1) - 2 * x @ c.T).argmin(1)

    def file(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: down to the nearest centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node] or not len(rows):
                out[rows] = node
                continue
            first, n = self.child[node], self.children[node]
            c = self.centre[first:first + n]
            label = ((c ** 2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            todo += [(first + j, rows[label == j]) for j in range(n)]
        return out

    def leaves(self, q: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in the order of a best-bin-first walk, at most so many."""
        out: list[int] = []
        promise = self.centre @ q + float(np.sqrt(q @ q)) * self.spread / np.sqrt(len(q))
        queue = [(0.0, 0)]
        while queue and (most is None or len(out) < most):
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for c in range(self.child[node], self.child[node] + self.children[node]):
                    heapq.heappush(queue, (-promise[c], c))
            else:
                out.append(node)
        return out


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (array of double) of the rows that take part."""
    v = F.col("v")
    rows = (df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .where("vec_id is not null and v is not null")
            .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return rows.join(F.broadcast(size.select("n")), F.size("v") == F.col("n")).select("vec_id", "v")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def _best(q: np.ndarray, qkeys, x: np.ndarray, ids, k: int) -> pd.DataFrame:
    """Best ``k`` entries of each query by the exact product, ties to the entry with the smallest id.

    The fast products only preselect: all entries within their rounding of the k-th are
    measured exactly."""
    lead = np.array([i[0] for i in ids])
    length = np.sqrt((x ** 2).sum(1))
    rows = []
    for a in range(0, len(q), 256):
        part = q[a:a + 256]
        s = part @ x.T
        slack = 1e-12 * np.sqrt((part ** 2).sum(1))[:, None] * length[None] * max(1, x.shape[1])
        # the k-th best exact product is at least the k-th best of the lower ends
        low = np.partition(s - slack, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        i, j = np.nonzero(s + slack >= low[:, None])
        exact = np.einsum("ij,ij->i", part[i], x[j])
        order = np.lexsort((lead[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        rows += [(qkeys[a + r], float(e), ids[c]) for r, c, e in zip(i[nth < k].tolist(), j[nth < k].tolist(), exact[nth < k].tolist())]
    return pd.DataFrame(rows, columns=["qkey", "score", "ids"])


_FOUND = "qkey long, score double, ids array<long>"


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` best rows of each distinct query."""
    rows = found.select("qkey", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)


def search(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, calibration: int = CALIBRATION, recall: float = RECALL, leaf: int = LEAF,
           block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest found of each query row (``is_query``: a condition on ``vec_id``)
    among all other rows: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``."""
    spark = df.sparkSession
    rows = usable(df, vec_id, vector).distinct()
    nth = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    asked = rows.groupBy("v").agg(F.max(F.when(is_query, 1).otherwise(0)).alias("asked"))
    entries = materialise(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).join(asked, "v")
                          .select(F.xxhash64("v").alias("key"), "v", "ids", "asked"))
    n, n_asked = entries.agg(F.count("*"), F.sum("asked")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n or not n_asked:
        return empty

    def draw(part: DataFrame, most: int, of: int) -> np.ndarray:
        """About ``most`` vectors by a hash of their key; a bounded number."""
        share = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) < int(min(1.0, most / of) * (1 << 30))
        return _matrix(part.where(share).orderBy("key").limit(2 * most).toPandas()["v"]) if of else np.zeros((0, 1))

    points = draw(entries, sample, n)
    if not len(points):
        points = _matrix(entries.limit(1).toPandas()["v"])
    tree = Tree(points, max(leaf, -(-len(points) // LEAVES)))

    def file(source):
        for frame in source:
            frame["leaf"] = tree.file(_matrix(frame["v"])) if len(frame) else np.zeros(0, np.int64)
            yield frame

    filed = materialise(entries.mapInPandas(file, "key long, v array<double>, ids array<long>, asked int, leaf long"))
    queries = filed.where("asked = 1").select(F.col("key").alias("qkey"), "v")
    visits = _calibrate(filed, tree, k, calibration, recall, n_asked)

    def walk(source):
        for frame in source:
            frame["leaf"] = [tree.leaves(q, visits) for q in _matrix(frame["v"])] if len(frame) else []
            yield frame

    asked_leaves = materialise(queries.mapInPandas(walk, "qkey long, v array<double>, leaf array<long>").withColumn("leaf", F.explode("leaf")))
    # one row for each leaf at most: bounded by the sample
    sizes = (filed.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("vb"))
             .join(asked_leaves.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("qb")), "leaf"))
    v = filed.join(sizes, "leaf").select("leaf", F.pmod("key", "vb").alias("i"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("j"), "v", "ids")
    q = asked_leaves.join(sizes, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("vb") - 1)).alias("i"), F.pmod("qkey", "qb").alias("j"), "v", "qkey")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"qkey": [], "score": [], "ids": []})
        return _best(_matrix(left["v"]), left["qkey"].to_numpy(), _matrix(right["v"]), right["ids"].tolist(), k + 1)

    found = q.groupBy("leaf", "i", "j").cogroup(v.groupBy("leaf", "i", "j")).applyInPandas(compare, _FOUND)
    best = _merge(found, k).select("qkey", "score", "vec_id")
    ids = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("qkey"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # an id that stands for several vectors asks with each of them and keeps the best
    return (ids.join(best, "qkey").where("query_id <> vec_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("vec_id").cast("long"), "score"))


def _calibrate(filed: DataFrame, tree: Tree, k: int, most: int, recall: float, n_asked: int) -> int:
    """Leaves to visit: as few as give the mean recall on a bounded sample of the queries."""
    share = F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 30)) < int(min(1.0, most / n_asked) * (1 << 30))
    asked = filed.where("asked = 1").where(share).orderBy("key").limit(2 * most).select("key", "v").toPandas()
    if not len(asked):
        asked = filed.where("asked = 1").limit(most).select("key", "v").toPandas()
    q, keys = _matrix(asked["v"]), asked["key"].to_numpy()

    def truth(source):
        for frame in source:
            if len(frame):
                got = _best(q, keys, _matrix(frame["v"]), list(zip(frame["key"], frame["leaf"])), k + 1)
                got["key"], got["leaf"] = [x[0] for x in got["ids"]], [x[1] for x in got["ids"]]
                yield got[["qkey", "score", "key", "leaf"]]

    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "key")
    true = (filed.select("key", "v", "leaf").mapInPandas(truth, "qkey long, score double, key long, leaf long").where("qkey <> key")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("qkey", "leaf").toPandas())
    place = {key: {leaf: i for i, leaf in enumerate(tree.leaves(v))} for key, v in zip(keys, q)}
    true["visit"] = [place[a][b] + 1 for a, b in zip(true["qkey"], true["leaf"])]
    if not len(true):
        return 1
    for visits in range(1, int(true["visit"].max()) + 1):
        if (true["visit"] <= visits).groupby(true["qkey"]).mean().mean() >= recall:
            return visits
    return int(true["visit"].max())
