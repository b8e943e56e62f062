"""k-means in whole numbers, its distance computations saved by ns-bounds.

For every vector and centroid the last exact distance is kept together with the round in
which it was computed.  The history of the centroids (``rounds + 1`` sets of ``k``) lets a
stored distance be turned into a bound for the current round by the *norm of the sum* of all
displacements since then, that is by the distance between the centroid as it is and as it was
in that round.  Bounds from sums of per-round drifts can only be looser.  An assigned centroid whose loosened
upper bound is below all others' lower bounds stays without any computation; else its distance
is computed exactly, and each centroid that still may be nearer is scanned exactly, by whole
numbers, with ties to the smaller number.

Vectors become whole numbers (``floor(scale * x)``), so sums and distances have no rounding and
results do not depend on how rows are dealt out.  Rows are packed into blocks of up to
``BLOCK`` vectors with their bounds as matrices; a round rewrites the blocks and leaves the sums
of each block's clusters beside them, from which Spark adds up ``k * dim`` numbers.  Only
centroids reach the driver.

Vectors that are null, of another length than ``dim`` or hold a null or non-finite component
take no part.  Rows without an id do, and are drawn as seeds after all others; rows that repeat
one another are clustered each.  With fewer vectors than ``k`` there are fewer centroids; an
empty table gives no rows.  Components beyond 2**27 in size (after scaling) raise an error:
their squared distances don't fit 64 bits.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, release

BLOCK = 1024
LARGEST = 1 << 27
#: A bound must be cleared by this much, relatively: far more than roundings to 32 bits take.
SLACK = 1e-6


@dataclass
class Clustering:
    """``rows``: ``vec_id``, ``cluster``, ``distance``; ``centroids``: whole numbers; ``inertia`` of each
    cluster; ``scanned``: exact distances computed in each assignment (all of them: vectors x k)."""

    rows: DataFrame
    centroids: np.ndarray
    inertia: list[int]
    scanned: list[int]


def kept(df: DataFrame, dim: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part."""
    v = F.col("v")
    return (df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.size("v") == dim).where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    y = np.floor(x * scale)
    if len(y) and np.abs(y).max() > LARGEST:
        raise ValueError("components beyond 2**27 after scaling: squared distances would not fit 64 bits")
    return y.astype(np.int64)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two matrices, pair by pair."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class State:
    """A block: vectors, their clusters, and for each vector and centroid the last exact distance
    and its round."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.cluster = self.bound = self.since = None

    def start(self, centroids: np.ndarray) -> int:
        """Every distance, exactly."""
        exact = np.stack([squares(self.x, c[None]) for c in centroids], 1)
        self.cluster = exact.argmin(1)
        self.bound = np.sqrt(exact).astype(np.float32)
        self.since = np.zeros(exact.shape, np.int16)
        return exact.size

    def assign(self, history: np.ndarray, moved: np.ndarray) -> int:
        """Assignment to the last centroids; ``moved``: by round and centroid, the norm of the total
        displacement since.  Returns how many exact distances it took."""
        now, k = len(history) - 1, history.shape[1]
        every, own = np.arange(len(self.x)), self.cluster
        loose = moved[self.since, np.arange(k)[None]]
        bound = self.bound.astype(np.float64)
        lower = bound * (1 - SLACK) - loose * (1 + SLACK) - SLACK
        upper = (bound + loose)[every, own] * (1 + SLACK) + SLACK
        lower[every, own] = np.inf
        rows = np.flatnonzero(lower.min(1, initial=np.inf) <= upper)
        if not len(rows):
            return 0
        # the assigned centroid exactly, which tightens the upper bound
        best, square = own[rows], squares(self.x[rows], history[now, own[rows]])
        near = np.sqrt(square)
        self.bound[rows, best], self.since[rows, best] = near, now
        open_ = lower[rows] <= (near * (1 + SLACK) + SLACK)[:, None]
        for j in np.flatnonzero(open_.any(0)).tolist():
            at = np.flatnonzero(open_[:, j])
            exact = squares(self.x[rows[at]], history[now, j][None])
            self.bound[rows[at], j], self.since[rows[at], j] = np.sqrt(exact), now
            nearer = (exact < square[at]) | ((exact == square[at]) & (j < best[at]))
            best[at[nearer]], square[at[nearer]] = j, exact[nearer]
        self.cluster = own.copy()
        self.cluster[rows] = best
        return len(rows) + int(open_.sum())

    def sums(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros((k, self.x.shape[1]), np.int64)
        np.add.at(total, self.cluster, self.x)
        return np.bincount(self.cluster, minlength=k), total

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        return squares(self.x, centroids[self.cluster])


def _schema(id_type: str) -> str:
    return (f"ids array<{id_type}>, n int, x binary, cluster binary, bound binary, since binary, counts array<long>, "
            "sums array<long>, scanned long")


def _pack(ids: pa.Array, state: State, k: int, scanned: int, types: pa.Schema) -> pa.RecordBatch:
    counts, sums = state.sums(k)
    columns = {"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "n": [len(ids)], "x": [state.x.astype("<i4").tobytes()],
               "cluster": [state.cluster.astype("<i4").tobytes()], "bound": [state.bound.astype("<f4").tobytes()],
               "since": [state.since.astype("<i2").tobytes()], "counts": [counts.tolist()], "sums": [sums.ravel().tolist()], "scanned": [scanned]}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, types.field(n).type) for n, c in columns.items()], list(columns))


_TYPES = pa.schema([("ids", pa.null()), ("n", pa.int32()), ("x", pa.binary()), ("cluster", pa.binary()), ("bound", pa.binary()), ("since", pa.binary()),
                    ("counts", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64())), ("scanned", pa.int64())])


def _unpack(batch: pa.RecordBatch, i: int, dim: int, k: int) -> tuple[pa.Array, State]:
    ids, n = batch.column("ids")[i].values, batch.column("n")[i].as_py()

    def matrix(name, kind, *shape):
        return np.frombuffer(batch.column(name)[i].as_buffer(), kind).reshape(shape)

    state = State(matrix("x", "<i4", n, dim).astype(np.int64))
    state.cluster = matrix("cluster", "<i4", n).astype(np.int64)
    state.bound, state.since = matrix("bound", "<f4", n, k).copy(), matrix("since", "<i2", n, k).copy()
    return ids, state


def _totals(blocks: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors and component sums of each cluster: ``k * (dim + 1)`` numbers."""
    parts = blocks.select(F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("counts").alias("a")), F.struct(F.lit(1).alias("kind"), F.col("sums").alias("a")),
                                            F.struct(F.lit(2).alias("kind"), F.array("scanned").alias("a")))).alias("p"))
    rows = parts.select("p.kind", F.posexplode("p.a").alias("at", "value")).groupBy("kind", "at").agg(F.sum("value").alias("value")).collect()
    out = [np.zeros(k, np.int64), np.zeros(k * dim, np.int64), np.zeros(1, np.int64)]
    for r in rows:
        out[r["kind"]][r["at"]] = r["value"]
    return out[0], out[1].reshape(k, dim), int(out[2][0])


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    top = rows.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in top], np.float64)


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, seed: int = 2,
            vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> Clustering:
    """Lloyd's rounds over whole numbers: assign all vectors, replace non-empty centroids by the
    floor of their mean; after the last round assign once more."""
    if rounds >= 1 << 15:
        raise ValueError("at most 32767 rounds")
    spark = df.sparkSession
    rows = kept(df, dim, vec_id, vector)
    id_type = dict(rows.dtypes)["vec_id"]
    first = seeds(rows, k, seed)
    if not len(first):
        return Clustering(spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), np.zeros((0, dim), np.int64), [], [])
    k = len(first)
    history = whole(first, scale)[None]

    def begin(source):
        for batch in source:
            for a in range(0, batch.num_rows, block):
                part = batch.slice(a, block)
                v = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                state = State(whole(v, scale))
                scanned = state.start(history[0])
                yield _pack(part.column("vec_id"), state, k, scanned, _TYPES)

    blocks = materialise(rows.mapInArrow(begin, _schema(id_type)))
    scanned = []
    for _ in range(rounds):
        counts, sums, done = _totals(blocks, k, dim)
        scanned.append(done)
        means = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], history[-1])
        history = np.concatenate([history, means[None]])
        before, blocks = blocks, materialise(blocks.mapInArrow(_step(history, dim, k), _schema(id_type)))
        release(before)
    scanned.append(_totals(blocks, k, dim)[2])
    last = history[-1]

    def end(source):
        for batch in source:
            for i in range(batch.num_rows):
                ids, state = _unpack(batch, i, dim, k)
                yield pa.RecordBatch.from_arrays([ids, pa.array(state.cluster, pa.int32()), pa.array(state.distances(last))], ["vec_id", "cluster", "distance"])

    done = blocks.mapInArrow(end, f"vec_id {id_type}, cluster int, distance long")
    inertia = {r["cluster"]: r["i"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("i")).collect()}
    return Clustering(done, last, [inertia.get(j, 0) for j in range(k)], scanned)


def _step(history: np.ndarray, dim: int, k: int):
    now = history[-1].astype(np.float64)
    # norm of the total displacement since each round, rounded up
    moved = np.sqrt(((history - now) ** 2).sum(2)) * (1 + SLACK)

    def step(source):
        for batch in source:
            for i in range(batch.num_rows):
                ids, state = _unpack(batch, i, dim, k)
                scanned = state.assign(history, moved)
                yield _pack(ids, state, k, scanned, _TYPES)

    return step


def sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def described(done: Clustering) -> DataFrame:
    """The rows with the inertia of their cluster and of all, and their centroid's digest: one short
    row for each centroid is joined, as many as there are clusters."""
    spark = done.rows.sparkSession
    table = spark.createDataFrame([(j, i, sum(done.inertia), sha256(c)) for j, (i, c) in enumerate(zip(done.inertia, done.centroids))],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
