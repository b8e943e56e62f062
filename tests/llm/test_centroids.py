"""k-means by ns-bounds against plain rounds."""

import hashlib
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import centroids, queries

from conftest import SF_SMALL


def plain(rows, k, rounds, scale, seed, dim):
    """All distances in every round; ``rows``: (id, vector) of the vectors that take part."""
    rows = [(i, np.floor(np.array(v, np.float64) * scale).astype(np.int64), list(v)) for i, v in rows]
    order = sorted((i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", v) for i, _, v in rows)
    c = np.array([np.floor(np.array(v) * scale) for *_, v in order[:k]], np.int64)
    x = np.array([v for _, v, _ in rows])
    for r in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        a = d.argmin(1)
        if r < rounds:
            c = np.array([x[a == j].sum(0) // (a == j).sum() if (a == j).any() else c[j] for j in range(len(c))])
    return sorted(((i, int(j), int(d[n, j])) for n, ((i, *_), j) in enumerate(zip(rows, a))), key=lambda r: (r[0] is None, str(r[0]).zfill(9), r[1:])), c


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("k,rounds,dim,scale", [(7, 6, 3, 4.0), (40, 5, 8, 256.0), (5, 0, 2, 1.0), (300, 2, 4, 16.0)])
def test_op11_equals_plain_rounds(spark, k, rounds, dim, scale):
    rng = np.random.RandomState(k)
    rows = [(i, (rng.randn(dim) + 3 * rng.randint(0, 4, dim)).tolist()) for i in range(250)]
    want, c = plain(rows, k, rounds, scale, 2, dim)
    got = centroids.cluster(frame(spark, rows), k, rounds, dim, scale, block=16)
    assert sorted(map(tuple, got.rows.collect())) == sorted(want) and (got.centroids == c).all()
    assert sum(got.inertia) == sum(d for *_, d in want)
    assert got.scanned[0] == 250 * min(k, 250) and len(got.scanned) == rounds + 1


def test_op11_ties_and_copies(spark):
    """Small whole numbers: many vectors are as near to several centroids."""
    rng = np.random.RandomState(1)
    rows = [(i, rng.randint(0, 3, 4).astype(float).tolist()) for i in range(400)]
    want, _ = plain(rows, 30, 4, 1.0, 2, 4)
    got = centroids.cluster(frame(spark, rows), 30, 4, 4, 1.0, block=64)
    assert sorted(map(tuple, got.rows.collect())) == sorted(want)


def test_op11_bounds_save_distances(spark):
    rng = np.random.RandomState(3)
    centre = rng.randn(12, 16) * 5
    rows = [(i, (centre[i % 12] + rng.randn(16)).tolist()) for i in range(1200)]
    got = centroids.cluster(frame(spark, rows), 12, 6, 16)
    assert got.scanned[-1] < got.scanned[0] / 5
    want, _ = plain(rows, 12, 6, 256.0, 2, 16)
    assert sorted(map(tuple, got.rows.collect())) == sorted(want)


def test_op11_state_bounds_hold():
    """After every round the loosened bounds enclose the true distances, and the norm of the total
    displacement is never above the sum of the drifts."""
    rng = np.random.RandomState(5)
    x = rng.randint(-500, 500, (300, 6))
    state, history = centroids.State(x), rng.randint(-500, 500, (1, 9, 6))
    state.start(history[0])
    for _ in range(8):
        history = np.concatenate([history, history[-1:] + rng.randint(-60, 60, (1, 9, 6))])
        moved = np.sqrt(((history - history[-1]) ** 2).sum(2))
        drifts = np.sqrt(((history[1:] - history[:-1]) ** 2).sum(2))
        assert all((moved[t] <= drifts[t:].sum(0) + 1e-9).all() for t in range(len(drifts)))
        state.assign(history, moved)
        true = np.sqrt(((x[:, None] - history[-1][None]) ** 2).sum(2))
        loose = moved[state.since, np.arange(9)[None]]
        assert (state.bound - loose <= true + 1e-3).all() and (true <= state.bound + loose + 1e-3).all()
        assert (state.cluster == ((x[:, None] - history[-1][None]) ** 2).sum(2).argmin(1)).all()


def test_op11_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0]), (None, [5.1, 5.0]), (None, [5.1, 5.0]), (3, [-2.0, 0.5])]
    odd = [(4, None), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [None, 1.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (None, None)]
    df = frame(spark, good + odd).withColumns({n: F.lit("x") for n in ("cluster", "v", "ids", "n", "distance")})
    got = centroids.cluster(df, 3, 4, 2, 10.0)
    want, c = plain(good, 3, 4, 10.0, 2, 2)  # rows without an id are the last seeds
    assert sorted(map(tuple, got.rows.collect()), key=str) == sorted(want, key=str) and (got.centroids == c).all()
    few = centroids.cluster(frame(spark, good[:2]), 5, 3, 2)  # fewer vectors than clusters
    assert len(few.centroids) == 2 and sorted(map(tuple, few.rows.collect())) == [(1, 0, 0), (1, 0, 0)]
    none = centroids.cluster(frame(spark, odd), 5, 3, 2)
    assert centroids.described(none).count() == 0 and centroids.described(none).columns[-1] == "centroid_sha256"
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(frame(spark, [(1, [1e30, 1.0])]), 1, 1, 2).rows.collect()


def test_op11_leaves_one_table_behind(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    got = centroids.cluster(frame(spark, [(i, [float(i), 1.0]) for i in range(50)]), 4, 6, 2)
    assert got.rows.count() == 50 and len(set(os.listdir(folder)) - before) == 1


def test_op11_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF_SMALL}/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL["op11_centroid_clustering"]).fetchall()
    assert sorted(map(tuple, queries.op11_centroid_clustering(spark, SF_SMALL).collect())) == sorted(want)
