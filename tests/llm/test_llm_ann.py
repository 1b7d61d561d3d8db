"""Nearest neighbours: recall and scores against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import ann
from basketry.llm.common import table

SF = "/root/testdata/sf0.01"


def exact(rows, queries, k=20):
    """rows: (id, vector), distinct ids."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for q in queries:
        v = x[ids == q][0]
        s = (x * v).sum(1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def recall(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q, v in want.items() if v}
    hits = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(want[q]) + 1))
        assert rows == sorted(rows, key=lambda r: (-r.score, r.vec_id))
        hits += len({r.vec_id for r in rows} & {v for v, _ in want[q]})
    return hits / sum(map(len, want.values()))


def test_query_against_brute_force(spark):
    from basketry.llm.queries import QUERIES
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    got = QUERIES["op1_hnsw_neighbours"](spark, SF).collect()
    want = exact(rows, [i for i, _ in rows if i % 20 == 0])
    assert recall(got, want) > 0.95
    vec = {i: np.asarray(v, dtype=np.float64) for i, v in rows}
    assert all(np.isclose(r.score, vec[r.query_id] @ vec[r.vec_id], rtol=1e-12, atol=1e-12) for r in got)


@pytest.mark.parametrize("kind", ["clusters", "norms", "uniform"])
def test_recall_of_one_graph(kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    if kind == "clusters":
        x = rng.normal(size=(12, 16))[rng.integers(0, 12, 3000)] + 0.02 * x
    if kind == "norms":
        x *= rng.lognormal(size=(3000, 1))
    g = ann.build(np.arange(3000), x)
    got, sc = g.search(x[:200], 200)
    want = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    found = g.ids[got[:, :20]]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found, want, strict=True)]) > 0.93
    assert all((layer < len(layer)).all() and (layer != np.arange(len(layer))[:, None]).all() for layer in g.layers)


@pytest.mark.parametrize("norms", [False, True])
def test_recall_of_a_full_shard(norms):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(8192, 64)) * (rng.lognormal(size=(8192, 1)) if norms else 1)
    g = ann.build(np.arange(8192), x)
    want = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    found = g.ids[g.search(x[:200], 320)[0]]  # far fewer than the shard holds
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found, want, strict=True)]) > 0.95


def test_ties_and_double_scores(spark):
    rng = np.random.default_rng(8)
    around = rng.normal(size=(180, 6))
    around /= np.linalg.norm(around, axis=1, keepdims=True)
    rows = [(1000, [1.0] + [0.0] * 6), *((i + 1, [0.7, *map(float, v)]) for i, v in enumerate(around))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in ann.neighbours(df, every=1000).collect())
    assert got == [(1000, i, i, 0.7) for i in range(1, 21)]
    near = ann.neighbours(df, every=20).collect()
    vec = dict(rows)
    assert all(abs(r.score - np.dot(vec[r.query_id], vec[r.vec_id])) < 1e-15 for r in near)


def test_several_shards_and_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = ann.neighbours(df, shard_rows=200, query_block=10, k=5).collect()
    want = exact(rows, [i for i in range(900) if i % 20 == 0], 5)
    assert recall(got, want) > 0.97


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0]) for i in range(100, 400)]
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0]), (7, [-1.0, 0.0]), *same]
    odd = [(40, None), (60, []), (80, [0.0, 0.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (4, [1.0, None]), (None, [1.0, 1.0]), (3, [0.0, 1.0]), (500, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows + odd], "vec_id long, embedding array<double>, rank int, v string")
    got = ann.neighbours(df).collect()
    want = exact(rows, [i for i, _ in rows if i % 20 == 0])
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: [(v, s) for _, v, s in sorted(x)] for q, x in by.items()} == want
    assert ann.neighbours(df.limit(0)).count() == 0
    assert ann.neighbours(df.where(F.col("vec_id") == 20)).count() == 0
