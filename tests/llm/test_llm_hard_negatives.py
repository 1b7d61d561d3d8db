"""Hard negatives: residue products against exact ones, the query against plain loops, odd rows."""

import math

import numpy as np
import pytest

from basketry.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """rows: (vec_id, vector, label), usable ones."""
    ints = [(i, [math.floor(float(x) * 256) for x in v], label) for i, v, label in rows]
    out = []
    for a, v, label in sorted({(i, tuple(v), label) for i, v, label in ints if i % every == 0}):
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in ints if len(w) == len(v)))
        for ps, p, _ in [s for s in scored if s[2] == label and s[1] != a][:positives]:
            hard = [s for s in scored if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps][:negatives]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("size, depth", [(300, 64), (1 << 20, 700), ((1 << 23) + 5, 64)])
def test_products_are_exact(size, depth):
    rng = np.random.default_rng(depth)
    a, b = rng.integers(-size, size + 1, (20, depth)), rng.integers(-size, size + 1, (30, depth))
    a[0], b[0] = size, size
    b[1] = -size
    primes = H.primes_for(size * size * depth)
    assert len(set(primes)) == len(primes) and max(primes) < 512
    got = H.scores([H.residues(a, p) for p in primes], [H.residues(b, p) for p in primes], primes)
    assert np.array_equal(got, a @ b.T)


@pytest.mark.parametrize("seed, group", [(0, 16384), (1, 4), (2, 1)])
def test_against_loops(spark, seed, group):
    rng = np.random.default_rng(seed)
    # few different values: ties everywhere
    rows = [(int(i), (rng.integers(-2, 6, 6) / 4).astype(np.float32).tolist(), int(rng.integers(3))) for i in rng.permutation(400)]
    got = H.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), every=20, group=group).collect()
    want = slow(rows, every=20)
    assert sorted(map(tuple, got)) == want and len(want) > 100


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "CELLS", 1 << 10)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), int(i % 5 == 0)) for i in range(900)]
    assert sorted(map(tuple, H.mine(spark.createDataFrame(rows, SCHEMA).coalesce(1), every=7).collect())) == slow(rows, every=7)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=4).astype(np.float32).tolist(), i % 3) for i in range(-100, 200)]
    good += [(i, rng.normal(size=2).astype(np.float32).tolist(), i % 2) for i in range(300, 360)] + [(400 + i, [], i % 2) for i in range(4)]
    good += good[120:140] + [good[0]] * 3  # repeated rows, a repeated anchor
    good += [(50, [9.0, 9.0, 9.0, 9.0], 1)]  # one id, another vector
    bad = [(None, [1.0] * 4, 1), (150, None, 1), (100, [1.0] * 4, None), (1, [None, 1.0, 1.0, 1.0], 1), (2, [float("nan")] * 4, 1), (3, [float("-inf")] * 4, 0),
           (4, [3e38] * 4, 0)]
    df = spark.createDataFrame([(*r, 5, "z", 1.0) for r in good + bad], f"{SCHEMA}, rank int, anchor string, score double")
    got = sorted(map(tuple, H.mine(df).collect()))
    assert got == slow(good) and got
    assert H.mine(df.limit(0)).count() == 0
    assert H.mine(df.where("vec_id = 50")).count() == 0
    assert H.mine(df.where("vec_id % 50 <> 0")).count() == 0
