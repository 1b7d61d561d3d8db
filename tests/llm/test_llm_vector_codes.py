"""Vector codes: the search against all entries, the query's codebooks against plain loops, odd rows."""

import hashlib
import math

import numpy as np
import pytest

from basketry.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, parts, entries, rounds, scale=256):
    """rows: (vec_id, vector, label), all usable and of one length. Returns one result row per row, in the order of the rows."""
    ints = [[math.floor(float(x) * scale) for x in v] for _, v, _ in rows]
    d = len(ints[0]) // parts
    cut = [[tuple(v[p * d:(p + 1) * d]) for p in range(parts)] for v in ints]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(rows)) if found[i][p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [min(sum(x for x, _ in f), V.LONGEST) for f in found]
    total = {}
    for (_, _, label), e in zip(rows, error):
        total[label] = min(total.get(label, 0) + e, V.LONGEST)
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, total[r[2]], digest) for r, f, e in zip(rows, found, error)]


@pytest.mark.parametrize("spread", [1, 3, 50, 10 ** 12])
def test_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    x, book = rng.integers(-spread, spread + 1, (400, 4)), rng.integers(-spread, spread + 1, (64, 4))
    if spread > 10 ** 9:
        x, book = x.astype(object), book.astype(object)
    entry, best = V.nearest(x, book)
    every = ((x[:, None] - book[None]) ** 2).sum(2)
    assert entry.tolist() == [min(range(64), key=lambda k: (row[k], k)) for row in every.tolist()]
    assert best.tolist() == every.min(1).tolist()


@pytest.mark.parametrize("seed, n, dim, parts, entries", [(0, 150, 32, 16, 64), (1, 90, 12, 4, 7), (2, 5, 16, 16, 64)])
def test_against_loops(spark, seed, n, dim, parts, entries):
    rng = np.random.default_rng(seed)
    rows = [(int(i), np.round(rng.normal(size=dim), 2).astype(np.float32).tolist(), [None, 1, 2, 3][int(rng.integers(4))]) for i in rng.permutation(n)]
    rows += rows[:4]
    got = V.compress(spark.createDataFrame(rows, SCHEMA), parts=parts, entries=entries).collect()
    assert sorted(map(tuple, got)) == sorted(slow(rows, parts, entries, 2))


def test_odd_rows(spark):
    good = [(i, [float(i % 7), -0.001, 3e38 if i == 5 else 0.25, -float(i)], 1) for i in range(1, 60)] + [(None, [1.0, 2.0, 3.0, 4.0], None)] * 2
    bad = [(0, None, 1), (61, [1.0, None, 0.0, 0.0], 1), (62, [float("nan"), 0.0, 0.0, 0.0], None), (63, [float("inf"), 0.0, 0.0, 0.0], 2)]
    short = [(64, [1.0, 2.0], 9), (65, [], 9)]
    df = spark.createDataFrame([(*r, "z", 7) for r in good + bad + short], f"{SCHEMA}, code string, _label int")
    got = [tuple(r) for r in V.compress(df, parts=4, entries=8).collect()]
    want = slow([(a, np.array(b, dtype=np.float32).tolist(), c) for a, b, c in good], 4, 8, 2)
    assert sorted(got, key=str) == sorted(want + [(64, None, None, None, want[0][4]), (65, None, None, None, want[0][4])], key=str)
    assert V.compress(df.limit(0)).count() == 0
    odd = V.compress(df.where("vec_id < 10"), parts=3, entries=8).collect()
    assert len(odd) == 9 and all(r.code is None and r.codebooks_sha256 is None for r in odd)


def test_many_labels(spark, monkeypatch):
    """Beyond the broadcast's bound the totals are joined by a shuffle."""
    rows = [(i, [float(i % 5), 1.0], None if i % 9 == 0 else i % 4 if i % 3 else 77) for i in range(300)]
    plain = V.lookup
    monkeypatch.setattr(V, "lookup", lambda a, b, on: plain(a, b, on, bound=0))
    got = V.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=3).collect()
    assert sorted(map(tuple, got)) == sorted(slow(rows, 2, 3, 2))
