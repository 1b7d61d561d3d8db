"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm import graph, simhash
from basketry.llm.common import table

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words, w = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            words, w = (words + [w] if w else words), ""
        else:
            w += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_query_against_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    fps = [slow_fingerprint(r.text) for r in docs]
    comp = slow_components([r.doc_id for r in docs], fps)
    from basketry.llm.queries import QUERIES
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_neardup"](spark, SF).collect()}
    assert got == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(docs, fps, comp, strict=True)}


@pytest.mark.parametrize("block_codes,group", [(16, 2), (40, 3), (1000, 4)])
def test_links_over_many_blocks(spark, block_codes, group):
    rng = np.random.default_rng(block_codes)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    near = [int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (6, 2))]
    fps = sorted({int(b) for b in base} | set(near))
    rows = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    links = simhash.link_codes(spark.createDataFrame(rows, "fp long"), 2, block_codes, group)
    got = {r.node % (1 << 64): r.root for r in graph.components(links).collect()}
    want = slow_components(list(range(len(fps))), fps)
    classes = {}
    for f, w in zip(fps, want, strict=True):
        classes.setdefault(w, set()).add(got.get(f, ("alone", f)))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_chain_and_star_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (3, 2), (3, 2)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {j: 100 for j in range(100, 160)}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "One two", "x"), (4, "One two", "x"), (None, "one TWO", "y"),
            (5, long, "z"), (6, long, "z"), (7, "É è\x0bÀ", "q"), (None, "all alone here today", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit("clash")).withColumn("_r", F.lit(1))
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    want = zip([r[0] for r in rows], (f"{f:016x}" for f in fps), slow_components([r[0] for r in rows], fps), strict=True)
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
