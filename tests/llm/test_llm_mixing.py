"""Mixing: the water level by iteration, seats by highest quotients one at a time, texts by exact round trip."""

import hashlib
import heapq
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing as M
from basketry.llm.common import table

SF = "/root/testdata/sf0.01"


def slow_targets(sizes):
    """sizes: (source, words) in code-point order, null last."""
    total, open_, out = sum(n for _, n in sizes), list(range(len(sizes))), {}
    w = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    left = float(total)
    while open_:
        share = left / sum(w[i] for i in open_)
        above = [i for i in open_ if 3 * sizes[i][1] < share * w[i] - 1e-9]
        if not above:
            out.update({i: share * w[i] for i in open_})
            break
        for i in above:
            out[i] = 3.0 * sizes[i][1]
            left -= out[i]
            open_.remove(i)
    return {sizes[i][0]: t for i, t in out.items()}


def test_query_near_targets(spark):
    from basketry.llm.queries import QUERIES
    docs = {r.doc_id: (r.source, len([w for w in r.text.split(" ") if w])) for r in table(spark, SF, "documents").withColumn(
        "text", F.translate("text", "\t\n\x0b\x0c\r", "     ")).collect()}
    rows = QUERIES["op4_mixing"](spark, SF).collect()
    assert len(rows) == len(docs) and all(r.size == docs[r.doc_id][1] and 0 <= r.taken <= 3 * r.size for r in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = docs[r.doc_id][0]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
    want = slow_targets(sorted(sizes.items()))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 16
    assert all(r.source_size == sizes[docs[r.doc_id][0]] for r in rows)


def slow_seats(goals, seats):
    """{source: seats}, one at a time; goals: (source, target) in code-point order."""
    heap = [(-t, i, 1) for i, (_, t) in enumerate(goals)]
    heapq.heapify(heap)
    got = Counter()
    for _ in range(seats):
        _, i, k = heapq.heappop(heap)
        got[goals[i][0]] += 1
        heapq.heappush(heap, (-(goals[i][1] / (2 * k + 1)), i, k + 1))
    return got


@pytest.mark.parametrize("seed, sources", [(0, 1), (1, 3), (2, 9), (3, 60), (4, 300), (5, 40)])
def test_quotas_are_highest_quotients(spark, seed, sources):
    rng = random.Random(seed)
    sizes = [(f"s{i:03}", 500 if seed == 5 else rng.choice([0, 3, 50, 1000, rng.randint(1, 5000)])) for i in range(sources)]
    df = spark.createDataFrame(sizes, "source string, source_size long")
    goals = M.targets(df).collect()
    want = slow_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in goals)
    got = {r.source: r.upto for r in M.quotas(M.targets(df), shards=7, block_words=16).collect()}
    big = [(r.source, r.target) for r in sorted(goals, key=lambda r: r.source) if r.source_size >= 16]
    total = int(sum(round(t, 6) for _, t in big) / 16 + 0.5)
    for shard in range(7):
        seats = slow_seats(big, (shard + 1) * total // 7)
        assert {s: u[shard] for s, u in got.items()} == {s: seats[s] for s, _ in sizes}


def slow_taken(docs, shards=8, block=16, seed=4):
    """Words taken of each row, by marking every word of every line; docs: (doc_id, text, source)."""
    rows = [(d, (t or ""), s, len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w])) for d, t, s in docs]
    order = sorted({s for *_, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = Counter()
    for *_, s, n in rows:
        size[s] += n
    want = slow_targets([(s, size[s]) for s in order])
    big = [(s, want[s]) for s in order if size[s] >= block]
    total = int(sum(round(t, 6) for _, t in big) / block + 0.5)
    upto = [slow_seats(big, j * total // shards) for j in range(shards + 1)]
    out = Counter()
    for s in order:
        n = size[s]
        if not n:
            continue
        seats = [u[s] for u in upto] if n >= block else [0] * shards + [1]
        words = min(block * seats[-1] if n >= block else int(want[s] + 0.5), 3 * n)
        times = [words // n] * n
        rest, all_ = words % n, max(seats[-1], 1)
        for j in range(shards):
            r0, r1 = rest * seats[j] // all_, rest * seats[j + 1] // all_
            if not rest:
                continue
            e0, e1 = n * r0 // rest, n * r1 // rest
            code = int(hashlib.md5(f"{seed}:{s or ''}:{j}".encode()).hexdigest()[:12], 16)
            at = code % max(-(-(e1 - e0) // block), 1) * block
            for i in range(r1 - r0):
                times[e0 + (at + i) % (e1 - e0)] += 1
        assert sum(times) == words
        text_md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
        mine = sorted((hashlib.md5(f"{seed}:{'' if d is None else d}:{text_md5(t)}".encode()).hexdigest()[:15], d or 0, i)
                      for i, (d, t, s2, _) in enumerate(rows) if s2 == s)
        at = 0
        for _, _, i in mine:
            out[i] = sum(times[at:at + rows[i][3]])
            at += rows[i][3]
    return sorted(str((rows[i][0], rows[i][3], out[i])) for i in range(len(rows)))


@pytest.mark.parametrize("seed", range(3))
def test_words_taken(spark, seed):
    """Many small sources beside a large one: no source is lost, short ones give their target to the word."""
    rng = random.Random(seed)
    docs = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(1, 7))), f"tiny{i}") for i in range(60)]
    docs += [(100 + i, " ".join(["word"] * rng.randint(0, 60)), rng.choice(["big", "mid", "mid2", None])) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = M.mix(df).collect()
    assert sorted(str((r.doc_id, r.size, r.taken)) for r in rows) == slow_taken(docs)
    source, taken = {d: s for d, _, s in docs}, Counter()
    for r in rows:
        taken[source[r.doc_id]] += r.taken
    for r in rows:
        assert abs(taken[source[r.doc_id]] - r.target) <= (16 if r.source_size >= 16 else 0.5)


def test_mixed_documents_hold_the_words_taken(spark):
    docs = table(spark, SF, "documents")
    taken = {r.doc_id: (r.taken, r.size) for r in M.mix(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got, cut = Counter(), 0
    for r in M.mixed(docs).collect():
        got[r.doc_id] += len(r.text.split())
        cut += r.text != texts[r.doc_id]
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
    assert got == {d: t for d, (t, _) in taken.items() if t}
    assert 0 < cut <= 4 * 8 * docs.select("source").distinct().count()


def test_odd_rows(spark):
    long = "\x0b" + " ".join(f"w{i}" for i in range(40000)) + "\n"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t ", "b"), (4, long, "b"), (5, "x y z", None), (5, "x y z", None), (None, "p q", "c"),
            (None, "p q", "c"), (6, "one", "\U0001f600"), (7, "é è  ç", "￿")]
    df = spark.createDataFrame([(*r, 7, "t") for r in rows], "doc_id long, text string, source string, size int, target string")
    got = M.mix(df).collect()
    assert sorted(str((r.doc_id, r.size)) for r in got) == sorted(str((d, len((t or "").replace(" ", "_").split()))) for d, t, _ in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    want = slow_targets([("a", 0), ("b", 40000), ("c", 4), ("￿", 2), ("\U0001f600", 1), (None, 6)])
    assert sorted({(r.source_size, round(r.target, 3)) for r in got}) == sorted({(s, round(want[k], 3)) for k, s in
                                                                       (("a", 0), ("b", 40000), ("c", 4), ("￿", 2), ("\U0001f600", 1), (None, 6))})
    own = {"_nth": F.lit(1), "_mark": F.lit("m"), "nr": F.lit(2), "row": F.lit("r"), "copies": F.lit(3), "Size_": F.lit(4), "tags": F.create_map(F.lit("k"), F.lit(1))}
    out = M.mixed(df.withColumns(own)).collect()
    assert all((r._nth, r._mark, r.nr, r.row, r.copies, r.Size_, r.tags, r["size"], r.target) == (1, "m", 2, "r", 3, 4, {"k": 1}, 7, "t") for r in out)
    words = Counter()
    for r in out:
        words[r.doc_id] += len((r.text or "").replace(" ", "_").split())
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken
    assert +words == +taken
    assert M.mix(df.limit(0)).count() == 0 and M.mixed(df.limit(0)).count() == 0
    assert sorted(map(str, got)) == sorted(map(str, M.mix(df.repartition(5)).collect()))
