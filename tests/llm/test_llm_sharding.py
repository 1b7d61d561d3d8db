"""Sharding against a sort in one place, and its law on odd rows."""

import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from basketry.llm import sharding
from basketry.llm.common import table

SF = "/root/testdata/sf0.01"


def slow(docs, shards=40, seed=3):
    """docs: (doc_id, text, source)."""
    by = {}
    for d, t, s in docs:
        raw = (t or "").encode()
        by.setdefault(s, []).append((hashlib.md5(f"{seed}:{'' if d is None else d}:{zlib.crc32(raw)}".encode()).hexdigest()[:15], d or 0, len(raw) + 16, zlib.crc32(raw), d))
    rows = [((r + 0.5) / len(v), s is None, s or "", r, x) for s, v in by.items() for r, x in enumerate(sorted(v, key=lambda x: x[:4]))]
    n, out = len(rows), []
    for pos, (*_, x) in enumerate(sorted(rows, key=lambda x: x[:4])):
        k = pos * shards // n
        out.append((x[4], x[2], x[3], "rows", k, pos - math.ceil(k * n / shards), None))
    return sorted(map(str, out))


def test_query_against_one_sort(spark):
    from basketry.llm.queries import QUERIES
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "source").collect()]
    rows = QUERIES["op3_sharding"](spark, SF).collect()
    assert sorted(str(tuple(r)) for r in rows) == slow(docs)
    source = {d: s for d, _, s in docs}
    share = Counter(source.values())
    for k in range(40):
        mine = Counter(source[r.doc_id] for r in rows if r.shard == k)
        assert all(abs(mine[s] - n / 40) <= 2 for s, n in share.items())


def test_odd_rows(spark):
    rows = [(i, f"t{i % 3}", "hot") for i in range(300)] + [(i, None, None) for i in range(300, 345)] + [(None, "é", "b"), (7, "x" * 400000, "c"), (7, "", "c")] * 2
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, shard int, _rank string")
    got = sharding.shard(df).collect()
    assert sorted(str(tuple(r)) for r in got) == slow(rows)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(40))
    for k in sizes:
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sizes[k]))
    assert sharding.shard(df.limit(0)).count() == 0
    few = sharding.shard(df.where(F.col("doc_id") < 5)).collect()
    assert sorted(r.slot for r in few) == [0] * 5


def test_hot_ids_and_equal_rows_spread(spark, monkeypatch):
    seen, running = [], sharding.running
    monkeypatch.setattr(sharding, "running", lambda df, group, key, *a, **kw: seen.append(
        df.groupBy(*group, F.shiftright(F.col(key), 54).alias("cell")).count().agg(F.max("count")).first()[0]) or running(df, group, key, *a, **kw))
    rows = [(i, f"t{i}", "a") for i in range(2000)] + [(None, f"n{i}", "a") for i in range(2000)] + [(5, f"h{i}", "a") for i in range(1000)] + [(9, "copy", "a")] * 2000
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)).collect()
    assert sorted(str(tuple(r)) for r in got) == slow(rows)
    assert max(seen) <= 40  # of 7000 rows, 2000 of them alike
