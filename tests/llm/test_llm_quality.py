"""Quality: held-out accuracy, and the chains against all labellings written out."""

import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import quality as Q
from basketry.llm.common import table

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    from basketry.llm.queries import QUERIES
    got = QUERIES["op7_quality_crf"](spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows if r.held_out]) > 0.97


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 5, 2])
    good, trans = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    marg, pairs, log_z = Q.Chains(counts).run(good, trans)
    at, want, want_pairs, want_z = 0, [], np.zeros((2, 2)), 0.0
    for n in counts:
        ways = list(product((0, 1), repeat=n))
        w = np.array([np.exp(sum(good[at + i] * s[i] for i in range(n)) + sum(trans[a, b] for a, b in zip(s, s[1:], strict=False))) for s in ways])
        want += [w[[s[i] == 1 for s in ways]].sum() / w.sum() for i in range(n)]
        for s, v in zip(ways, w / w.sum(), strict=True):
            for a, b in zip(s, s[1:], strict=False):
                want_pairs[a, b] += v
        want_z += np.log(w.sum())
        at += n
    assert np.allclose(marg, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_line_features():
    own, sizes, counts = Q.line_features([b"One two.\n\n  \nOne two.\nTHREE $$$ 44", b"", "é ü\n".encode()])
    assert counts.tolist() == [3, 1, 1] and sizes.tolist() == [8, 8, 12, 0, 5]
    assert own[:, -3].tolist() == [1, 1, 0, 0, 0] and own[:, -2].tolist() == [1, 1, 0, 0, 0] and own[:, -1].tolist() == [0, 0, 0, 1, 0]
    full = Q.with_neighbours(own, counts)
    assert (full[1, Q.OWN:2 * Q.OWN] == own[0]).all() and (full[1, 2 * Q.OWN:3 * Q.OWN] == own[2]).all()
    assert not full[2, 2 * Q.OWN:3 * Q.OWN].any() and full[:, -2].tolist() == [1, 0, 0, 1, 1] and full[:, -1].tolist() == [0, 0, 1, 1, 1]
    a, b = Q.line_features([b"x y z\nq."]), Q.line_features([b"first", b"x y z\nq."])
    assert (a[0] == b[0][1:]).all()


def test_odd_rows(spark):
    rows = [(i, f"A plain sentence number {i}, as it were.\nAnd one more.", 1) for i in range(0, 60, 2)] + [(i, f"BUY!! NOW$$$ {i}%%%\n### *** &&&", 0) for i in range(1, 60, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = docs.select("doc_id", F.col("y").alias("quality"), F.lit("clash").alias("text"))
    odd = spark.createDataFrame([(None, "No id."), (900, None), (901, ""), (901, ""), (902, "\n" * 5000 + "Words here. " * 50000)], "doc_id long, text string")
    df = docs.drop("y").unionByName(odd).withColumn("score", F.lit("x")).withColumn("own", F.lit(1))
    more = labels.unionByName(spark.createDataFrame([(None, 1, "x"), (0, None, "x"), (0, 1, "x")], "doc_id long, quality int, text string"))
    got = Q.classify(df, more).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score and all(by[i].predicted == y for i, _, y in rows) and by[902].predicted == 1
    assert Q.classify(df.limit(0), labels).count() == 0
    assert {r.score for r in Q.classify(df, labels.limit(0)).collect()} == {0.5}


def test_repeated_labelled_ids_and_very_long_documents(spark):
    rows = [(i, f"A plain sentence number {i}.\nAnd one more.", 1) for i in range(0, 60, 2)] + [(i, f"BUY!! NOW$$$ {i}%%%\n### *** &&&", 0) for i in range(1, 60, 2)]
    docs = spark.createDataFrame([*rows, (100, "A plain line of words.\n" * 100_000, 1)], "doc_id long, text string, y int")
    hot = spark.range(20_000).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("Some plain words, "), F.col("id").cast("string")).alias("text"))
    texts = docs.select("doc_id", "text").unionByName(hot)
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sample = Q.labelled(texts, docs.select("doc_id", "y"), "y", 3, 1, 3000, lines, 60_000, 7).collect()
    ids = [r.doc_id for r in sample]
    assert len(ids) == len(set(ids)) and set(ids) == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert sum(r.text.count("\n") + 1 for r in sample) <= 60_000
    few = Q.labelled(texts, docs.select("doc_id", "y"), "y", 3, 1, 3000, lines, 11, 7).collect()
    assert 0 < sum(r.text.count("\n") + 1 for r in few) <= 11
    got = Q.classify(texts, docs.select("doc_id", F.col("y").alias("quality"))).where("doc_id = 100").collect()
    assert [r.predicted for r in got] == [1]
