"""Toxicity: held-out accuracy, and a plain FTRL loop beside the vectorized one."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import toxicity
from basketry.llm.common import table

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    from basketry.llm.queries import QUERIES
    got = QUERIES["op6_toxicity"](spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    bad, good = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert np.mean([b > g for b in bad for g in good]) > 0.9
    assert not any(r.predicted and not r.toxic for r in held)


def test_ftrl_against_plain_loop():
    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(0, 50, 8)), int(rng.integers(0, 2))) for _ in range(200)]
    feats, w, bias = toxicity.ftrl(rows, 0.5, 1.0, 0.3, 0.1, 2)
    z, n, b, bn = {}, {}, 0.0, 0.0

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= 0.3 else -(zi - np.sign(zi) * 0.3) / ((1.0 + ni ** 0.5) / 0.5 + 0.1)

    for _ in range(2):
        for fs, y in rows:
            ws = {i: weight(i) for i in fs}
            g = 1 / (1 + np.exp(-(sum(ws.values()) + b))) - y
            for i in fs:
                ni = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((ni + g * g) ** 0.5 - ni ** 0.5) / 0.5 * ws[i]
                n[i] = ni + g * g
            bn += g * g
            b -= 0.5 * g / (1.0 + bn ** 0.5)
    assert np.isclose(bias, b)
    assert dict(zip(feats.tolist(), w, strict=True)).keys() == {i for i in z if weight(i)}
    assert np.allclose(w, [weight(i) for i in feats])


def test_grams_of_one_text():
    (got,) = toxicity.distinct_grams([b"Bad, bad dog!"])
    assert len(got) == 5  # bad, dog, bad bad, bad dog, and bad .. dog


def test_odd_rows(spark):
    rows = [(i, f"plain words number {i} here", 0) for i in range(0, 60, 2)] + [(i, f"you idiot number {i} there", 1) for i in range(1, 60, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = docs.select("doc_id", F.col("y").alias("toxic"), F.lit("clash").alias("text"))
    odd = spark.createDataFrame([(None, "no id idiot"), (900, None), (901, ""), (901, ""), (902, "word " * 50000)], "doc_id long, text string")
    df = docs.drop("y").unionByName(odd).withColumn("score", F.lit("x")).withColumn("w", F.lit(1))
    more = labels.unionByName(spark.createDataFrame([(None, 1, "x"), (1, None, "x"), (1, 1, "x")], "doc_id long, toxic int, text string"))
    got = toxicity.classify(df, more, l1=0.05).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[900] == by[901] and by[1] > by[0]
    assert toxicity.classify(df.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.classify(df, labels.limit(0)).collect()} == {0}


def plain_grams(text):
    """The features by their description, one at a time, in whole numbers of 64 bits."""
    full = (1 << 64) - 1
    u = [((zlib.crc32(w) + 1) * 0x9E3779B97F4A7C15) & full for w in (text or "").encode().translate(toxicity.LETTERS).split()]
    out = [x for x in u]
    for gap, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        out += [(((a >> 7) ^ ((b * factor) & full)) * 0xD6E8FEB86659FD93) & full for a, b in zip(u, u[gap:], strict=False)]
    return {x >> (64 - toxicity.BITS) for x in out}


def test_query_against_plain_learning_and_scoring(spark):
    from basketry.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    known = [i for i in labels if i in docs and zlib.crc32(str(i).encode()) % 3 != 1]
    known.sort(key=lambda i: (i * 0x9E3779B97F4A7C15 % (1 << 64), i))
    alpha, beta, l1, l2 = 4.0, 1.0, 0.12 * len(known) ** 0.5, 0.1
    grams = {i: plain_grams(t) for i, t in docs.items()}
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(f):
        zi = z.get(f, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - np.sign(zi) * l1) / ((beta + n[f] ** 0.5) / alpha + l2)

    for _ in range(8):
        for i in known:
            w = {f: weight(f) for f in grams[i]}
            g = 1 / (1 + np.exp(-np.clip(sum(w.values()) + bias, -35, 35))) - labels[i]
            for f, wf in w.items():
                nf = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((nf + g * g) ** 0.5 - nf ** 0.5) / alpha * wf
                n[f] = nf + g * g
            bias_n += g * g
            bias -= alpha * g / (beta + bias_n ** 0.5)
    got = {r.doc_id: r.score for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    want = {i: 1 / (1 + np.exp(-np.clip(sum(weight(f) for f in fs if f in z) + bias, -35, 35))) for i, fs in grams.items()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)
