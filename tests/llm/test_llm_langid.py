"""Language identification: held-out accuracy, and the folded matrix against the kernel written out."""

import random
import zlib

import numpy as np

from basketry.llm import langid as L
from basketry.llm.common import table
from basketry.llm.toxicity import LETTERS

SF = "/root/testdata/sf0.01"


def kernel(a, b):
    grams = lambda t: {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    x, y = grams(a.translate(LETTERS)), grams(b.translate(LETTERS))
    return len(x & y) / (len(x) * len(y)) ** 0.5


def test_query_on_held_out_documents(spark):
    from basketry.llm.queries import QUERIES
    truth = {r.doc_id: (r.lang, r.text) for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97


def test_folded_matrix_is_nystrom_ridge():
    rng = random.Random(4)
    texts, langs = [], []
    for lang, letters in (("x", "abcdefgh "), ("y", "efghijkl "), ("z", "ijklmnop ")):
        for _ in range(20):
            texts.append("".join(rng.choice(letters) for _ in range(rng.randint(5, 40))).encode())
            langs.append(lang)
    order = rng.sample(range(60), 60)
    texts, langs = [texts[i] for i in order], [langs[i] for i in order]
    feats = [np.flatnonzero(r) for x in L.chunks(texts) for r in x]
    model = L.fit(feats, langs, 15, 0.1)
    marks = [i for k in range(5) for lang in "xyz" for i in [[j for j, v in enumerate(langs) if v == lang][k]]]
    x = np.concatenate(list(L.chunks(texts))).astype(float)
    own = np.sqrt(x.sum(1))
    k = x @ x.T / np.outer(own, own)
    assert np.allclose(k, [[kernel(a, b) for b in texts] for a in texts], atol=0.05)  # hashed n-grams may meet
    k_nm, k_mm = k[:, marks], k[marks][:, marks]
    y = np.eye(3)[["xyz".index(v) for v in langs]]
    alpha = np.linalg.solve(k_nm.T @ k_nm + 0.1 * k_mm, k_nm.T @ y)  # the regression in its dual form
    assert np.allclose(model.score(texts), k_nm @ alpha, atol=1e-4)


def test_odd_rows(spark):
    rows = [(i, f"the cat and the dog number {i}", "en") for i in range(40)] + [(i, f"der Hund und die Katze {i}", "de") for i in range(40, 80)]
    odd = [(None, "the dog", "en"), (200, None, "en"), (201, "", None), (202, "123 !?", "de"), (203, "日本", None), (203, "日本", None),
           (204, "the cat " * 50000, None), (205, "😀😀", "de")]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows + odd], "doc_id long, text string, lang string, score string, feats int")
    got = L.identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == v for i, _, v in rows)
    assert [by[k].lang_pred for k in (200, 201, 202, 205)] == ["und"] * 4 and by[201].score == 0
    assert by[203].lang_pred in ("de", "en") and by[204].lang_pred == "en" and by[None].lang_pred == "en"
    assert L.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identify(df.where("lang is null")).collect()} == {"und"}


def test_rare_language_of_a_large_table_is_learned(spark):
    from pyspark.sql import functions as F
    words = F.concat_ws(" ", F.lit("the cat and the dog saw"), F.col("id").cast("string"), F.lit("birds in the house"))
    common = spark.range(100_000).select(F.col("id").alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(100_000, 100_040).select(F.col("id").alias("doc_id"), F.concat(F.lit("zwölf Hühner über Köln "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    copies = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same dog").alias("text"), F.lit("en").alias("lang"))
    df = common.unionByName(rare).unionByName(copies)
    drawn = L.class_share(df, ["doc_id", "text"], "lang", 4000, 9)
    assert drawn.where("lang = 'de'").count() == 40 and drawn.distinct().count() <= 4400
    got = {r.lang_pred for r in L.identify(df).where("doc_id >= 100000").collect()}
    assert got == {"de"}
