"""The pipeline, stage by stage, against brute-force versions on each stage's own input."""

import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_packing import check as check_packing
from test_llm_secret_scan import added, base
from test_llm_simhash import slow_components, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.llm import mixing, secret_scan, toxicity
from basketry.llm.common import table

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = table(spark, SF, "documents"), []
    folder = tmp_path_factory.mktemp("pipeline")
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return {name: (a, b) for name, a, b in out}


def key(rows):
    return sorted(map(str, rows))


def test_columns(steps):
    columns = steps["toxicity"][0].columns
    assert all(b.columns == columns for name, (_, b) in steps.items() if name != "packing")
    assert list(steps) == ["toxicity", "simhash_neardup", "secret_scan", "mixing", "packing"]


def test_toxicity(spark, steps):
    a, b = steps["toxicity"]
    bad = {r.doc_id for r in toxicity.classify(a, table(spark, SF, "labels")).collect() if r.predicted}
    assert key(b.collect()) == key(r for r in a.collect() if r.doc_id not in bad)


def test_near_duplicates(steps):
    a, b = steps["simhash_neardup"]
    rows = a.collect()
    fps = [slow_fingerprint(r.text) for r in rows]
    heads = set(slow_components([r.doc_id for r in rows], fps))
    assert key(b.collect()) == key(r for r in rows if r.doc_id in heads)


def test_secrets(steps):
    a, b = steps["secret_scan"]
    weights = secret_scan.train(a.select("doc_id", "text"), 20_000, 5, 0.5)
    got = {r.doc_id: r for r in b.collect()}
    for r in a.collect():
        text, at, out = r.text, 0, ""
        for start, _, end in sorted(base(text) + added(text, weights)):
            if start >= at:
                out += text[at:start] + "[redacted]"
            at = max(at, end)
        out += text[at:]
        assert got.pop(r.doc_id).asDict() == r.asDict() | {"text": out, "n_chars": len(out) if out != text else r.n_chars}
    assert not got


def test_mixing(steps):
    a, b = steps["mixing"]
    taken = {r.doc_id: r.taken for r in mixing.mix(a).collect() if r.taken}
    words, texts = Counter(), {r.doc_id: r.text for r in a.collect()}
    for r in b.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.text in texts[r.doc_id]
    assert words == taken


def test_packing(spark, steps):
    a, b = steps["packing"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    assert sum(r.length for r in b.collect()) == sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in a.collect())
    one = a.dropDuplicates(["doc_id"])
    check_packing(STAGE["packing"](spark, one, SF).collect(), [(r.doc_id, r.text) for r in one.collect()], tok)


def test_run_is_the_stages(spark, steps):
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(steps["packing"][1].collect())


# user columns with the stages' internal names, in other cases, and of a type without order or hash
OWN = ["_nth", "_mark", "_c", "_new", "_text", "_base", "_ALL", "_id", "_row", "row", "row_hash", "nr", "key", "copies", "fp", "hit", "nth", "Tags"]
WANT = [{"k": 1} if n == "Tags" else n for n in OWN]


def test_odd_rows_through_all_stages(spark):
    rows = [(1, None, None, "a", None), (2, "", "en", None, 0), (3, "same text here", None, "a", 14), (3, "same text here", None, "a", 14),
            (None, "same text here", "en", "b", 14), (None, "other words entirely", "en", "b", 20), (5, "word " * 30000, "en", "a", 150000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {n: F.create_map(F.lit("k"), F.lit(1)) if n == "Tags" else F.lit(n) for n in OWN})
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert all([r[c] for c in OWN] == WANT for r in docs.collect())
        if name == "simhash_neardup":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 3, 5]
    assert docs.count() > 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
