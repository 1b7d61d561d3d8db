"""Quality operators: term scan vs brute force, manifest, drift, contracts, completeness."""

import collections
import hashlib
import os
import re

from basketry.operators import quality as QA
from basketry.plans.catalog import GUARD_TERMS


def _brute(docs, patterns):
    out = collections.Counter()
    for doc_id, text in docs:
        for p in patterns:
            for m in re.compile(p, re.IGNORECASE).finditer(text):
                ctx = text[max(0, m.start() - 20):m.end() + 20].replace("\n", " ")
                out[(doc_id, p, m.group(0), ctx)] += 1
    return out


def _spark_scan(spark, docs, patterns):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = QA.term_matches(df, "text", "doc_id", patterns).collect()
    return collections.Counter((r["doc_id"], r["term"], r["match"], r["context"]) for r in rows)


def test_term_scan_fixture_edges(spark):
    docs = [(1, "Produto novo; produtos\nvelhos e PRODUTO."),
            (2, "preço preço-preço xpreço précieux criado"),
            (3, "execução\n" * 3),
            (4, "nothing here")]
    assert _spark_scan(spark, docs, QA.REFERENCE_TERMS) == _brute(docs, QA.REFERENCE_TERMS)


def test_term_scan_matches_brute_force_on_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    expect = _brute(docs, GUARD_TERMS)
    assert sum(expect.values()) > 0
    assert _spark_scan(spark, docs, GUARD_TERMS) == expect
    counts = QA.term_counts(spark.createDataFrame(docs, "doc_id long, text string"), "text", "doc_id", GUARD_TERMS)
    per = collections.Counter()
    for (d, t, _, _), n in expect.items():
        per[(d, t)] += n
    assert {(r["doc_id"], r["term"]): r["n"] for r in counts.collect()} == dict(per)


def test_manifest_check_with_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "figs")
    os.makedirs(os.path.join(root, ".hidden"))
    files = {"a.png": b"aaaa", "b.png": b"bbbbbb", "c.png": b"c"}
    for n, b in files.items():
        with open(os.path.join(root, n), "wb") as f:
            f.write(b)
    actual = QA.file_fingerprints(spark, root, "*.png")
    uri = lambda n: "file:" + os.path.join(root, n)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = spark.createDataFrame([(uri("a.png"), 4, sha(b"aaaa")), (uri("b.png"), 6, sha(b"zzz")),
                                    (uri("c.png"), 2, sha(b"c")), (uri("gone.png"), 1, sha(b"x"))],
                                   "path string, size_bytes long, sha256 string")
    got = {r["path"].rsplit("/", 1)[1]: r["status"] for r in QA.manifest_check(listed, actual).collect()}
    assert got == {"a.png": "ok", "b.png": "hash_mismatch", "c.png": "size_mismatch", "gone.png": "missing"}
    more = listed.where("path not like '%a.png'")
    got2 = {r["path"].rsplit("/", 1)[1]: r["status"] for r in QA.manifest_check(more, actual).collect()}
    assert got2["a.png"] == "unexpected"


def test_json_schema_drift(spark):
    df = spark.createDataFrame([(1, '{"k": 1, "a": "x"}'), (1, '{"k": 2}'), (2, '{"k": 1.5}'),
                                (3, '{"k": 3, "b": true}'), (3, "not json")], "batch int, j string")
    got = sorted((r["batch"], r["key"], r["change"]) for r in QA.json_schema_drift(df, "batch", "j").collect())
    assert got == [(1, "a", "added"), (1, "k", "added"), (2, "a", "removed"), (2, "k", "retyped"),
                   (3, "b", "added"), (3, "k", "retyped")]


def test_snapshots(spark):
    a = spark.createDataFrame([], "x int, y string, z double")
    b = spark.createDataFrame([], "y string, x bigint, w int")
    first = QA.compare_snapshots(None, QA.schema_snapshot(spark, a)).collect()
    assert {r["change"] for r in first} == {"added"}
    diff = {r["column"]: r["change"] for r in
            QA.compare_snapshots(QA.schema_snapshot(spark, a), QA.schema_snapshot(spark, b)).collect()}
    assert diff == {"x": "retyped", "y": "moved", "z": "removed", "w": "added"}


def test_contract_and_completeness(spark):
    df = spark.createDataFrame([("1", "F", 5.0, "1.2.3"), (None, "X", -1.0, "1.2"), ("3", None, None, "bad")],
                               "id string, status string, total double, version string")
    rules = [QA.Rule("id_required", "id", "required"), QA.Rule("status_enum", "status", "enum", ("F", "O")),
             QA.Rule("total_min", "total", "minimum", 0), QA.Rule("semver", "version", "pattern", r"^\d+\.\d+\.\d+$")]
    counts = {r["rule"]: r["violations"] for r in QA.violation_counts(df, rules).collect()}
    assert counts == {"id_required": 1, "status_enum": 1, "total_min": 1, "semver": 2}
    good, bad = QA.split_valid(df, rules)
    assert good.count() == 1 and bad.count() == 2
    extra = {r["rule"]: r["violations"] for r in QA.violation_counts(df, [], ["id", "status", "total"]).collect()}
    assert extra == {"extra:version": 3}
    comp = {r["column"]: (r["present"], r["non_null_ratio"]) for r in
            QA.completeness(df, ["id", "total", "missing"]).collect()}
    assert comp == {"id": (True, 2 / 3), "total": (True, 2 / 3), "missing": (False, None)}
