"""Report document: contract keys, semver, KPI values, written as one JSON file."""

import json
import os

import pytest
from pyspark.sql import functions as F

from basketry.plans import catalog as CAT
from basketry.plans import report as RP
from basketry.sources import files as FS

SF = "/root/testdata/sf0.001"


def test_report_document_contract(spark, tmp_dir):
    doc = CAT.q_report_document(spark, SF)
    for k in RP.REQUIRED_TOP_LEVEL:
        assert k in doc.columns
    assert RP.report_contract_violations(doc).count() == 0
    out = os.path.join(tmp_dir, "report")
    FS.write_document(doc, out)
    files = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(files) == 1
    data = json.loads(open(os.path.join(out, files[0])).read())
    assert data["schema_version"].count(".") == 2
    kpis = data["kpis"]
    assert kpis["products_total"] == data["data_availability"]["products_rows"] > 0
    assert sum(kpis["orders_by_provider"].values()) == kpis["orders_total"]
    assert len(data["products"]["sources_top10"]) == 10
    assert data["run_logs"]["total_runs"] > 0
    assert kpis["products_new"] is None and data["inputs"]["seed"] is None       # null, not absent
    items = spark.read.parquet(f"{SF}/benchmark.parquet").count()
    assert len(data["figures"]) == data["integrity"]["figure_count"] == items > 0
    assert data["integrity"]["missing_figures"] == ["overview.txt"]
    assert data["enriched"]["orders"]["columns"] == ["order_value_num", "gmv_7d", "orders_7d", "aov_7d", "recency_days"]


def test_report_contract_flags_bad_documents(spark):
    doc = CAT.q_report_document(spark, SF)
    bad = doc.withColumn("schema_version", F.lit("1.0")).withColumn("bogus", F.lit(1)).drop("narrative")
    got = {r["rule"] for r in RP.report_contract_violations(bad).collect()}
    assert got == {"schema_version_semver", "extra:bogus", "missing:narrative"}


SECTION_FIELDS = [(name, k, kind, open_) for name, (open_, required) in RP.SECTIONS.items() for k, kind in required.items()]


def _rules(doc):
    return {r["rule"] for r in RP.report_contract_violations(doc).collect()}


@pytest.fixture(scope="module")
def stub(spark):
    """A small document that keeps the contract, as literals."""
    value = {"string": F.lit("pair"), "boolean": F.lit(True), "integer": F.lit(1), "number": F.lit(1.5),
             "strings": F.array(F.lit("a")), "counts": F.create_map(F.lit("a"), F.lit(1))}
    cols = [F.struct(*[value[k].alias(f) for f, k in ((f, k.rstrip("?")) for f, k in required.items())]).alias(name)
            for name, (_, required) in RP.SECTIONS.items()]
    figure = F.struct(F.lit("n").alias("name"), F.lit("p").alias("path"), F.sha2(F.lit("x"), 256).alias("sha256"), F.lit(1).alias("size_bytes"))
    return spark.range(1).select(F.lit("1.2.3").alias("schema_version"), F.lit("2024-01-31T10:00:00+02:00").alias("generated_at_utc"),
                                 *cols, F.array(figure).alias("figures")).withColumn("inputs", F.col("inputs").withField("fake_mode", F.lit("none")))


def test_stub_keeps_the_contract(stub):
    assert _rules(stub) == set()


def test_every_nested_field_is_required_and_typed(spark, stub):
    # what the types break needs no data: all fields at once, by name
    gone = stub
    for name, k, _, _ in SECTION_FIELDS:
        gone = gone.withColumn(name, F.col(name).withField("other", F.lit(1)).dropFields(k))
    got = _rules(gone)
    assert {f"missing:{n}.{k}" for n, k, _, _ in SECTION_FIELDS} <= got
    assert {r for r in got if r.startswith("extra:")} == {f"extra:{n}.other" for n, (open_, _) in RP.SECTIONS.items() if not open_}
    other = stub
    for name, k, kind, _ in SECTION_FIELDS:
        other = other.withColumn(name, F.col(name).withField(k, F.lit("x") if kind.rstrip("?") != "string" else F.lit(1)))
    assert _rules(other) == {f"type:{n}.{k}" for n, k, _, _ in SECTION_FIELDS}
    null = stub
    for name, k, kind, _ in SECTION_FIELDS:
        null = null.withColumn(name, F.col(name).withField(k, F.when(F.lit(False), F.col(f"{name}.{k}"))))
    assert _rules(null) == {f"null:{n}.{k}" for n, k, kind, _ in SECTION_FIELDS if not kind.endswith("?")}


@pytest.mark.parametrize("rule,column,value", [
    ("schema_version_semver", "schema_version", lambda: F.lit("1.2")), ("null:schema_version", "schema_version", lambda: F.lit(None).cast("string")),
    ("generated_at_date_time", "generated_at_utc", lambda: F.lit("2024-01-31")), ("generated_at_date_time", "generated_at_utc", lambda: F.lit("2024-13-31T10:00:00Z")),
    ("type:schema_version", "schema_version", lambda: F.lit(1)), ("type:inputs", "inputs", lambda: F.lit("x")), ("type:figures", "figures", lambda: F.lit("x")),
    ("dedup_key_mode_enum", "inputs", lambda: F.col("inputs").withField("dedup_key_mode", F.lit("both"))),
    ("fake_mode_enum", "inputs", lambda: F.col("inputs").withField("fake_mode", F.lit("real"))),
    ("figure_sha256_pattern", "figures", lambda: F.transform("figures", lambda f: f.withField("sha256", F.lit("AB")))),
    ("figure_size_minimum", "figures", lambda: F.transform("figures", lambda f: f.withField("size_bytes", F.lit(0)))),
    ("null:figures.name", "figures", lambda: F.transform("figures", lambda f: f.withField("name", F.lit(None).cast("string")))),
    ("missing:figures.path", "figures", lambda: F.transform("figures", lambda f: f.dropFields("path"))),
    ("type:integrity.missing_figures", "integrity", lambda: F.col("integrity").withField("missing_figures", F.lit(1)))])
def test_every_value_rule(stub, rule, column, value):
    assert _rules(stub.withColumn(column, value())) == {rule}


def test_insights_pass(spark, tmp_dir):
    from basketry.plans import insights, views as V
    text = os.path.join(tmp_dir, "repo")
    os.makedirs(text)
    with open(os.path.join(text, "notes.md"), "w") as f:
        f.write("Lista de produtos e pedidos.\n")
    res = insights.run_insights(spark, V.products(spark, SF), V.orders(spark, SF), V.run_log(spark, SF),
                                text_root=text, export_dir=os.path.join(tmp_dir, "export"))
    assert {r["column"] for r in res["feature_validation"].collect()} == {"price_num", "source_freq",
                                                                          "order_value_num"}
    assert sorted(r["match"] for r in res["term_guard"].collect()) == ["pedidos", "produtos"]
    back = spark.read.parquet(os.path.join(tmp_dir, "export", "products_enriched"))
    assert "price_bucket" in back.columns and back.count() == V.products(spark, SF).count()
