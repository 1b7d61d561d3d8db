"""Types inferred from all rows, dedup on typed values, kept schema snapshots."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import clean as C
from basketry.operators import quality as Q
from basketry.plans import insights
from basketry.plans import views as V
from basketry.sources import files as FS
from basketry.sources import snapshots as SS

SF = "/root/testdata/sf0.001"


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return os.path.join(folder, name)


def test_lattice(spark, tmp_dir):
    path = write(tmp_dir, "t.csv", 'whole,gaps,number,truth,mixed,none,big,words,sign\n'
                 '1,1,1,True,1,,123456789012345678901,a,+1\n'
                 '-2,NA,2.50,FALSE,x,NA,2,"b, c",-0\n'
                 '03,3,1e3,true,2.5,null,3,true,7\n')
    raw = FS.read_csv_text(spark, path)
    assert FS.infer_types(raw) == {"whole": "bigint", "gaps": "bigint", "number": "double", "truth": "boolean", "mixed": "string", "none": "double",
                                   "big": "double", "words": "string", "sign": "bigint"}
    rows = FS.read_csv_typed(spark, path).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1.0, True, "1", None, 123456789012345678901.0, "a", 1), (-2, None, 2.5, False, "x", None, 2.0, "b, c", 0),
                                        (3, 3, 1000.0, True, "2.5", None, 3.0, "true", 7)]


def test_one_odd_value_among_many_makes_text(spark, tmp_dir):
    write(tmp_dir, "a.csv", "v\n" + "\n".join(str(i) for i in range(5000)) + "\nseven\n")
    assert FS.infer_types(FS.read_csv_text(spark, os.path.join(tmp_dir, "a.csv"))) == {"v": "string"}
    typed = spark.range(3).withColumn("t", F.lit("2"))
    assert FS.infer_types(typed) == {"id": "bigint", "t": "bigint"}
    assert FS.infer_types(typed.select("id")) == {"id": "bigint"}
    assert FS.infer_types(typed.limit(0)) == {"id": "bigint", "t": "double"}


def test_dedup_on_typed_values(spark, tmp_dir):
    rule = C.RULES["Sale Report"]
    text = "Order_ID,Order_Date,Sales,Profit\n1,2024-01-01,2.5,1\n1,2024-01-01,2.50,1\n+1,2024-01-01,2.5,1\n1,2024-01-01,2.5,1.0\n2,2024-01-01,2.5,{}\n"
    for profit, n in (("3", 2), ("n.n.", 3)):  # one word makes profit a column of text, where 1 and 1.0 differ
        folder = os.path.join(tmp_dir, profit[0])
        write(folder, rule.file_name, text.format(profit))
        status = C.run_cleaning(spark, folder, os.path.join(folder, "out"), {"s": rule}, fmt="parquet").collect()
        assert [r.status for r in status] == ["ok"]
        assert spark.read.parquet(status[0].output).count() == n
    # text frames are compared as text, as before
    raw = FS.read_csv_text(spark, os.path.join(tmp_dir, "3", rule.file_name))
    assert C.clean(raw, rule).count() == 5


def test_filled_column_of_numbers(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "5", "1", "7"), ("2", "2024-01-01", "5", "1", None)], "Customer_Id string, Order_Date string, Sales string, Quantity string, Gender string")
    out = C.clean(FS.cast_types(df, FS.infer_types(df)), C.RULES["E-commerce Dataset"]).orderBy("Customer_Id").collect()
    assert [r.Gender for r in out] == ["7", "Unknown"]


def changes(spark, root, df, run):
    return sorted((r.column, r.change, r.old_dtype, r.new_dtype) for r in SS.keep(spark, root, run, {"t": Q.schema_snapshot(spark, df)}).collect())


def test_snapshots(spark, tmp_dir):
    a = spark.createDataFrame([], "x int, y string, z double")
    assert changes(spark, tmp_dir, a, "r1") == [("x", "added", None, "int"), ("y", "added", None, "string"), ("z", "added", None, "double")]
    assert changes(spark, tmp_dir, a, "r2") == []
    b = spark.createDataFrame([], "x bigint, z double, y string, w date")
    assert changes(spark, tmp_dir, b, "r3") == [("w", "added", None, "date"), ("x", "retyped", "int", "bigint"), ("y", "moved", "string", "string"),
                                                ("z", "moved", "double", "double")]
    assert changes(spark, tmp_dir, a, "r4")[0] == ("w", "removed", "date", None)
    assert sorted({r.run_id for r in SS.history(spark, tmp_dir).collect()}) == ["r1", "r3", "r4"]
    assert len(FS.committed_versions(spark, tmp_dir, "t")) == 3


def test_insights_keep_snapshots_only_when_they_succeed(spark, tmp_dir, monkeypatch):
    root, tables = os.path.join(tmp_dir, "schemas"), os.path.join(tmp_dir, "tables")
    products, orders = V.products(spark, SF), V.orders(spark, SF)
    products.limit(5).write.parquet(os.path.join(tables, "products"))
    run = lambda p, **k: insights.run_insights(spark, p, orders, export_dir=os.path.join(tmp_dir, "out"), snapshot_root=root, **k)
    got = run(products, table_root=tables)
    assert {r.change for r in got["schema_changes"].collect()} == {"added"} and got["table_fingerprints"].count() >= 1
    assert run(products)["schema_changes"].count() == 0
    retyped = products.withColumn("price_amount", F.col("price_amount").cast("decimal(10,2)"))
    with monkeypatch.context() as m:
        m.setattr(FS, "write_enriched", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(retyped)
    assert [(r.dataset, r.column, r.change) for r in run(retyped)["schema_changes"].collect()] == [("products", "price_amount", "retyped")]
