"""Cleaning rules on a literal CSV with the defects listed in FIXTURES.md."""

import os

from basketry.operators import clean as C


CSV = """CustomerID,InvoiceDate,Quantity,UnitPrice,Country
1,12/1/2010 8:26,6,2.55,UK
1,12/1/2010 8:26,6,2.55,UK
NA,12/1/2010 8:26,6,2.55,UK
2,,3,1.0,UK
3,not a date,2,1.5,FR
4,2010-12-02 09:00:00,-1,1.5,FR
5,12/3/2010 10:00,0,1.5,
6,12/3/2010 10:00,abc,1.5,DE
7,12/4/2010 11:30,4,n/a,DE
"""


def test_online_retail_rules(spark, tmp_dir):
    path = os.path.join(tmp_dir, "online_retail.csv")
    with open(path, "w") as f:
        f.write(CSV)
    out = C.clean(C.read_raw_csv(spark, path), C.RULES["online_retail"]).collect()
    got = sorted((r["CustomerID"], str(r["InvoiceDate"]), r["Quantity"], r["UnitPrice"]) for r in out)
    assert got == [("1", "2010-12-01 08:26:00", 6.0, 2.55), ("3", "None", 2.0, 1.5),
                   ("7", "2010-12-04 11:30:00", 4.0, None)]


def test_optional_columns_and_fill(spark):
    df = spark.createDataFrame(
        [("c1", "2024-01-01", "10", "1", None, "Web"), ("c1", "2024-01-01", "10", "1", None, "Web"),
         ("c2", "2024-01-02", "0", "1", "F", None), ("c3", "bad", "5", "2", "NA", "App")],
        "Customer_Id string, Order_Date string, Sales string, Quantity string, Gender string, Device_Type string")
    rows = sorted(C.clean(df, C.RULES["E-commerce Dataset"]).collect(), key=lambda r: r["Customer_Id"])
    assert [r["Customer_Id"] for r in rows] == ["c1", "c3"]
    assert rows[0]["Gender"] == "Unknown" and rows[1]["Gender"] == "Unknown"
    assert rows[1]["Order_Date"] is None and rows[0]["Sales"] == 10.0
    assert "Product_Category" not in rows[0].asDict()


def test_missing_required_column_is_reported(spark, tmp_dir):
    ok_dir = os.path.join(tmp_dir, "in")
    os.makedirs(ok_dir)
    with open(os.path.join(ok_dir, "olist_sellers_dataset.csv"), "w") as f:
        f.write("seller_id,seller_state\ns1,SP\ns1,SP\n,RJ\n")
    with open(os.path.join(ok_dir, "olist_geolocation_dataset.csv"), "w") as f:
        f.write("geolocation_zip_code_prefix,geolocation_lat\n1,2\n")
    rules = {k: C.RULES[k] for k in ("sellers", "geolocation")}
    status = {r["dataset"]: r for r in C.run_cleaning(spark, ok_dir, os.path.join(tmp_dir, "out"), rules).collect()}
    assert status["sellers"]["status"] == "ok"
    assert status["geolocation"]["status"] == "error"
    out = spark.read.option("header", True).csv(status["sellers"]["output"]).collect()
    assert [r["seller_id"] for r in out] == ["s1"]
