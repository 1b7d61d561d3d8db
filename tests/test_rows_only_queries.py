"""Brute-force checks for the registered queries without a SQL oracle."""

import collections
import hashlib
import json

import __spark_entry__ as E
from basketry.plans import raw_views as R

SF = "/root/testdata/sf0.001"


def test_content_hash_matches_python_digest(spark):
    hashes = [r["raw_hash"] for r in R.shopify_orders_raw(spark, SF).select("raw_hash").collect()]
    lanes = [sum(int(h[15 * i:15 * i + 15], 16) for h in hashes) for i in range(5)]
    expect = hashlib.sha256("|".join([str(len(hashes))] + [str(x) for x in lanes]).encode()).hexdigest()
    row = E.queries()["content_hash"](spark, SF).first()
    assert row["records"] == len(hashes) and row["batch_hash"] == expect


def test_json_key_profile_matches_python(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "props").collect()
    expect = collections.Counter()
    for r in events:
        doc = json.loads(r["props"])
        for k, v in doc.items():
            kind = "BIGINT" if isinstance(v, int) else "STRING" if isinstance(v, str) else type(v).__name__
            expect[(r["ts"].date(), k, kind)] += 1
    got = {(r["batch"], r["key"], r["type"]): r["records"]
           for r in E.queries()["json_key_profile_events"](spark, SF).collect()}
    assert got == dict(expect)


def test_order_value_buckets_and_log_hist_sum_to_rows(spark):
    n_orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    buckets = E.queries()["order_value_buckets"](spark, SF).collect()
    assert sum(r["count"] for r in buckets) == n_orders
    hist = E.queries()["hist_price_log_20"](spark, SF).collect()
    n_pos = spark.read.parquet(f"{SF}/part.parquet").where("p_retailprice > 0").count()
    assert len(hist) == 20 and sum(r["count"] for r in hist) == n_pos
