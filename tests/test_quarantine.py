"""Checked merges: routing, the limit, replay, and failures in between."""

import datetime as dt
import json
import os

import pytest

from basketry import schemas as SC
from basketry.operators import merge as M
from basketry.operators.quality import Rule
from basketry.plans import etl
from basketry.sources import landing as L
from basketry.sources import quarantine as QT
from basketry.sources import tables as TB
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType().add("source", "string").add("order_id", "string").add("total_price", "double").add("raw_hash", "string").add("ingested_at", "timestamp_ntz")
RULES = [Rule("price_minimum", "total_price", "minimum", 10.0), Rule("id", "order_id", "required")]
KEYS = M.ORDER_KEYS


def batch(spark, rows, hour=0):
    return spark.createDataFrame([(s, i, p, f"h{p}", dt.datetime(2024, 1, 1, hour)) for s, i, p in rows], SCHEMA)


def put(spark, root, rows, hour=0, run=None, most=None, mode="pair"):
    return QT.merge_checked(spark, root, "orders", SCHEMA, batch(spark, rows, hour), mode, KEYS, "ingested_at", RULES, run or f"r{hour}", most)


def table(spark, root):
    return sorted((r.source, r.order_id, r.total_price) for r in TB.read_table(spark, root, "orders", SCHEMA).collect())


def held(spark, root):
    return sorted((r.source, r.order_id, r.total_price, tuple(r.violations)) for r in QT.quarantined(spark, root, "orders", SCHEMA).select(
        "source", F.coalesce("order_id", F.lit("-")).alias("order_id"), "total_price", "violations").collect())


def test_every_record_goes_one_way(spark, tmp_dir):
    got = put(spark, tmp_dir, [("s", "1", 20.0), ("s", "2", 5.0), ("s", None, 3.0), ("s", "3", None)])
    assert got == {"new": 2, "updated": 0, "batch": 1, "quarantined": 2}
    assert sorted(map(str, table(spark, tmp_dir))) == ["('s', '1', 20.0)", "('s', '3', None)"]
    assert held(spark, tmp_dir) == [("s", "-", 3.0, ("price_minimum", "id")), ("s", "2", 5.0, ("price_minimum",))]
    assert not os.listdir(f"{tmp_dir}/_staging/orders")
    # the same records once more, with a later stamp: nothing is held twice
    put(spark, tmp_dir, [("s", "2", 5.0), ("s", "2", 5.0), ("s", None, 3.0)], hour=1)
    assert len(held(spark, tmp_dir)) == 2
    assert put(spark, tmp_dir, [], hour=2) == {"new": 0, "updated": 0, "batch": None, "quarantined": 0}


@pytest.mark.parametrize("mode", ["pair", "triple"])
def test_stopped_run_leaves_nothing(spark, tmp_dir, mode):
    put(spark, tmp_dir, [("s", "1", 20.0)], mode=mode)
    with pytest.raises(QT.TooManyViolations, match="orders: 2 of 4"):
        put(spark, tmp_dir, [("s", "2", 30.0), ("s", "1", 40.0), ("s", "3", 1.0), ("s", "4", 2.0)], hour=1, most=0.4, mode=mode)
    assert table(spark, tmp_dir) == [("s", "1", 20.0)] and held(spark, tmp_dir) == [] and not os.listdir(f"{tmp_dir}/_staging/orders")
    # exactly at the limit it goes on
    put(spark, tmp_dir, [("s", "2", 30.0), ("s", "3", 1.0)], hour=1, most=0.5, mode=mode)
    assert len(table(spark, tmp_dir)) == 2 and len(held(spark, tmp_dir)) == 1


def replay(spark, root, mend):
    rows = QT.quarantined(spark, root, "orders", SCHEMA).withColumns(mend)
    return QT.replay(spark, root, "orders", SCHEMA, rows, "pair", KEYS, "ingested_at", RULES)


def test_replay(spark, tmp_dir):
    put(spark, tmp_dir, [("s", "1", 1.0), ("s", "2", 2.0), ("s", "3", 3.0)])
    put(spark, tmp_dir, [("s", "1", 50.0)], hour=5)  # a newer version of order 1 is in the table
    price = F.when(F.col("total_price") < 3, F.col("total_price") + 10).otherwise(F.col("total_price"))
    assert replay(spark, tmp_dir, {"total_price": price}) == {"new": 1, "updated": 0, "released": 2, "superseded": 1, "kept": 1}
    assert table(spark, tmp_dir) == [("s", "1", 50.0), ("s", "2", 12.0)]
    assert held(spark, tmp_dir) == [("s", "3", 3.0, ("price_minimum",))]
    assert replay(spark, tmp_dir, {"total_price": F.lit(99.0)})["released"] == 1
    assert held(spark, tmp_dir) == [] and table(spark, tmp_dir)[-1] == ("s", "3", 99.0)
    # closed records don't come back
    put(spark, tmp_dir, [("s", "3", 3.0)], hour=7)
    assert held(spark, tmp_dir) == []


def test_replay_that_fails_before_the_release(spark, tmp_dir, monkeypatch):
    put(spark, tmp_dir, [("s", "1", 1.0)])
    plain = TB.merge_into

    def merged_then_lost(*a, **k):
        plain(*a, **k)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TB, "merge_into", merged_then_lost)
        with pytest.raises(RuntimeError):
            replay(spark, tmp_dir, {"total_price": F.lit(11.0)})
    assert len(held(spark, tmp_dir)) == 1
    replay(spark, tmp_dir, {"total_price": F.lit(11.0)})
    assert table(spark, tmp_dir) == [("s", "1", 11.0)] and held(spark, tmp_dir) == []


def test_etl_with_rules(spark, tmp_dir):
    landing, tables, log = (os.path.join(tmp_dir, n) for n in ("landing", "tables", "runs"))

    def land(run, kind, docs):
        L.write_raw(spark.createDataFrame([(json.dumps(d),) for d in docs], "json string"), landing, "shopify", kind, run)

    land("a", "products", [{"id": "p1", "title": "x", "variants": [{"price": "5"}]}])
    land("a", "orders", [{"id": str(i), "total_price": str(i)} for i in range(1, 11)])
    rules = {"orders": [Rule("minimum", "total_price", "minimum", 5.0)]}
    with pytest.raises(QT.TooManyViolations):
        etl.run_pipeline(spark, landing, tables, log, key_mode="pair", rules=rules, max_violation_share=0.3)
    # not even the products, which had no fault, are visible
    assert TB.batches(spark, tables, "products") == {} and TB.batches(spark, tables, "orders") == {}
    log_rows = spark.read.schema(SC.RUN_LOG).json(log).collect()
    assert [(r.status, r.quarantined_records, r.new_orders) for r in log_rows] == [("error", 4, 0)]
    got = etl.run_pipeline(spark, landing, tables, log, key_mode="pair", rules=rules, max_violation_share=0.4)
    assert (got["new_products"], got["new_orders"], got["quarantined_records"]) == (1, 6, 4)
    assert QT.quarantined(spark, tables, "orders", SC.ORDERS).count() == 4
    again = etl.run_pipeline(spark, landing, tables, log, key_mode="pair", rules=rules)
    assert (again["raw_files"], again["new_orders"], again["quarantined_records"]) == (0, 0, 0)
    land("b", "orders", [{"id": "11", "total_price": "50"}, {"id": "12", "total_price": "1"}])
    dry = etl.run_pipeline(spark, landing, tables, log, key_mode="pair", rules=rules, dry_run=True)
    assert (dry["new_orders"], dry["quarantined_records"]) == (1, 1) and QT.quarantined(spark, tables, "orders", SC.ORDERS).count() == 4
