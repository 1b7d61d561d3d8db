"""Merge semantics: the reference's two dedup tests plus edge cases."""

import datetime as dt

import pytest

from basketry import schemas as SC
from basketry.operators import merge as M


def _products(spark, version, rows=(("A", "Prod A", 10.0, 0), ("B", "Prod B", 12.0, 10))):
    data = []
    for sid, title, price, sec in rows:
        data.append(("shopify", sid, f"{title} v{version}", price, "USD", None, None, None,
                     dt.datetime(2024, 1, 1, 0, 0, sec + version), f"hash{sid}_{version}", None, None))
    return spark.createDataFrame(data, SC.PRODUCTS)


def _empty(spark):
    return spark.createDataFrame([], SC.PRODUCTS)


def _counts(res):
    r = res.counts.first()
    return r["new"], r["updated"]


def test_triple_mode_keeps_versions(spark):
    r1 = M.merge_products(_empty(spark), _products(spark, 1), "triple")
    assert _counts(r1) == (2, 0)
    table1 = r1.table.cache()
    r2 = M.merge_products(table1, _products(spark, 2), "triple")
    assert _counts(r2) == (2, 0)
    assert r2.table.count() == 4


def test_pair_mode_replaces(spark):
    r1 = M.merge_products(_empty(spark), _products(spark, 1), "pair")
    assert _counts(r1) == (2, 0)
    table1 = r1.table.cache()
    assert table1.count() == 2
    r2 = M.merge_products(table1, _products(spark, 2), "pair")
    assert _counts(r2) == (0, 2)
    rows = r2.table.collect()
    assert len(rows) == 2
    assert sorted(r["title"] for r in rows) == ["Prod A v2", "Prod B v2"]


def test_triple_is_idempotent(spark):
    t = M.merge_products(_empty(spark), _products(spark, 1), "triple").table.cache()
    again = M.merge_products(t, _products(spark, 1), "triple")
    assert _counts(again) == (0, 0)
    assert again.table.count() == 2


def test_pair_latest_inside_batch_and_null_keys(spark):
    batch = _products(spark, 1).unionByName(_products(spark, 2)).unionByName(
        spark.createDataFrame([("shopify", None, "no id", 1.0, None, None, None, None,
                                dt.datetime(2024, 1, 2), "h0", None, None)], SC.PRODUCTS))
    res = M.merge_products(_empty(spark), batch, "pair")
    rows = {r["source_id"]: r["title"] for r in res.table.collect()}
    assert rows == {"A": "Prod A v2", "B": "Prod B v2", None: "no id"}
    assert _counts(res) == (3, 0)
    # null key of the table is matched null-safely by a null key of the batch
    again = M.merge_products(res.table.cache(), batch, "pair")
    assert _counts(again) == (0, 3)
    assert again.table.count() == 3


def test_pair_new_plus_updated_equals_distinct_batch_keys(spark):
    existing = _products(spark, 1, rows=(("A", "a", 1.0, 0),)).cache()
    batch = _products(spark, 2, rows=(("A", "a", 2.0, 0), ("C", "c", 3.0, 1), ("C", "c", 4.0, 2)))
    res = M.merge_products(existing, batch, "pair")
    new, upd = _counts(res)
    assert (new, upd) == (1, 1)
    assert new + upd == batch.select("source", "source_id").distinct().count()


def test_empty_batch_and_unknown_mode(spark):
    base = _products(spark, 1).cache()
    res = M.merge_products(base, _empty(spark), "pair")
    assert _counts(res) == (0, 0)
    assert res.table.count() == 2
    with pytest.raises(ValueError):
        M.merge_products(base, _empty(spark), "quad")
    with pytest.raises(ValueError):
        M.merge_products(_empty(spark), _empty(spark), "quad")


def test_orders_pair_dedups_first_load(spark):
    def order(oid, ts, price):
        return ("shopify", oid, None, None, None, "USD", price, None, None, None, None, "paid", None, 1, None,
                None, None, None, f"h{oid}{price}", ts, None)
    batch = spark.createDataFrame([order("1", dt.datetime(2024, 1, 1), 5.0), order("1", dt.datetime(2024, 1, 2), 6.0),
                                   order("2", dt.datetime(2024, 1, 1), 7.0)], SC.ORDERS)
    res = M.merge_orders(spark.createDataFrame([], SC.ORDERS), batch, "pair")
    got = {r["order_id"]: r["total_price"] for r in res.table.collect()}
    assert got == {"1": 6.0, "2": 7.0}
