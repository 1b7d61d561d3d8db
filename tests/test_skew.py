"""Hot keys: one key / group holding a third of the rows must give exact
results and be combined map-side, never funnelled through a window on the key."""

import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas as SC
from basketry.functions.quantiles import quantiles
from basketry.operators import kpis as K
from basketry.operators import merge as M


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _batch(spark, n=3000):
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else f"k{i}"
        rows.append(("shop", key, f"t{i}", float(i), None, None, None, None,
                     dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), f"h{i}", None, None))
    return spark.createDataFrame(rows, SC.PRODUCTS).repartition(8)


def test_hot_key_latest_per_key(spark):
    batch = _batch(spark)
    latest = M.latest_per_key(batch, M.PRODUCT_KEYS, [M.PRODUCT_ORDER, "raw_hash"])
    plan = _plan(latest)
    assert "partial_max_by" in plan and "Window" not in plan
    hot = latest.where(F.col("source_id") == "HOT").first()
    assert hot["title"] == "t2997"
    assert latest.count() == 1 + 2000


def test_hot_key_pair_merge(spark):
    batch = _batch(spark)
    existing = spark.createDataFrame([("shop", "HOT", "old", 1.0, None, None, None, None, dt.datetime(2023, 1, 1),
                                       "h", None, None)], SC.PRODUCTS)
    res = M.merge_products(existing, batch, "pair")
    c = res.counts.first()
    assert (c["new"], c["updated"]) == (2000, 1)
    assert res.table.where(F.col("source_id") == "HOT").count() == 1


def test_hot_group_quantiles_and_counts(spark):
    df = _batch(spark).withColumn("g", F.when(F.col("source_id") == "HOT", "HOT").otherwise("rest"))
    got = {r["g"]: r for r in quantiles(df, "price_amount", {"m": .5}, by=["g"]).collect()}
    assert got["HOT"]["n"] == 1000 and got["HOT"]["m"] == 1498.5
    top = K.top_values(df, "g", 2).collect()
    assert [(r["g"], r["count"]) for r in top] == [("rest", 2000), ("HOT", 1000)]
    assert "partial_count" in _plan(K.top_values(df, "g", 2))
