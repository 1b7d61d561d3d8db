"""Quantiles, qcut buckets, rolling windows, histograms against pandas/numpy."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from basketry.functions.quantiles import quantiles
from basketry.operators import features as FE
from basketry.operators import kpis as K


def test_quantile_fixture(spark):
    vals = [1, 2, 2, 3, 4, 10, None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "p double")
    r = quantiles(df, "p", {"q25": .25, "q50": .5, "q75": .75, "q90": .9}).first()
    assert (r["q25"], r["q50"], r["q75"], r["q90"]) == (2.0, 2.5, 3.75, 7.0)
    assert r["n"] == 6


def test_quantiles_match_pandas_grouped_with_ties(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), float(rng.randint(0, 40)) / 4) for _ in range(3000)]
    rows += [("hot", 5.0)] * 2000 + [("hot", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(13)
    probs = {"p0": 0.0, "p10": .1, "p33": 1 / 3, "p50": .5, "p90": .9, "p100": 1.0}
    got = {r["g"]: r for r in quantiles(df, "v", probs, by=["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, s in pdf.groupby("g")["v"]:
        for k, p in probs.items():
            assert abs(got[g][k] - s.quantile(p)) < 1e-9, (g, k)
        assert got[g]["n"] == len(s)


def test_qcut_buckets_match_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 4.0, 10.0, None]
    df = spark.createDataFrame([("s", str(i), v, None) for i, v in enumerate(vals)],
                               "source string, source_id string, price double, category string")
    got = [r["price_bucket"] for r in FE.enrich_products(df, "price").orderBy(F.col("source_id").cast("int")).collect()]
    cats = pd.qcut(pd.Series(vals), q=5, duplicates="drop")
    expect = [None if pd.isna(c) else int(c) for c in cats.cat.codes.replace(-1, np.nan)]
    assert got == expect == [0, 0, 0, 1, 2, 3, None]


def test_qcut_all_equal_is_null(spark):
    df = spark.createDataFrame([("s", str(i), 5.0, "c") for i in range(5)],
                               "source string, source_id string, price double, category string")
    assert [r["price_bucket"] for r in FE.enrich_products(df, "price").collect()] == [None] * 5


def test_qcut_on_random_prices(spark):
    rng = random.Random(3)
    vals = [float(rng.randint(1, 30)) for _ in range(500)]
    df = spark.createDataFrame([("s", str(i), v, None) for i, v in enumerate(vals)],
                               "source string, source_id string, price double, category string")
    got = [r["price_bucket"] for r in FE.enrich_products(df, "price").orderBy(F.col("source_id").cast("int")).collect()]
    expect = list(pd.qcut(pd.Series(vals), q=5, duplicates="drop").cat.codes)
    assert got == expect


def test_rolling_fixture(spark):
    rows = [("1", dt.datetime(2024, 1, 1, 10), 1.0), ("2", dt.datetime(2024, 1, 1, 0), 2.0),
            ("3", dt.datetime(2024, 1, 4, 3), 3.0)]
    df = spark.createDataFrame(rows, "order_id string, created_at timestamp_ntz, total_price double")
    r = FE.rolling_7d(df).orderBy("day").collect()
    assert [x["gmv_7d"] for x in r] == [3.0, 3.0, 3.0, 6.0]
    assert [x["orders_7d"] for x in r] == [2, 2, 2, 3]
    assert [x["gmv"] for x in r] == [3.0, None, None, 3.0]
    e = {x["order_id"]: x for x in FE.enrich_orders(df).collect()}
    assert e["1"]["gmv_7d"] == 3.0 and e["3"]["aov_7d"] == 2.0
    assert abs(e["2"]["recency_days"] - (3 + 3 / 24)) < 1e-12


def test_histogram_matches_numpy(spark):
    rng = random.Random(5)
    vals = [rng.uniform(5, 300) for _ in range(2000)] + [5.0, 300.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = FE.histogram(df, "v", 20).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=20)
    assert [r["count"] for r in got] == list(counts)
    assert got[-1]["bin_hi"] == 300.0 and got[0]["bin_lo"] == 5.0
    same = FE.histogram(spark.createDataFrame([(7.0,), (7.0,)], "v double"), "v", 4).orderBy("bin").collect()
    np_counts, _ = np.histogram([7.0, 7.0], bins=4)
    assert [r["count"] for r in same] == list(np_counts)


def test_daily_summary_and_outliers(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 5), 10.0), ("b", dt.datetime(2024, 1, 1, 6), None),
            ("c", dt.datetime(2024, 1, 3, 1), 30.0), ("d", None, 99.0)]
    df = spark.createDataFrame(rows, "order_id string, created_at timestamp_ntz, total_price double")
    s = K.daily_summary(df).first()
    assert (s["gmv_total"], s["orders_total"], s["days_span"], s["aov_mean"]) == (40.0, 3, 2, (5.0 + 30.0) / 2)
    prices = [1.0, 2.0, 2.0, 3.0, 4.0, 10.0, 100.0, None]
    p = spark.createDataFrame([("s", str(i), v, None) for i, v in enumerate(prices)],
                              "source string, source_id string, price_amount double, category string")
    two = K.outliers_two_sided(p).first()
    pn = pd.Series(prices, dtype="float64")
    q1, q3 = pn.quantile(.25), pn.quantile(.75)
    iqr = q3 - q1
    assert two["outlier_price_ratio"] == (((pn > q3 + 1.5 * iqr) | (pn < q1 - 1.5 * iqr)).mean())
    up = K.outliers_upper(p).first()
    assert up["price_outlier_ratio"] == round(float((pn > q3 + 1.5 * iqr).mean()), 4)


def test_approx_quantiles_close(spark):
    rng = random.Random(11)
    vals = [rng.gauss(100, 15) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = quantiles(df, "v", {"p10": .1, "p50": .5, "p90": .9}, method="approx").first()
    s = pd.Series(vals)
    assert r["n"] == 5000
    for k, p in (("p10", .1), ("p50", .5), ("p90", .9)):
        assert abs((s < r[k]).mean() - p) < 0.01
