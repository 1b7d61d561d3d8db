"""Scalar helpers: coercion, hashing, arrays, JSON packing, day arithmetic."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from basketry.functions import exprs as X


def _one(spark, col, data, schema="v string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col.alias("x")).collect()]


def test_safe_double(spark):
    vals = ["", None, "abc", "0", " 1.5 ", "1.0d", "NaN", "Infinity", "-2e3", ".5", "1_000"]
    got = _one(spark, X.safe_double("v"), [(v,) for v in vals])
    assert got == [None, None, None, 0.0, 1.5, None, None, None, -2000.0, 0.5, None]


def test_email_hash_strips_and_lowercases(spark):
    got = _one(spark, X.email_hash("v"), [(" A@B.com ",), ("\tA@B.COM\n",), ("",), (None,)])
    expect = hashlib.sha256(b"a@b.com").hexdigest()
    assert got[0] == expect and got[1] == expect
    assert expect.startswith("fb98d44a") and expect.endswith("75adf")
    assert got[2] is None and got[3] is None


def test_sku_list(spark):
    schema = "li array<struct<sku:string, variant_id:string>>"
    data = [([("b", None), ("a", None), ("b", "9")],), ([(None, "7"), ("", "3")],), ([(None, None)],), ([],), (None,)]
    got = _one(spark, X.sku_list("li"), data, schema)
    assert got == ["a,b", "3,7", None, None, None]


def test_shipping_and_discount_totals(spark):
    schema = "s array<struct<price:string>>, d array<struct<value:string>>"
    data = [([("1.10",), ("x",), ("2.20",)], [("10",), ("oops",), ("5.5",)]),
            ([], []), (None, None), ([("0",)], [("0",), ("-1",)])]
    df = spark.createDataFrame(data, schema)
    rows = df.select(X.shipping_total("s").alias("s"), X.discount_total("d").alias("d")).collect()
    assert [r["s"] for r in rows] == [3.3, None, None, 0.0]
    assert [r["d"] for r in rows] == [15.5, None, None, None]


def test_floor_days_and_fractional(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.floor_days("a", "b").alias("d"), X.fractional_days("a", "b").alias("f")).first()
    assert r["d"] == -1
    assert r["f"] == -0.25


def test_pack_additional_sorted_nulls_kept_and_whole(spark):
    df = spark.createDataFrame([("h", None, "x" * 9000)], "handle string, vendor string, big string")
    r = df.select(X.pack_additional(vendor=F.col("vendor"), handle=F.col("handle")).alias("a"),
                  X.pack_additional(big=F.col("big")).alias("b")).first()
    assert r["a"] == '{"handle":"h","vendor":null}'
    assert r["b"] == '{"big":"' + "x" * 9000 + '"}'


def test_canonical_hash_ignores_key_order_and_spacing(spark):
    got = _one(spark, X.canonical_json_hash("v"), [('{"a": 1, "b": [1, 2]}',), ('{"b":[1,2],"a":1}',)])
    assert got[0] == got[1]


def test_round_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 5), (2, 0)], "k long, n long")
    got = [r[0] for r in df.select(X.round_ratio("k", "n", 2)).collect()]
    assert got == [0.13, 0.33, 0.0, None]


def test_stddev_matches_pandas(spark):
    import pandas as pd
    vals = [1.25, 2.5, 2.5, 10.75, None, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.agg(X.stddev("v").alias("s"), X.exact_mean("v").alias("m")).first()
    s = pd.Series(vals, dtype="float64")
    assert abs(got["s"] - s.std()) < 1e-12
    assert abs(got["m"] - s.mean()) < 1e-12


def test_sums_and_deviations_keep_the_precision_of_the_values(spark):
    agg = lambda vals, *cols: spark.createDataFrame([(v,) for v in vals], "v double").agg(*cols).first()
    r = agg([0.125, 0.124, 0.374], X.money_sum("v").alias("s"), X.exact_mean("v").alias("m"))
    assert r["s"] == 0.623 and abs(r["m"] - 0.623 / 3) < 1e-15
    assert abs(agg([1.2e-5, 2.2e-5, 3e-5], X.stddev("v"))[0] - 9.018499505645789e-06) < 1e-18
    r = agg([1e15, 1e15 + 2, 1e15 + 4], X.stddev("v").alias("s"), X.money_sum("v").alias("t"))
    assert r["s"] == 2.0 and r["t"] == 3e15 + 6
    # moments merge, so their size doesn't follow the number of rows: 6e11 rows of 5e4 sum to 3e16
    big = spark.range(600).select(F.lit(5e13).alias("v"))
    assert big.agg(X.money_sum("v")).first()[0] == 3e16 and big.agg(X.stddev("v")).first()[0] == 0.0
    assert agg([7.0], X.stddev("v"))[0] is None


def test_hash_of_text_that_is_no_json(spark):
    got = [r[0] for r in spark.createDataFrame([("{broken",), ('{"a":1}',), (None,)], "j string").select(X.canonical_json_hash("j")).collect()]
    assert got[0] == hashlib.sha256(b"{broken").hexdigest() and got[1] and got[2] is None


def test_multiset_digest_is_order_insensitive(spark):
    hs = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)]
    a = spark.createDataFrame([(h,) for h in hs], "h string").repartition(7)
    b = spark.createDataFrame([(h,) for h in reversed(hs)], "h string").coalesce(1)
    da = a.agg(X.multiset_digest("h")).first()[0]
    db = b.agg(X.multiset_digest("h")).first()[0]
    dc = b.limit(49).agg(X.multiset_digest("h")).first()[0]
    assert da == db and da != dc
    last = spark.createDataFrame([(h[:-1] + ("0" if h[-1] != "0" else "1") if i == 3 else h,) for i, h in enumerate(hs)], "h string")
    assert last.agg(X.multiset_digest("h")).first()[0] != da     # every digit counts
