"""How often rows are dealt: counted in the plans, with joins by shuffle as on large tables."""

import pytest

from basketry.functions import exprs as X
from basketry.operators import merge as M
from basketry.plans import raw_views as R
from pyspark.sql import functions as F

KEYS = ["source", "id"]


@pytest.fixture()
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    # of a new frame: a frame that has run shows its first and its last plan
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def two(spark):
    left = spark.createDataFrame([("a", "1", 1), ("a", None, 2), (None, None, 3), ("b", "2", 4), ("b", "2", 5)], "source string, id string, v int")
    right = spark.createDataFrame([("a", None), (None, None), ("b", "3"), ("b", "3")], "source string, id string")
    return left, right


def test_key_joins_deal_each_side_once(shuffled):
    left, right = two(shuffled)
    kept = M.anti_join(left, right, KEYS)
    assert kept.columns == left.columns and sorted(r.v for r in kept.collect()) == [1, 4, 5]
    counts = M.key_counts(left, right, KEYS)
    assert tuple(counts.first()) == (3, 2)
    assert plan(kept).count("Exchange hashpartitioning") == 2 and plan(counts).count("Exchange hashpartitioning") == 2


def test_latest_rows_are_joined_as_they_lie(shuffled):
    left, right = two(shuffled)
    latest = M.latest_per_key(left, KEYS, ["v"], keyed=True)
    joined = latest.join(right.select(F.struct(*KEYS).alias(M.KEY)).distinct().withColumn("hit", F.lit(1)), M.KEY, "left")
    assert sorted((r.v, r.hit) for r in joined.collect() if r.hit) == [(2, 1), (3, 1)] and joined.count() == 4
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_orders_with_their_lines_are_dealt_by_order_alone(shuffled, tmp_dir):
    for name, rows, schema in (
            ("orders", "(1L, 7L), (2L, null), (3L, 8L)", "o_orderkey, o_custkey"),
            ("customer", "(7L, 'Ann'), (9L, 'Bo')", "c_custkey, c_name")):
        df = shuffled.sql(f"SELECT * FROM VALUES {rows} AS t({schema})")
        if name == "orders":
            df = df.selectExpr("*", "'F' AS o_orderstatus", "10.5D AS o_totalprice", "TIMESTAMP_NTZ '2000-01-01' AS o_orderdate", "'1' AS o_orderpriority")
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    shuffled.sql("""SELECT 1L AS l_orderkey, 5L AS l_partkey, 6L AS l_suppkey, n AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax,
        'R' AS l_returnflag FROM VALUES (1), (2) AS t(n)""").write.parquet(f"{tmp_dir}/lineitem.parquet")
    js = R.shopify_orders_json(shuffled, tmp_dir)
    got = {
        r.id: (r.lines, r.email) for r in js.select(F.get_json_object("json", "$.id").alias("id"), F.size(F.from_json("json", "line_items array<string>")["line_items"]).alias("lines"),
                                                    F.get_json_object("json", "$.customer.email").alias("email")).collect()}
    assert {k: (max(n or 0, 0), e and e.strip()) for k, (n, e) in got.items()} == {"1": (2, "Ann@Shop.Example"), "2": (0, None), "3": (0, None)}
    lines = plan(js).splitlines()
    wide = next(i for i, line in enumerate(lines) if "SortMergeJoin [o_orderkey" in line)
    narrow = next(i for i, line in enumerate(lines) if "SortMergeJoin [o_custkey" in line)
    # nothing is dealt between the lines and the rendering
    assert wide < narrow and not any("Exchange" in line for line in lines[:wide])


def test_sku_list_is_made_once(spark):
    df = spark.createDataFrame([([("b", "1"), (None, "a"), ("b", "2"), ("", None)],), ([("", None)],), ([],), (None,)], "l array<struct<sku: string, variant_id: string>>")
    out = df.select(X.sku_list("l").alias("s"))
    assert [r.s for r in out.collect()] == ["a,b", None, None, None]
    assert plan(out).count("array_join") == 1


def test_numbers_as_text(spark):
    rows = ["1.5", " 2 ", "1e3", "NaN", "nan", "-.5", "1.0d", "", None, "Infinity"]
    got = [r.v for r in spark.createDataFrame([(x,) for x in rows], "s string").select(X.safe_double("s").alias("v")).collect()]
    assert got == [1.5, 2.0, 1000.0, None, None, -0.5, None, None, None, None]
    assert plan(spark.createDataFrame([("1",)], "s string").select(X.safe_double("s").alias("v"))).count("RLIKE") == 1
