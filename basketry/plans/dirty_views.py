"""Raw text extracts (CSV-like, every column STRING) rendered from the supplied
tables for the twelve cleaning jobs.

Defects come from the data itself, by fixed content rules: missing-value
tokens ('NA', 'n/a', '') where a column is unknown, unparseable dates and
numbers, returns as negative quantities, zero quantities, repeated rows
where an extract lists an entity once per line item. Each Spark view has an
SQL twin for the oracle; both render numbers as DECIMAL(18,2) text and dates
with explicit layouts so the text is identical in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import table


def _i(c: str) -> Column:
    return F.col(c).cast("bigint").cast("string")


def _m(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,2)").cast("string")


def _iso(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def _us(c: str) -> Column:
    return F.date_format(F.col(c), "M/d/yyyy H:mm")


def _str(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def ecommerce(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    pending_low = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return _str(j.select(
        F.when(pending_low, F.lit("NA")).otherwise(_i("o_custkey")).alias("Customer_Id"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "3-MEDIUM"), F.lit("not a date"))
        .otherwise(_iso("o_orderdate")).alias("Order_Date"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
               F.concat(F.lit("-"), _m("o_totalprice"))).otherwise(_m("o_totalprice")).alias("Sales"),
        _i("c_nationkey").alias("Quantity"),
        _m("c_acctbal").alias("Discount"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("")).when(F.col("c_mktsegment") == "BUILDING", F.lit("F"))
        .otherwise(F.lit("M")).alias("Gender"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Mobile"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.lit("Web")).alias("Device_Type"),
        F.col("c_mktsegment").alias("Product_Category")))


ECOMMERCE_SQL = """
SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END
         AS "Customer_Id",
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'not a date'
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "Order_Date",
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
            THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "Sales",
       CAST(c_nationkey AS VARCHAR) AS "Quantity",
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS "Discount",
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '' WHEN c_mktsegment = 'BUILDING' THEN 'F' ELSE 'M' END AS "Gender",
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Mobile' WHEN o_orderpriority = '5-LOW' THEN 'NA'
            ELSE 'Web' END AS "Device_Type",
       c_mktsegment AS "Product_Category"
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def online_retail(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    return _str(li.select(
        _i("l_orderkey").alias("InvoiceNo"), _i("l_partkey").alias("StockCode"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), qty)).otherwise(qty).alias("Quantity"),
        _us("l_shipdate").alias("InvoiceDate"),
        _m("l_extendedprice").alias("UnitPrice"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") == 0), F.lit("NA"))
        .otherwise(_i("l_suppkey")).alias("CustomerID")))


ONLINE_RETAIL_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS "InvoiceNo", CAST(l_partkey AS VARCHAR) AS "StockCode",
       CASE WHEN l_returnflag = 'R' THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
            ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS "Quantity",
       strftime(l_shipdate, '%-m/%-d/%Y %-H:%M') AS "InvoiceDate",
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS "UnitPrice",
       CASE WHEN l_linestatus = 'O' AND l_discount = 0 THEN 'NA' ELSE CAST(l_suppkey AS VARCHAR) END AS "CustomerID"
FROM lineitem"""


def sale_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return _str(o.select(
        _i("o_orderkey").alias("Order_ID"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Order_Date"),
        _m("o_totalprice").alias("Sales"),
        F.when(F.col("o_orderstatus") == "O", F.lit("unknown")).otherwise(_m("o_totalprice")).alias("Profit")))


SALE_REPORT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS "Order_ID",
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN ''
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Order_Date",
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "Sales",
       CASE WHEN o_orderstatus = 'O' THEN 'unknown' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END
         AS "Profit"
FROM orders"""


def br_orders(spark: SparkSession, d: str) -> DataFrame:
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    ship = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    j = o.join(ship, o["o_orderkey"] == ship["l_orderkey"], "left")
    return _str(j.select(
        _i("o_orderkey").alias("order_id"), _i("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        _iso("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(_iso("o_orderdate")).alias("order_approved_at"),
        _iso("first_ship").alias("order_delivered_carrier_date"),
        _iso("last_ship").alias("order_delivered_customer_date"),
        _us("last_ship").alias("order_estimated_delivery_date")))


BR_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
       CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_approved_at,
       strftime(first_ship, '%Y-%m-%d %H:%M:%S') AS order_delivered_carrier_date,
       strftime(last_ship, '%Y-%m-%d %H:%M:%S') AS order_delivered_customer_date,
       strftime(last_ship, '%-m/%-d/%Y %-H:%M') AS order_estimated_delivery_date
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                       FROM lineitem GROUP BY l_orderkey) s ON o_orderkey = l_orderkey"""


def br_order_items(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    freight = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)"), 2)
    return _str(li.select(
        _i("l_orderkey").alias("order_id"), _i("l_linenumber").alias("order_item_id"),
        _i("l_partkey").alias("product_id"), _i("l_suppkey").alias("seller_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit("NA"))
        .otherwise(_m("l_extendedprice")).alias("price"),
        _iso("l_shipdate").alias("shipping_limit_date"),
        _m(freight).alias("freight_value")))


BR_ORDER_ITEMS_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'NA'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
       CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2))
            AS VARCHAR) AS freight_value
FROM lineitem"""


def br_customers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return _str(c.select(_i("c_custkey").alias("customer_id"),
                         F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name")).alias("customer_unique_id"),
                         F.col("c_mktsegment").alias("customer_state")))


BR_CUSTOMERS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS customer_unique_id,
       c_mktsegment AS customer_state FROM customer"""


def br_payments(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    ptype = F.when(F.col("l_returnflag") == "A", F.lit("credit_card")).when(F.col("l_returnflag") == "N", F.lit("boleto")) \
        .otherwise(F.lit("not_defined"))
    return _str(li.select(_i("l_orderkey").alias("order_id"), _i("l_linenumber").alias("payment_sequential"),
                          ptype.alias("payment_type"), _m("l_extendedprice").alias("payment_value")))


BR_PAYMENTS_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
       CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto' ELSE 'not_defined' END
         AS payment_type,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS payment_value
FROM lineitem"""


def br_reviews(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels")
    score = (F.col("quality") * F.lit(4) + F.lit(1) - F.col("toxic")).cast("string")
    return _str(lab.select(F.concat(F.lit("r"), _i("doc_id")).alias("review_id"), _i("doc_id").alias("order_id"),
                           F.when(F.col("toxic") == 1, F.lit("spam")).otherwise(score).alias("review_score")))


BR_REVIEWS_SQL = """
SELECT 'r' || CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
       CASE WHEN toxic = 1 THEN 'spam' ELSE CAST(quality * 4 + 1 - toxic AS VARCHAR) END AS review_score
FROM labels"""


def br_products(spark: SparkSession, d: str) -> DataFrame:
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "left")
    return _str(j.select(_i("l_partkey").alias("product_id"),
                         F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.lower("p_type"))
                         .alias("product_category_name"),
                         _i("p_size").alias("product_weight_g")))


BR_PRODUCTS_SQL = """
SELECT CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_type = 'PROMO' THEN '' ELSE lower(p_type) END AS product_category_name,
       CAST(p_size AS VARCHAR) AS product_weight_g
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""


def br_sellers(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return _str(li.select(_i("l_suppkey").alias("seller_id"), F.col("l_linestatus").alias("seller_state")))


BR_SELLERS_SQL = "SELECT CAST(l_suppkey AS VARCHAR) AS seller_id, l_linestatus AS seller_state FROM lineitem"


def br_geolocation(spark: SparkSession, d: str) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return _str(j.select(_i("c_nationkey").alias("geolocation_zip_code_prefix"),
                         (F.col("n_regionkey") * F.lit(10) - F.lit(25)).cast("string").alias("geolocation_lat"),
                         F.when(F.col("n_regionkey") == 0, F.lit("-")).otherwise(
                             (F.col("c_nationkey") * F.lit(2) - F.lit(60)).cast("string")).alias("geolocation_lng"),
                         F.col("n_name").alias("geolocation_city")))


BR_GEOLOCATION_SQL = """
SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
       CAST(n_regionkey * 10 - 25 AS VARCHAR) AS geolocation_lat,
       CASE WHEN n_regionkey = 0 THEN '-' ELSE CAST(c_nationkey * 2 - 60 AS VARCHAR) END AS geolocation_lng,
       n_name AS geolocation_city
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


def br_category_translation(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return _str(p.select(F.lower("p_type").alias("product_category_name"),
                         F.when(F.col("p_type") == "MEDIUM", F.lit("N/A")).otherwise(F.initcap(F.lower("p_type")))
                         .alias("product_category_name_english")))


BR_CATEGORY_TRANSLATION_SQL = """
SELECT lower(p_type) AS product_category_name,
       CASE WHEN p_type = 'MEDIUM' THEN 'N/A' ELSE upper(p_type[1]) || lower(p_type[2:]) END
         AS product_category_name_english
FROM part"""


# dataset name -> (Spark view, SQL twin, columns in order)
EXTRACTS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str, list[str]]] = {
    "E-commerce Dataset": (ecommerce, ECOMMERCE_SQL, ["Customer_Id", "Order_Date", "Sales", "Quantity", "Discount",
                                                      "Gender", "Device_Type", "Product_Category"]),
    "online_retail": (online_retail, ONLINE_RETAIL_SQL, ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate",
                                                         "UnitPrice", "CustomerID"]),
    "Sale Report": (sale_report, SALE_REPORT_SQL, ["Order_ID", "Order_Date", "Sales", "Profit"]),
    "orders": (br_orders, BR_ORDERS_SQL, ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                                          "order_approved_at", "order_delivered_carrier_date",
                                          "order_delivered_customer_date", "order_estimated_delivery_date"]),
    "order_items": (br_order_items, BR_ORDER_ITEMS_SQL, ["order_id", "order_item_id", "product_id", "seller_id",
                                                         "price", "shipping_limit_date", "freight_value"]),
    "customers": (br_customers, BR_CUSTOMERS_SQL, ["customer_id", "customer_unique_id", "customer_state"]),
    "payments": (br_payments, BR_PAYMENTS_SQL, ["order_id", "payment_sequential", "payment_type", "payment_value"]),
    "reviews": (br_reviews, BR_REVIEWS_SQL, ["review_id", "order_id", "review_score"]),
    "products": (br_products, BR_PRODUCTS_SQL, ["product_id", "product_category_name", "product_weight_g"]),
    "sellers": (br_sellers, BR_SELLERS_SQL, ["seller_id", "seller_state"]),
    "geolocation": (br_geolocation, BR_GEOLOCATION_SQL, ["geolocation_zip_code_prefix", "geolocation_lat",
                                                         "geolocation_lng", "geolocation_city"]),
    "category_translation": (br_category_translation, BR_CATEGORY_TRANSLATION_SQL,
                             ["product_category_name", "product_category_name_english"]),
}
