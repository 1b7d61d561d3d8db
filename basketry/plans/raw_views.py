"""Raw provider payloads synthesised from the supplied tables.

Each function renders rows of the supplied tables into the JSON shape a
provider delivers, as JSON *text* (what a landing file holds), and parses it
back with the explicit raw schema. The normalizers therefore run over real
nested JSON whose size grows with the scale factor, while the SQL oracle
computes the expected unified rows straight from the flat tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as SC
from ..functions import exprs as X
from .views import table

RAW_FILE = "landing/{provider}/{resource}/synthetic.json"
STAMP = "2024-05-01 00:00:00"


def _landed(js: DataFrame, schema, provider: str, resource: str) -> DataFrame:
    """JSON text -> typed payload + raw_file + per-record canonical hash."""
    return js.select(
        F.from_json("json", schema).alias("payload"),
        F.lit(RAW_FILE.format(provider=provider, resource=resource)).alias("raw_file"),
        X.canonical_json_hash(F.col("json")).alias("raw_hash"))


# --- provider A products (from part) -----------------------------------------
# Fixed rendering rules: SMALL parts carry their currency only in the
# presentment prices; STANDARD parts have no product type, so the category
# falls back to the first tag; PROMO parts have no image.

def shopify_products_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    variant = F.struct(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.when(F.col("p_type") != "SMALL", F.lit("USD")).alias("currency"),
        F.array(F.struct(F.struct(F.lit("USD").alias("currency_code")).alias("price"))).alias("presentment_prices"))
    images = F.when(F.col("p_type") != "PROMO",
                    F.array(F.struct(F.concat(F.lit("https://img.example/"), F.col("p_partkey").cast("string"),
                                              F.lit(".jpg")).alias("src"))))
    payload = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
        F.array(variant).alias("variants"), images.alias("images"),
        F.when(F.col("p_type") != "STANDARD", F.col("p_type")).otherwise(F.lit("")).alias("product_type"),
        F.lower(F.regexp_replace("p_name", " ", "-")).alias("handle"),
        F.col("p_brand").alias("vendor"),
        F.array_join(F.split("p_name", " "), ", ").alias("tags"))
    return p.select(F.to_json(payload).alias("json"))


def shopify_products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(shopify_products_json(spark, sf_dir), SC.RAW_SHOPIFY_PRODUCT, "shopify", "products")


SHOPIFY_PRODUCTS_SQL = """
SELECT 'shopify' AS source, CAST(p_partkey AS VARCHAR) AS source_id, p_name AS title,
       p_retailprice AS price_amount, 'USD' AS price_currency,
       CASE WHEN p_type <> 'PROMO' THEN 'https://img.example/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS image_url,
       CASE WHEN p_type <> 'STANDARD' THEN p_type ELSE trim(split_part(p_name, ' ', 1)) END AS category
FROM part"""


# --- provider B products: search responses of up to ten items -----------------
# Fixed rendering rules: a response page holds the parts whose key shares the
# same tens (p_partkey div 10); ECONOMY parts have no offer.

def amazon_responses_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    asin = F.concat(F.lit("B"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    offers = F.when(F.col("p_type") != "ECONOMY", F.array(F.struct(F.struct(
        F.col("p_retailprice").cast("string").alias("Amount"), F.lit("USD").alias("Currency")).alias("Price"))))
    item = F.struct(
        asin.alias("ASIN"),
        F.struct(F.struct(F.col("p_name").alias("DisplayValue")).alias("Title")).alias("ItemInfo"),
        F.struct(offers.alias("Listings")).alias("Offers"),
        F.struct(F.struct(F.struct(F.concat(F.lit("https://m.example/"), asin, F.lit(".jpg")).alias("URL"))
                          .alias("Small")).alias("Primary")).alias("Images"),
        F.struct(F.array(F.col("p_type")).alias("BrowseNodes")).alias("BrowseNodeInfo"),
        F.concat(F.lit("https://shop.example/dp/"), asin).alias("DetailPageURL"))
    pages = p.groupBy(F.floor(F.col("p_partkey") / 10).alias("page")).agg(F.collect_list(item).alias("items"))
    return pages.select(F.to_json(F.struct(F.struct(F.col("items").alias("Items")).alias("ItemsResult"))).alias("json"))


def amazon_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(amazon_responses_json(spark, sf_dir), SC.RAW_AMAZON_RESPONSE, "amazon", "items")


AMAZON_SQL = """
SELECT 'amazon' AS source, 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS source_id, p_name AS title,
       CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice END AS price_amount,
       CASE WHEN p_type <> 'ECONOMY' THEN 'USD' END AS price_currency,
       'https://m.example/B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '.jpg' AS image_url,
       CAST(NULL AS VARCHAR) AS category,
       'https://shop.example/dp/B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS url
FROM part"""


# --- provider C products: one search item per line ------------------------------
# Fixed rendering rules: price.value is a JSON number; parts of size above 45
# send categoryPath as a plain string (not a list) -> no category.

def ebay_items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    base = F.struct(
        F.concat(F.lit("v1|"), F.col("p_partkey").cast("string")).alias("itemId"),
        F.col("p_name").alias("title"),
        F.struct(F.col("p_retailprice").alias("value"), F.lit("USD").alias("currency")).alias("price"),
        F.struct(F.concat(F.lit("https://e.example/"), F.col("p_partkey").cast("string")).alias("imageUrl"))
        .alias("image"),
        F.concat(F.lit("https://e.example/itm/"), F.col("p_partkey").cast("string")).alias("itemWebUrl"),
        F.struct(F.col("p_brand").alias("username")).alias("seller"),
        F.lit("NEW").alias("condition"))
    path = F.when(F.col("p_size") > 45, F.lit('"Misc"')).otherwise(
        F.to_json(F.array(F.col("p_type"), F.col("p_brand"))))
    body = p.select(F.to_json(base).alias("js"), path.alias("path"))
    # splice the heterogeneous field into the object text
    return body.select(F.expr("concat(substring(js, 1, length(js) - 1), ',\"categoryPath\":', path, '}')")
                       .alias("json"))


def ebay_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(ebay_items_json(spark, sf_dir), SC.RAW_EBAY_ITEM, "ebay", "items")


EBAY_SQL = """
SELECT 'ebay' AS source, 'v1|' || CAST(p_partkey AS VARCHAR) AS source_id, p_name AS title,
       p_retailprice AS price_amount, 'USD' AS price_currency,
       'https://e.example/' || CAST(p_partkey AS VARCHAR) AS image_url,
       CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS category,
       'https://e.example/itm/' || CAST(p_partkey AS VARCHAR) AS url
FROM part"""


# --- provider A orders (orders + lineitem + customer) ------------------------------
# Fixed rendering rules: pending orders ('P') carry no order_number, only a
# name; each line ships at price = extendedprice * tax and is discounted by
# extendedprice * discount (in cents); line items of a returned line ('R')
# have no sku, only a variant id; the e-mail is padded and capitalised.

def shopify_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer")
    def cents_of(a, b):
        return F.round(a.cast("decimal(18,2)") * b.cast("decimal(18,2)"), 2).cast("decimal(18,2)").cast("string")
    line = F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_suppkey").cast("string").alias("variant_id"))
    entry = F.struct(line.alias("li"),
                     cents_of(F.col("l_extendedprice"), F.col("l_tax")).alias("ship"),
                     cents_of(F.col("l_extendedprice"), F.col("l_discount")).alias("disc"))
    # one collected array per order, split afterwards (one aggregation buffer)
    lines = li.groupBy("l_orderkey").agg(F.collect_list(entry).alias("_e")).select(
        "l_orderkey",
        F.transform("_e", lambda e: e["li"]).alias("line_items"),
        F.transform("_e", lambda e: F.struct(e["ship"].alias("price"))).alias("shipping_lines"),
        F.transform("_e", lambda e: F.struct(e["disc"].alias("value"))).alias("discount_applications"))
    cust = c.select(F.col("c_custkey"),
                    F.concat(F.lit("  "), F.col("c_name"), F.lit("@Shop.Example \t")).alias("email"))
    # the customer first: an order with its lines, the wide row, is dealt once, by its own key
    j = o.join(cust, o["o_custkey"] == cust["c_custkey"], "left") \
        .join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    payload = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") + F.lit(1000)).cast("string")).alias("order_number"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit(None).cast("string").alias("closed_at"),
        F.lit("USD").alias("currency"),
        F.col("o_totalprice").cast("string").alias("total_price"),
        F.lit(None).cast("string").alias("subtotal_price"),
        F.lit(None).cast("string").alias("total_tax"),
        "shipping_lines", "discount_applications",
        F.col("o_orderstatus").alias("financial_status"),
        F.lit(None).cast("string").alias("fulfillment_status"),
        "line_items",
        F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("email")).alias("customer"),
        F.lit("manual").alias("gateway"), F.lit("direct").alias("processing_method"),
        F.lit(None).cast("string").alias("cancelled_at"), F.col("o_orderpriority").alias("tags"))
    return j.select(F.to_json(payload).alias("json"))


def shopify_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(shopify_orders_json(spark, sf_dir), SC.RAW_SHOPIFY_ORDER, "shopify", "orders")


SHOPIFY_ORDERS_SQL = """
WITH l AS (
  SELECT l_orderkey, count(*) AS n,
         string_agg(DISTINCT CASE WHEN l_returnflag <> 'R' THEN CAST(l_partkey AS VARCHAR)
                                  ELSE CAST(l_suppkey AS VARCHAR) END, ','
                    ORDER BY CASE WHEN l_returnflag <> 'R' THEN CAST(l_partkey AS VARCHAR)
                                  ELSE CAST(l_suppkey AS VARCHAR) END) AS skus,
         sum(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(38,9)))
           AS ship,
         sum(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2)
                  AS DECIMAL(38,9))) AS disc
  FROM lineitem GROUP BY l_orderkey)
SELECT 'shopify' AS source, CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_orderkey + 1000 AS VARCHAR) ELSE '#' || CAST(o.o_orderkey AS VARCHAR) END
         AS source_order_number,
       'USD' AS currency, o.o_totalprice AS total_price,
       CASE WHEN l.disc > 0 THEN CAST(l.disc AS DOUBLE) END AS total_discount,
       CAST(l.ship AS DOUBLE) AS total_shipping,
       o.o_orderstatus AS financial_status,
       CAST(coalesce(l.n, 0) AS INTEGER) AS line_items_count,
       l.skus AS line_items_skus,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c.c_name IS NOT NULL THEN sha256(lower(c.c_name || '@Shop.Example')) END AS customer_email_hash
FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""
