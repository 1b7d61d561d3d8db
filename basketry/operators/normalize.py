"""Provider normalizers (N1-N5): raw nested payloads -> unified tables.

Each normalizer is one ``select`` over typed structs (no UDF): input rows
carry the parsed payload in column ``payload`` plus ``raw_file`` and
``raw_hash``; the output has exactly the columns of ``schemas.PRODUCTS`` or
``schemas.ORDERS``. New providers register a function under a name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..functions import exprs as X

Normalizer = Callable[[DataFrame, Column], DataFrame]
PRODUCT_NORMALIZERS: dict[str, Normalizer] = {}
ORDER_NORMALIZERS: dict[str, Normalizer] = {}


def product_normalizer(name: str):
    def deco(fn):
        PRODUCT_NORMALIZERS[name] = fn
        return fn
    return deco


def order_normalizer(name: str):
    def deco(fn):
        ORDER_NORMALIZERS[name] = fn
        return fn
    return deco


def batch_stamp(ts: str | None = None) -> Column:
    """The ingest stamp. A fixed literal makes re-runs reproducible."""
    return F.lit(ts).cast("timestamp_ntz") if ts else F.localtimestamp()


POSITION = "_pos"  # optional input column that travels along: place of the record in its run


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                     *[c for c in (POSITION,) if c in df.columns])


def _carried(df: DataFrame) -> list[str]:
    return [c for c in (POSITION, "_stamp") if c in df.columns]


@product_normalizer("shopify")
def normalize_shopify_products(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """N1. First variant gives price and currency; an unparseable price leaves
    both NULL; currency falls back to the first presentment price."""
    p = F.col("payload")
    v0 = F.get(p["variants"], 0)
    price_txt = X.truthy_string(v0["price"])
    price = X.safe_double(price_txt)
    failed = price_txt.isNotNull() & price.isNull()
    currency = F.coalesce(X.truthy_string(v0["currency"]),
                          F.get(v0["presentment_prices"], 0)["price"]["currency_code"])
    category = F.coalesce(X.truthy_string(p["product_type"]), X.first_comma_token(p["tags"]))
    out = raw.select(
        F.lit("shopify").alias("source"),
        p["id"].alias("source_id"),
        p["title"].alias("title"),
        price.alias("price_amount"),
        F.when(~failed, currency).alias("price_currency"),
        F.get(p["images"], 0)["src"].alias("image_url"),
        category.alias("category"),
        F.lit(None).cast("string").alias("url"),
        (stamp if stamp is not None else batch_stamp()).alias("collected_at"),
        "raw_hash", "raw_file",
        X.pack_additional(handle=p["handle"], vendor=p["vendor"]).alias("additional"), *_carried(raw),
    )
    return _conform(out, SC.PRODUCTS)


@product_normalizer("amazon")
def normalize_amazon_items(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """N2. One output row per item of ``ItemsResult.Items``; a response
    without that path yields no rows; no category."""
    # explode_outer + filter: a plain explode lets Spark infer a size() filter
    # that re-evaluates the payload expression
    items = raw.select(F.posexplode_outer(F.col("payload")["ItemsResult"]["Items"]).alias("_item", "it"),
                       "raw_hash", "raw_file", *_carried(raw)).where(F.col("it").isNotNull())
    if POSITION in raw.columns:
        items = items.withColumn(POSITION, F.col(POSITION).withField("item", F.col("_item")))
    it = F.col("it")
    offer = F.get(it["Offers"]["Listings"], 0)["Price"]
    out = items.select(
        F.lit("amazon").alias("source"),
        it["ASIN"].alias("source_id"),
        it["ItemInfo"]["Title"]["DisplayValue"].alias("title"),
        X.safe_double(offer["Amount"]).alias("price_amount"),
        offer["Currency"].alias("price_currency"),
        it["Images"]["Primary"]["Small"]["URL"].alias("image_url"),
        F.lit(None).cast("string").alias("category"),
        it["DetailPageURL"].alias("url"),
        (stamp if stamp is not None else batch_stamp()).alias("collected_at"),
        "raw_hash", "raw_file",
        X.pack_additional(browseNodeInfo=it["BrowseNodeInfo"]).alias("additional"), *_carried(items),
    )
    return _conform(out, SC.PRODUCTS)


@product_normalizer("ebay")
def normalize_ebay_search(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """N3. Category = last element of ``categoryPath`` when it is a non-empty
    list (a scalar path parses to NULL under the array schema)."""
    p = F.col("payload")
    out = raw.select(
        F.lit("ebay").alias("source"),
        p["itemId"].alias("source_id"),
        p["title"].alias("title"),
        X.safe_double(p["price"]["value"]).alias("price_amount"),
        p["price"]["currency"].alias("price_currency"),
        p["image"]["imageUrl"].alias("image_url"),
        F.try_element_at(p["categoryPath"], F.lit(-1)).alias("category"),
        p["itemWebUrl"].alias("url"),
        (stamp if stamp is not None else batch_stamp()).alias("collected_at"),
        "raw_hash", "raw_file",
        X.pack_additional(seller=p["seller"], condition=p["condition"]).alias("additional"), *_carried(raw),
    )
    return _conform(out, SC.PRODUCTS)


@order_normalizer("shopify")
def normalize_shopify_orders(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """N4 with N8-N12: email hashed (raw e-mail never kept), SKU list,
    shipping and discount totals, customer id."""
    o = F.col("payload")
    number = F.coalesce(X.truthy_string(o["order_number"]), X.truthy_string(o["name"]))
    cust = o["customer"]
    out = raw.select(
        F.lit("shopify").alias("source"),
        o["id"].alias("order_id"),
        number.alias("source_order_number"),
        X.safe_ts(o["created_at"]).alias("created_at"),
        X.safe_ts(o["closed_at"]).alias("closed_at"),
        o["currency"].alias("currency"),
        X.safe_double(o["total_price"]).alias("total_price"),
        X.safe_double(o["subtotal_price"]).alias("subtotal_price"),
        X.safe_double(o["total_tax"]).alias("total_tax"),
        X.discount_total(o["discount_applications"]).alias("total_discount"),
        X.shipping_total(o["shipping_lines"]).alias("total_shipping"),
        o["financial_status"].alias("financial_status"),
        o["fulfillment_status"].alias("fulfillment_status"),
        F.coalesce(F.size(o["line_items"]), F.lit(0)).alias("line_items_count"),
        X.sku_list(o["line_items"]).alias("line_items_skus"),
        X.truthy_string(cust["id"]).alias("customer_id"),
        X.email_hash(cust["email"]).alias("customer_email_hash"),
        "raw_file", "raw_hash",
        (stamp if stamp is not None else batch_stamp()).alias("ingested_at"),
        X.pack_additional(gateway=o["gateway"], processing_method=o["processing_method"],
                          cancelled_at=o["cancelled_at"], tags=o["tags"]).alias("additional"), *_carried(raw),
    )
    return _conform(out.withColumn("line_items_count",
                                   F.when(F.col("line_items_count") < 0, 0).otherwise(F.col("line_items_count"))),
                    SC.ORDERS)


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """One batch per entity across providers."""
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr, allowMissingColumns=True)
    return out
