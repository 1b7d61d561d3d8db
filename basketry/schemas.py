"""Explicit schemas: unified tables, raw provider payloads, run log, manifests.

Raw payloads are read with these schemas (never inferred). Every scalar a
provider may send as number *or* text is declared STRING: the JSON reader
keeps the text of a number for a STRING field, and the safe casts in
``functions.exprs`` turn it into a number afterwards.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRODUCTS = _struct(
    ("source", S), ("source_id", S), ("title", S), ("price_amount", D), ("price_currency", S),
    ("image_url", S), ("category", S), ("url", S), ("collected_at", TS), ("raw_hash", S),
    ("raw_file", S), ("additional", S))

ORDERS = _struct(
    ("source", S), ("order_id", S), ("source_order_number", S), ("created_at", TS), ("closed_at", TS),
    ("currency", S), ("total_price", D), ("subtotal_price", D), ("total_tax", D), ("total_discount", D),
    ("total_shipping", D), ("financial_status", S), ("fulfillment_status", S), ("line_items_count", I),
    ("line_items_skus", S), ("customer_id", S), ("customer_email_hash", S), ("raw_file", S),
    ("raw_hash", S), ("ingested_at", TS), ("additional", S))

# Provider A products (one JSON object per product)
RAW_SHOPIFY_PRODUCT = _struct(
    ("id", S), ("title", S),
    ("variants", T.ArrayType(_struct(
        ("id", S), ("price", S), ("currency", S),
        ("presentment_prices", T.ArrayType(_struct(("price", _struct(("currency_code", S))))))))),
    ("images", T.ArrayType(_struct(("src", S)))),
    ("product_type", S), ("handle", S), ("vendor", S), ("tags", S))

# Provider B search response (items nested under ItemsResult.Items)
RAW_AMAZON_ITEM = _struct(
    ("ASIN", S),
    ("ItemInfo", _struct(("Title", _struct(("DisplayValue", S))))),
    ("Offers", _struct(("Listings", T.ArrayType(_struct(("Price", _struct(("Amount", S), ("Currency", S)))))))),
    ("Images", _struct(("Primary", _struct(("Small", _struct(("URL", S))))))),
    ("BrowseNodeInfo", _struct(("BrowseNodes", T.ArrayType(S)))),
    ("DetailPageURL", S))
RAW_AMAZON_RESPONSE = _struct(("ItemsResult", _struct(("Items", T.ArrayType(RAW_AMAZON_ITEM)))))

# Provider C search item
RAW_EBAY_ITEM = _struct(
    ("itemId", S), ("title", S), ("price", _struct(("value", S), ("currency", S))),
    ("image", _struct(("imageUrl", S))), ("categoryPath", T.ArrayType(S)), ("itemWebUrl", S),
    ("seller", _struct(("username", S))), ("condition", S))

# Provider A orders
RAW_SHOPIFY_ORDER = _struct(
    ("id", S), ("order_number", S), ("name", S), ("created_at", S), ("closed_at", S), ("currency", S),
    ("total_price", S), ("subtotal_price", S), ("total_tax", S),
    ("shipping_lines", T.ArrayType(_struct(("price", S)))),
    ("discount_applications", T.ArrayType(_struct(("value", S)))),
    ("financial_status", S), ("fulfillment_status", S),
    ("line_items", T.ArrayType(_struct(("id", S), ("sku", S), ("quantity", I), ("price", S), ("variant_id", S)))),
    ("customer", _struct(("id", S), ("email", S))),
    ("gateway", S), ("processing_method", S), ("cancelled_at", S), ("tags", S))

RUN_LOG = _struct(
    ("run_id", S), ("started_at", TS), ("finished_at", TS), ("status", S), ("raw_files", I),
    ("new_products", L), ("new_orders", L), ("updated_products", L), ("updated_orders", L),
    ("providers", T.ArrayType(S)), ("rejected_records", L), ("quarantined_records", L))

ASSET_MANIFEST = _struct(
    ("path", S), ("format", S), ("variant", S), ("size_bytes", L), ("width", I), ("height", I), ("sha256", S))
