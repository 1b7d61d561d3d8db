"""Normalizers on literal provider payloads with the edge rows of FIXTURES.md."""

import hashlib
import json

from pyspark.sql import functions as F

from basketry import schemas as SC
from basketry.operators import normalize as N

STAMP_TEXT = "2024-05-01 00:00:00"


def _raw(spark, docs, schema):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    return df.select(F.from_json("json", schema).alias("payload"), F.lit("f.json").alias("raw_file"),
                     F.lit("h").alias("raw_hash"))


def test_shopify_products_edges(spark):
    docs = [
        {"id": 1, "title": "no variants", "product_type": "Shoes"},
        {"id": 2, "title": "empty price", "variants": [{"price": "", "currency": "EUR"}], "tags": ",a"},
        {"id": 3, "title": "bad price", "variants": [{"price": "abc", "currency": "EUR"}], "product_type": "X"},
        {"id": 4, "title": "zero", "variants": [{"price": "0", "currency": "USD"}]},
        {"id": 5, "title": "presentment", "variants": [{"price": 9.5, "presentment_prices": [{"price": {"currency_code": "BRL"}}]}],
         "images": [], "product_type": "", "tags": " Hats , Caps"},
        {"title": "no id", "images": [{"src": "http://i/1.png"}, {"src": "http://i/2.png"}], "handle": "h", "vendor": "v"},
    ]
    rows = {r["title"]: r for r in N.normalize_shopify_products(_raw(spark, docs, SC.RAW_SHOPIFY_PRODUCT), N.batch_stamp(STAMP_TEXT)).collect()}
    assert rows["no variants"]["price_amount"] is None and rows["no variants"]["category"] == "Shoes"
    assert rows["empty price"]["price_amount"] is None and rows["empty price"]["price_currency"] == "EUR"
    assert rows["empty price"]["category"] == ""
    assert rows["bad price"]["price_amount"] is None and rows["bad price"]["price_currency"] is None
    assert rows["zero"]["price_amount"] == 0.0 and rows["zero"]["price_currency"] == "USD"
    assert rows["presentment"]["price_amount"] == 9.5 and rows["presentment"]["price_currency"] == "BRL"
    assert rows["presentment"]["image_url"] is None and rows["presentment"]["category"] == "Hats"
    assert rows["no id"]["source_id"] is None and rows["no id"]["image_url"] == "http://i/1.png"
    assert rows["no id"]["additional"] == '{"handle":"h","vendor":"v"}'
    assert all(r["source"] == "shopify" and r["url"] is None for r in rows.values())


def test_amazon_items_edges(spark):
    docs = [
        {"ItemsResult": {"Items": [
            {"ASIN": "A1", "ItemInfo": {"Title": {"DisplayValue": "T1"}},
             "Offers": {"Listings": [{"Price": {"Amount": 12.5, "Currency": "USD"}}, {"Price": {"Amount": 1}}]},
             "Images": {"Primary": {"Small": {"URL": "u1"}}}, "DetailPageURL": "d1",
             "BrowseNodeInfo": {"BrowseNodes": ["n1"]}},
            {"ASIN": "A2", "Offers": {"Listings": []}}]}},
        {"Errors": [{"Code": "x"}]},
    ]
    rows = {r["source_id"]: r for r in N.normalize_amazon_items(_raw(spark, docs, SC.RAW_AMAZON_RESPONSE), N.batch_stamp(STAMP_TEXT)).collect()}
    assert set(rows) == {"A1", "A2"}
    assert rows["A1"]["price_amount"] == 12.5 and rows["A1"]["url"] == "d1" and rows["A1"]["image_url"] == "u1"
    assert rows["A2"]["price_amount"] is None and rows["A2"]["title"] is None and rows["A2"]["category"] is None


def test_ebay_items_category_path(spark):
    docs = [{"itemId": "e1", "categoryPath": ["A", "B"], "price": {"value": "3.25", "currency": "USD"}},
            {"itemId": "e2", "categoryPath": "Misc"},
            {"itemId": "e3", "categoryPath": []},
            {"itemId": "e4", "price": {"value": 7}}]
    rows = {r["source_id"]: r for r in N.normalize_ebay_search(_raw(spark, docs, SC.RAW_EBAY_ITEM), N.batch_stamp(STAMP_TEXT)).collect()}
    assert rows["e1"]["category"] == "B" and rows["e1"]["price_amount"] == 3.25
    assert rows["e2"]["category"] is None and rows["e3"]["category"] is None
    assert rows["e4"]["price_amount"] == 7.0


def test_shopify_orders_edges(spark):
    docs = [
        {"id": 10, "name": "#10", "created_at": "2024-01-02T03:04:05Z", "total_price": "12.50",
         "shipping_lines": [], "discount_applications": [{"value": "0"}],
         "line_items": [{"sku": "B"}, {"sku": "A"}, {"sku": "B"}, {"sku": None, "variant_id": 77}, {}],
         "customer": {"id": 5, "email": " \tMe@Example.COM  "}},
        {"id": 11, "order_number": 1011, "shipping_lines": [{"price": "x"}, {"price": "2.5"}],
         "discount_applications": [{"value": "10"}, {"value": "oops"}, {"value": 2.5}],
         "customer": {"id": None, "email": ""}, "line_items": []},
        {"id": 12, "order_number": 0, "name": "", "customer": None, "total_price": "abc"},
    ]
    rows = {r["order_id"]: r for r in N.normalize_shopify_orders(_raw(spark, docs, SC.RAW_SHOPIFY_ORDER), N.batch_stamp(STAMP_TEXT)).collect()}
    a, b, c = rows["10"], rows["11"], rows["12"]
    assert a["source_order_number"] == "#10" and b["source_order_number"] == "1011"
    assert c["source_order_number"] == "0"  # the text "0" is truthy
    assert a["line_items_skus"] == "77,A,B" and a["line_items_count"] == 5
    assert a["total_shipping"] is None and b["total_shipping"] == 2.5
    assert a["total_discount"] is None and b["total_discount"] == 12.5 and c["total_discount"] is None
    assert a["customer_email_hash"] == hashlib.sha256(b"me@example.com").hexdigest()
    assert b["customer_email_hash"] is None and b["customer_id"] is None and a["customer_id"] == "5"
    assert c["total_price"] is None and a["total_price"] == 12.5
    assert b["line_items_count"] == 0 and c["line_items_count"] == 0 and b["line_items_skus"] is None
    assert str(a["created_at"]) == "2024-01-02 03:04:05"
    assert json.loads(a["additional"]) == {"cancelled_at": None, "gateway": None, "processing_method": None, "tags": None}
