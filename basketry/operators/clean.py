"""Declarative cleaning of raw retail extracts.

One generic ``clean`` applies a ``CleanRule``: map pandas-style missing
tokens to NULL (C2 prerequisite), drop exact duplicate rows (C1), drop rows
missing a required column (C2), coerce dates and numbers leniently (C3, C4,
after C2, so an unparseable value survives as NULL), keep positive values
(C5), fill categorical gaps with 'Unknown' (C6). Optional columns are only
touched when present (C7). ``RULES`` is the per-dataset table (C8, C10-C21).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

# Fixed date layouts tried after ISO-8601 (US month/day exports).
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class CleanRule:
    dataset: str
    required: tuple[str, ...]
    dates: tuple[str, ...] = ()
    optional_dates: tuple[str, ...] = ()
    numerics: tuple[str, ...] = ()
    optional_numerics: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    fill_unknown: tuple[str, ...] = ()
    file_name: str = field(default="", compare=False)
    multiline: bool = False     # free-text fields may hold line breaks


# Fixed rule table (dataset names, required/typed columns) of the twelve jobs.
RULES: dict[str, CleanRule] = {r.dataset: r for r in [
    CleanRule("E-commerce Dataset", ("Customer_Id", "Order_Date"), dates=("Order_Date",),
              optional_numerics=("Sales", "Quantity", "Discount", "Profit", "Shipping_Cost"),
              positive=("Sales", "Quantity"), fill_unknown=("Gender", "Device_Type", "Product_Category"),
              file_name="E-commerce Dataset.csv"),
    CleanRule("online_retail", ("CustomerID", "InvoiceDate"), dates=("InvoiceDate",),
              numerics=("Quantity", "UnitPrice"), positive=("Quantity",), file_name="online_retail.csv"),
    CleanRule("Sale Report", ("Order_ID", "Order_Date"), dates=("Order_Date",), numerics=("Sales", "Profit"),
              file_name="Sale Report.csv"),
    CleanRule("orders", ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
              dates=("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                     "order_delivered_customer_date", "order_estimated_delivery_date"),
              file_name="olist_orders_dataset.csv"),
    CleanRule("order_items", ("order_id", "order_item_id", "product_id", "seller_id", "price"),
              dates=("shipping_limit_date",), numerics=("price", "freight_value"),
              file_name="olist_order_items_dataset.csv"),
    CleanRule("customers", ("customer_id", "customer_unique_id"), file_name="olist_customers_dataset.csv"),
    CleanRule("payments", ("order_id", "payment_type", "payment_value"), numerics=("payment_value",),
              file_name="olist_order_payments_dataset.csv"),
    CleanRule("reviews", ("order_id", "review_id", "review_score"), numerics=("review_score",),
              optional_dates=("review_creation_date", "review_answer_timestamp"),
              file_name="olist_order_reviews_dataset.csv", multiline=True),
    CleanRule("products", ("product_id", "product_category_name"), file_name="olist_products_dataset.csv"),
    CleanRule("sellers", ("seller_id",), file_name="olist_sellers_dataset.csv"),
    CleanRule("geolocation", ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
              numerics=("geolocation_lat", "geolocation_lng"), file_name="olist_geolocation_dataset.csv"),
    CleanRule("category_translation", ("product_category_name", "product_category_name_english"),
              file_name="product_category_name_translation.csv"),
]}


def _require(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def with_na_tokens(df: DataFrame) -> DataFrame:
    """String columns: pandas missing-value tokens -> NULL."""
    return df.select(*[X.na_to_null(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string"
                       else F.col(f.name) for f in df.schema.fields])


def clean(df: DataFrame, rule: CleanRule) -> DataFrame:
    """Apply ``rule``. Rows are compared with the types that ``df`` has: as text where it holds text, by value where it was typed
    (``files.cast_types``), so that 2.5 and 2.50 of a number column are one row."""
    _require(df, rule.required + rule.dates + rule.numerics + rule.positive)
    # rows without a required value go first: the same rows remain, and fewer are shuffled to find repeats
    df = with_na_tokens(df).na.drop(how="any", subset=list(rule.required)).dropDuplicates()
    dates = list(rule.dates) + [c for c in rule.optional_dates if c in df.columns]
    nums = list(rule.numerics) + [c for c in rule.optional_numerics if c in df.columns]
    conv = {c: X.safe_ts(c, *DATE_FORMATS).cast("timestamp_ntz") for c in dates}
    conv.update({c: X.safe_double(c) for c in nums})
    fills = {c for c in rule.fill_unknown if c in df.columns}
    df = df.select(*[conv[c].alias(c) if c in conv else
                     (F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) if c in fills else F.col(c))
                     for c in df.columns])
    for c in rule.positive:
        df = df.where(F.col(c) > 0)
    return df


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header CSV, every column as text (no inference pass over the data)."""
    from ..sources.files import read_csv_text
    return read_csv_text(spark, path, multiline)


def run_cleaning(spark: SparkSession, in_dir: str, out_dir: str, rules: dict[str, CleanRule] | None = None,
                 fmt: str = "csv") -> DataFrame:
    """Clean every dataset found in ``in_dir``, its columns typed by what all rows hold; a failing dataset does not stop
    the others. Returns one status row per dataset (C8, S5, S6)."""
    from ..sources.files import cast_types, infer_types
    rules = rules or RULES
    status = []
    for rule in rules.values():
        src = f"{in_dir.rstrip('/')}/{rule.file_name}"
        dst = f"{out_dir.rstrip('/')}/{rule.file_name.replace('.csv', '_clean')}"
        try:
            raw = read_raw_csv(spark, src, rule.multiline)
            out = clean(cast_types(raw, infer_types(raw)), rule)
            if fmt == "csv":
                from ..sources.files import write_csv
                write_csv(out, dst)
            else:
                out.write.mode("overwrite").parquet(dst)
            status.append((rule.dataset, "ok", dst, None))
        except Exception as e:  # noqa: BLE001 - per-dataset isolation, reported in the status table
            status.append((rule.dataset, "error", dst, str(e)))
    return spark.createDataFrame(status, "dataset string, status string, output string, error string")


# --- SQL twin for the oracle --------------------------------------------------

NA_SQL_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in X.PANDAS_NA_TOKENS)


def clean_sql(view_sql: str, columns: list[str], rule: CleanRule) -> str:
    """DuckDB SQL applying the same rule to a view whose columns are all text."""
    q = lambda c: '"' + c + '"'
    na = ", ".join(f"CASE WHEN {q(c)} IN ({NA_SQL_LIST}) THEN NULL ELSE {q(c)} END AS {q(c)}" for c in columns)
    req = " AND ".join(f"{q(c)} IS NOT NULL" for c in rule.required)
    dates = set(rule.dates) | {c for c in rule.optional_dates if c in columns}
    nums = set(rule.numerics) | {c for c in rule.optional_numerics if c in columns}
    fills = {c for c in rule.fill_unknown if c in columns}
    sel = []
    for c in columns:
        if c in dates:
            sel.append(f"coalesce(TRY_CAST({q(c)} AS TIMESTAMP), try_strptime({q(c)}, '%m/%d/%Y %H:%M'), "
                       f"try_strptime({q(c)}, '%m/%d/%Y %H:%M:%S'), try_strptime({q(c)}, '%m/%d/%Y')) AS {q(c)}")
        elif c in nums:
            sel.append(f"CASE WHEN regexp_full_match({q(c)}, '{X.NUMERIC_PATTERN}') THEN "
                       f"TRY_CAST(trim({q(c)}) AS DOUBLE) END AS {q(c)}")
        elif c in fills:
            sel.append(f"coalesce({q(c)}, '{UNKNOWN}') AS {q(c)}")
        else:
            sel.append(q(c))
    pos = " AND ".join(f"{q(c)} > 0" for c in rule.positive) or "TRUE"
    return (f"WITH raw AS ({view_sql}), na AS (SELECT {na} FROM raw), d AS (SELECT DISTINCT * FROM na), "
            f"f AS (SELECT * FROM d WHERE {req}), t AS (SELECT {', '.join(sel)} FROM f) "
            f"SELECT * FROM t WHERE {pos}")
