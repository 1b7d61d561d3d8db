"""Logical pipeline tables derived from the supplied benchmark tables.

The pipeline's own tables (products, orders, run log, merge batches, raw
provider JSON, dirty CSV-like extracts) are views over the supplied parquet
tables, so every registered query reads real data whose size grows with the
scale factor. Each Spark view has an SQL twin used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_SCANS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a supplied table. The DataFrame (a plan, not data) is reused per
    session, so the file listing and footer read happen once per table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark._jsparkSession), path)
    df = _SCANS.get(key)
    if df is None:
        df = _SCANS[key] = spark.read.parquet(path)
    return df


# --- products: part -> normalized product rows ------------------------------

def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_brand").alias("source"),
        F.col("p_partkey").cast("string").alias("source_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price_amount"),
        F.lit("USD").alias("price_currency"),
        F.col("p_type").alias("category"),
    )


PRODUCTS_SQL = ("SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS source_id, p_name AS title, "
                "p_retailprice AS price_amount, 'USD' AS price_currency, p_type AS category FROM part")


# --- orders: orders -> normalized order rows --------------------------------

def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("financial_status"),
        F.col("o_custkey").cast("string").alias("customer_id"),
    )


ORDERS_SQL = ("SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS created_at, "
              "o_totalprice AS total_price, o_orderstatus AS financial_status, "
              "CAST(o_custkey AS VARCHAR) AS customer_id FROM orders")


# --- timestamped orders: events -> orders with a time of day ---------------

def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases from the event stream: real times of day, for recency and rolling features."""
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == "purchase").select(
        F.lit("events").alias("source"),
        F.col("event_id").cast("string").alias("order_id"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("total_price"),
    )


EVENT_ORDERS_SQL = ("SELECT 'events' AS source, CAST(event_id AS VARCHAR) AS order_id, ts AS created_at, "
                    "value AS total_price FROM events WHERE event_type = 'purchase'")


# --- run log: one pipeline run per event day -------------------------------
# Fixed mapping of event types to run-log counters.
RUNLOG_METRICS = {
    "new_products": "view",
    "updated_products": "click",
    "new_orders": "purchase",
    "updated_orders": "signup",
}


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    aggs = [F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
            F.countDistinct("user_id").cast("int").alias("raw_files")]
    aggs += [F.count(F.when(F.col("event_type") == et, True)).alias(m) for m, et in RUNLOG_METRICS.items()]
    runs = e.groupBy(day.alias("run_day")).agg(*aggs)
    return runs.select(
        F.date_format("run_day", "yyyyMMdd").alias("run_id"), "started_at", "finished_at",
        F.lit("success").alias("status"), "raw_files", *RUNLOG_METRICS)


RUN_LOG_SQL = ("SELECT strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, min(ts) AS started_at, max(ts) AS finished_at, "
               "'success' AS status, CAST(count(DISTINCT user_id) AS INTEGER) AS raw_files, "
               + ", ".join(f"count(*) FILTER (WHERE event_type = '{et}') AS {m}" for m, et in RUNLOG_METRICS.items())
               + " FROM events GROUP BY CAST(ts AS DATE)")


# --- merge batches: incremental loads by order date -------------------------
# Fixed scenario: the table holds orders up to the end of 1999 (load 1);
# load 2 re-delivers everything from 1999 on, with re-priced open orders;
# load 3, later the same day, re-prices again everything from mid-2000 on, so
# keys repeat inside the batch and the latest ingest must win.
LOAD1_END = "2000-01-01"
LOAD2_START = "1999-01-01"
LOAD3_START = "2000-06-01"
INGEST = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-02-01 06:00:00")


def _order_version(o: DataFrame, price_dec, ingested_at: str) -> DataFrame:
    """One delivery of the order feed; ``price_dec`` is a DECIMAL(18,2) column."""
    return o.select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        price_dec.cast("double").alias("total_price"),
        F.col("o_orderstatus").alias("financial_status"),
        F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), price_dec.cast("string")), 256).alias("raw_hash"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
    )


def _cents(c):
    return c.cast("decimal(18,2)")


def _reprice(c, factor: str):
    return F.round(_cents(c) * F.lit(factor).cast("decimal(3,2)"), 2).cast("decimal(18,2)")


def merge_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return _order_version(o.where(F.col("o_orderdate") < F.lit(LOAD1_END).cast("timestamp_ntz")),
                          _cents(F.col("o_totalprice")), INGEST[0])


def merge_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    v2 = o.where(F.col("o_orderdate") >= F.lit(LOAD2_START).cast("timestamp_ntz"))
    p2 = F.when(F.col("o_orderstatus") == "O", _reprice(F.col("o_totalprice"), "1.05")) \
        .otherwise(_cents(F.col("o_totalprice")))
    v3 = o.where(F.col("o_orderdate") >= F.lit(LOAD3_START).cast("timestamp_ntz"))
    return _order_version(v2, p2, INGEST[1]).unionByName(
        _order_version(v3, _reprice(F.col("o_totalprice"), "1.10"), INGEST[2]))


def _order_version_sql(where: str, price_dec: str, ingested_at: str) -> str:
    return (f"SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS created_at, "
            f"CAST({price_dec} AS DOUBLE) AS total_price, o_orderstatus AS financial_status, "
            f"sha256(CAST(o_orderkey AS VARCHAR) || '|' || CAST({price_dec} AS VARCHAR)) AS raw_hash, "
            f"TIMESTAMP '{ingested_at}' AS ingested_at FROM orders WHERE {where}")


_CENTS_SQL = "CAST(o_totalprice AS DECIMAL(18,2))"


def _reprice_sql(factor: str) -> str:
    return f"CAST(round({_CENTS_SQL} * CAST({factor} AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"


MERGE_EXISTING_SQL = _order_version_sql(f"o_orderdate < TIMESTAMP '{LOAD1_END}'", _CENTS_SQL, INGEST[0])
MERGE_BATCH_SQL = (
    _order_version_sql(f"o_orderdate >= TIMESTAMP '{LOAD2_START}'",
                       f"CASE WHEN o_orderstatus = 'O' THEN {_reprice_sql('1.05')} ELSE {_CENTS_SQL} END", INGEST[1])
    + " UNION ALL "
    + _order_version_sql(f"o_orderdate >= TIMESTAMP '{LOAD3_START}'", _reprice_sql("1.10"), INGEST[2]))


# --- product merge batches: catalogue deliveries by part size band ----------
# Fixed scenario: the catalogue holds parts of size <= 30 (load 1); load 2
# re-delivers sizes >= 20 with re-priced ECONOMY parts; load 3, later, re-prices
# sizes >= 40 again.
PRODUCT_LOAD1_MAX_SIZE = 30
PRODUCT_LOAD2_MIN_SIZE = 20
PRODUCT_LOAD3_MIN_SIZE = 40
COLLECT = ("2024-01-01 00:00:00", "2024-03-01 00:00:00", "2024-03-01 12:00:00")


def _product_version(p: DataFrame, price_dec, collected_at: str) -> DataFrame:
    return p.select(
        F.col("p_brand").alias("source"),
        F.col("p_partkey").cast("string").alias("source_id"),
        F.col("p_name").alias("title"),
        price_dec.cast("double").alias("price_amount"),
        F.col("p_type").alias("category"),
        F.lit(collected_at).cast("timestamp_ntz").alias("collected_at"),
        F.sha2(F.concat_ws("|", F.col("p_partkey").cast("string"), price_dec.cast("string")), 256).alias("raw_hash"),
    )


def product_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _product_version(p.where(F.col("p_size") <= PRODUCT_LOAD1_MAX_SIZE),
                            _cents(F.col("p_retailprice")), COLLECT[0])


def product_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    v2 = p.where(F.col("p_size") >= PRODUCT_LOAD2_MIN_SIZE)
    p2 = F.when(F.col("p_type") == "ECONOMY", _reprice(F.col("p_retailprice"), "1.05")) \
        .otherwise(_cents(F.col("p_retailprice")))
    v3 = p.where(F.col("p_size") >= PRODUCT_LOAD3_MIN_SIZE)
    return _product_version(v2, p2, COLLECT[1]).unionByName(
        _product_version(v3, _reprice(F.col("p_retailprice"), "1.10"), COLLECT[2]))


def _product_version_sql(where: str, price_dec: str, collected_at: str) -> str:
    return (f"SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS source_id, p_name AS title, "
            f"CAST({price_dec} AS DOUBLE) AS price_amount, p_type AS category, "
            f"TIMESTAMP '{collected_at}' AS collected_at, "
            f"sha256(CAST(p_partkey AS VARCHAR) || '|' || CAST({price_dec} AS VARCHAR)) AS raw_hash "
            f"FROM part WHERE {where}")


_PCENTS_SQL = "CAST(p_retailprice AS DECIMAL(18,2))"


def _preprice_sql(factor: str) -> str:
    return f"CAST(round({_PCENTS_SQL} * CAST({factor} AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"


PRODUCT_EXISTING_SQL = _product_version_sql(f"p_size <= {PRODUCT_LOAD1_MAX_SIZE}", _PCENTS_SQL, COLLECT[0])
PRODUCT_BATCH_SQL = (
    _product_version_sql(f"p_size >= {PRODUCT_LOAD2_MIN_SIZE}",
                         f"CASE WHEN p_type = 'ECONOMY' THEN {_preprice_sql('1.05')} ELSE {_PCENTS_SQL} END",
                         COLLECT[1])
    + " UNION ALL "
    + _product_version_sql(f"p_size >= {PRODUCT_LOAD3_MIN_SIZE}", _preprice_sql("1.10"), COLLECT[2]))
