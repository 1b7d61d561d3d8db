"""Queries over tables that are kept up to date batch by batch: histories, quarantine, daily states."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean as C
from ..operators import merge as M
from ..operators import runlog as RL
from ..operators.quality import Rule
from ..session import ensure_checkpoint_dir
from ..sources import daily as DT
from ..sources import dated as DD
from ..sources import files as FS
from ..sources import history as HT
from ..sources import quarantine as QT
from ..sources import snapshots as SS
from ..sources import tables as TB
from ..sources import watermark as WM
from . import dirty_views as DV
from . import views as V
from .catalog import register


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _loads(spark: SparkSession, d: str) -> list[DataFrame]:
    """The three deliveries of the order feed."""
    later = V.merge_batch(spark, d)
    return [V.merge_existing(spark, d), *(later.where(F.col("ingested_at") == F.lit(t).cast("timestamp_ntz")) for t in V.INGEST[1:])]


@register("scd_orders", "§2.11 history", f"""
WITH v AS ({V.MERGE_EXISTING_SQL} UNION ALL {V.MERGE_BATCH_SQL}),
told AS (
  SELECT source, order_id, total_price, financial_status, ingested_at,
         lag(total_price) OVER w AS before_price, lag(financial_status) OVER w AS before_status, row_number() OVER w AS nth
  FROM v WINDOW w AS (PARTITION BY source, order_id ORDER BY ingested_at)),
changed AS (
  SELECT * FROM told WHERE nth = 1 OR total_price IS DISTINCT FROM before_price OR financial_status IS DISTINCT FROM before_status)
SELECT source, order_id, total_price, financial_status, ingested_at AS valid_from,
       lead(ingested_at) OVER (PARTITION BY source, order_id ORDER BY ingested_at) AS valid_to
FROM changed""")
def q_scd_orders(spark: SparkSession, d: str) -> DataFrame:
    """The history of every order: the third delivery comes before the second, and the first and second come twice."""
    root, keys = _folder(spark, "scd"), M.ORDER_KEYS
    first, second, third = _loads(spark, d)
    for batch in (first, third, second, first, second):
        HT.append(spark, root, "orders", batch, keys, "ingested_at", ["total_price", "financial_status"], ["raw_hash"])
    return HT.read(spark, root, "orders", keys)


ORDER_ROWS = T.StructType().add("source", "string").add("order_id", "string").add("created_at", "timestamp_ntz").add("total_price", "double").add(
    "financial_status", "string").add("raw_hash", "string").add("ingested_at", "timestamp_ntz")
# Fixed rules of the checked order feed.
FEED_RULES = [Rule("status_enum", "financial_status", "enum", ("F", "O")), Rule("total_minimum", "total_price", "minimum", 2000.0)]


@register("orders_quarantine", "§2.11 quarantine", f"""
WITH v AS ({V.MERGE_EXISTING_SQL} UNION ALL {V.MERGE_BATCH_SQL}),
checked AS (
  SELECT *, concat_ws(',', CASE WHEN financial_status NOT IN ('F', 'O') THEN 'status_enum' END, CASE WHEN total_price < 2000 THEN 'total_minimum' END) AS violations
  FROM v),
good AS (
  SELECT * FROM checked WHERE violations = '' QUALIFY row_number() OVER (PARTITION BY source, order_id ORDER BY ingested_at DESC) = 1),
bad AS (
  SELECT source, order_id, total_price, financial_status, violations, max(ingested_at) AS ingested_at FROM checked WHERE violations <> '' GROUP BY ALL),
mended AS (
  SELECT source, order_id, total_price AS old_price, violations, ingested_at,
         CASE WHEN total_price < 2000 AND financial_status = 'F' THEN 2000.0 ELSE total_price END AS total_price,
         CASE WHEN financial_status = 'P' THEN 'O' ELSE financial_status END AS financial_status
  FROM bad),
replayed AS (
  SELECT m.* FROM mended m LEFT JOIN good g ON m.source = g.source AND m.order_id = g.order_id
  WHERE m.total_price >= 2000 AND (g.ingested_at IS NULL OR g.ingested_at <= m.ingested_at)
  QUALIFY row_number() OVER (PARTITION BY m.source, m.order_id ORDER BY m.ingested_at DESC) = 1)
SELECT 'replayed' AS place, source, order_id, total_price, financial_status, ingested_at, '' AS violations FROM replayed
UNION ALL
SELECT 'table', source, order_id, total_price, financial_status, ingested_at, '' FROM good
WHERE NOT EXISTS (SELECT 1 FROM replayed r WHERE r.source = good.source AND r.order_id = good.order_id)
UNION ALL
SELECT 'quarantine', b.source, b.order_id, b.total_price, b.financial_status, b.ingested_at, b.violations
FROM bad b JOIN mended m ON b.source = m.source AND b.order_id = m.order_id AND b.ingested_at = m.ingested_at AND b.total_price = m.old_price
WHERE m.total_price < 2000""")
def q_orders_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Three checked deliveries, then a replay: pending orders become open ones, cheap final ones cost the minimum; other cheap ones stay in quarantine."""
    root, keys = _folder(spark, "quarantine"), M.ORDER_KEYS
    for n, batch in enumerate(_loads(spark, d)):
        QT.merge_checked(spark, root, "orders", ORDER_ROWS, batch, "pair", keys, "ingested_at", FEED_RULES, f"load-{n}", most=0.5)
    before = max(TB.batches(spark, root, "orders"))
    status, price = F.col("financial_status"), F.col("total_price")
    mended = QT.quarantined(spark, root, "orders", ORDER_ROWS).withColumns({
        "total_price": F.when((price < 2000) & (status == "F"), 2000.0).otherwise(price), "financial_status": F.when(status == "P", "O").otherwise(status)})
    QT.replay(spark, root, "orders", ORDER_ROWS, mended, "pair", keys, "ingested_at", FEED_RULES)
    cols = ["source", "order_id", "total_price", "financial_status", "ingested_at"]
    now = M.latest_per_key(TB._stored(spark, root, "orders", ORDER_ROWS).drop("mode"), keys, ["batch"])
    kept = now.select(
        F.when(F.col("batch") > before, "replayed").otherwise("table").alias("place"), *cols, F.lit("").alias("violations"))
    return kept.unionByName(QT.quarantined(spark, root, "orders", ORDER_ROWS).select(
        F.lit("quarantine").alias("place"), *cols, F.concat_ws(",", "violations").alias("violations")))


@register("daily_aggregates_incremental", "§2.11 daily tables", f"""
WITH v AS ({V.MERGE_EXISTING_SQL} UNION ALL {V.MERGE_BATCH_SQL}),
o AS (
  SELECT source, CAST(created_at AS DATE) AS day, total_price, CAST(floor(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,6)) * 100) AS BIGINT) AS units
  FROM v QUALIFY row_number() OVER (PARTITION BY source, order_id ORDER BY ingested_at DESC) = 1),
b AS (
  SELECT *, CAST(10 ** greatest(len(CAST(units AS VARCHAR)) - 3, 0) AS BIGINT) AS width FROM o),
ranked AS (
  SELECT day, source, CASE WHEN width > 1 THEN (units - units % width + width / 2.0) / 100 ELSE units / 100.0 END AS mid,
         row_number() OVER (PARTITION BY day, source ORDER BY units - units % width) AS r, count(*) OVER (PARTITION BY day, source) AS n
  FROM b)
SELECT s.*, gmv / n_orders AS aov, q.p50, q.p90
FROM (SELECT day, source, count(*) AS n_orders, CAST(sum(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,6))) AS DOUBLE) AS gmv FROM o GROUP BY day, source) s
JOIN (SELECT day, source, max(CAST(mid AS DOUBLE)) FILTER (WHERE r = ceil(n * 0.5)) AS p50, max(CAST(mid AS DOUBLE)) FILTER (WHERE r = ceil(n * 0.9)) AS p90
      FROM ranked GROUP BY day, source) q USING (day, source)""")
def q_daily_aggregates_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Daily states of the order table after three deliveries, brought up to date after each."""
    root, keys = _folder(spark, "daily"), M.ORDER_KEYS
    for batch in _loads(spark, d):
        TB.merge_into(spark, root, "orders", ORDER_ROWS, batch, "pair", keys, "ingested_at")
        DT.update(spark, root, "orders", "orders_daily", ORDER_ROWS, keys, "created_at", "total_price")
    return DT.read(spark, root, "orders_daily", ORDER_ROWS)


@register("volume_alerts_events", "§2.11 volume alert", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS volume FROM events WHERE ts IS NOT NULL GROUP BY ALL),
pairs AS (
  SELECT event_type, CAST(day + CAST(k AS INTEGER) AS DATE) AS day, volume FROM d, range(1, 8) r(k) WHERE CAST(day + CAST(k AS INTEGER) AS DATE) <= (SELECT max(day) FROM d)),
m AS (SELECT event_type, day, quantile_cont(volume, 0.5)::DOUBLE AS median, count(*) AS n_before FROM pairs GROUP BY ALL),
j AS (
  SELECT event_type, day, volume, median, coalesce(n_before, 0) AS n_before FROM d FULL JOIN m USING (event_type, day))
SELECT *, CASE WHEN volume IS NULL THEN 'missing' WHEN n_before < 3 THEN 'new' WHEN volume > 1.25 * median THEN 'spike'
               WHEN volume < 0.75 * median THEN 'drop' ELSE 'ok' END AS status
FROM j""")
def q_volume_alerts_events(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each event type and day against the median of the seven days before."""
    e = V.table(spark, d, "events")
    daily = e.where(F.col("ts").isNotNull()).groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("volume"))
    return RL.volume_alerts(daily, ["event_type"], high=1.25, low=0.75)


def _sale_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every sale twice, the second time as another program writes it: a trailing zero, a plus sign, spaces."""
    s = DV.sale_report(spark, d)
    again = s.select(F.concat(F.lit("+"), "Order_ID").alias("Order_ID"), "Order_Date", F.concat(F.lit(" "), "Sales", F.lit("0")).alias("Sales"), "Profit")
    return s.unionByName(again)


@register("clean_typed_sales", "S3 C1", f"""
WITH s AS ({DV.SALE_REPORT_SQL}),
two AS (SELECT * FROM s UNION ALL SELECT '+' || "Order_ID", "Order_Date", ' ' || "Sales" || '0', "Profit" FROM s),
typed AS (
  SELECT DISTINCT CAST("Order_ID" AS BIGINT) AS "Order_ID", nullif("Order_Date", '') AS "Order_Date", CAST(trim("Sales") AS DOUBLE) AS "Sales", "Profit" FROM two)
SELECT "Order_ID", CAST("Order_Date" AS TIMESTAMP) AS "Order_Date", "Sales", TRY_CAST("Profit" AS DOUBLE) AS "Profit"
FROM typed WHERE "Order_Date" IS NOT NULL""")
def q_clean_typed_sales(spark: SparkSession, d: str) -> DataFrame:
    """Types from all rows, then cleaning: 2.5 and 2.50 are one sale; the profit column holds words and stays text until it is coerced."""
    raw = _sale_lines(spark, d)
    return C.clean(FS.cast_types(raw, FS.infer_types(raw)), C.RULES["Sale Report"])


_NUMBER_SQL = r"regexp_full_match({c}, '[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*')"


def _type_sql(c: str) -> str:
    return (f"CASE WHEN count({c}) = 0 THEN 'double' WHEN bool_and(regexp_full_match({c}, '[ \\t]*[+-]?[0-9]{{{{1,18}}}}[ \\t]*')) THEN 'bigint' "
            f"WHEN bool_and({_NUMBER_SQL.format(c=c)}) THEN 'double' ELSE 'string' END").replace("{{", "{").replace("}}", "}")


@register("schema_snapshot_extracts", "Q1 S3", f"""
WITH s AS ({DV.SALE_REPORT_SQL}),
a AS (SELECT nullif("Order_ID", '') AS id, nullif("Order_Date", '') AS day, nullif("Sales", '') AS sales, nullif("Profit", '') AS profit FROM s),
old AS (
  SELECT * FROM (SELECT 0 AS position, 'Order_ID' AS "column", {_type_sql('id')} AS dtype FROM a UNION ALL SELECT 1, 'Order_Date', {_type_sql('day')} FROM a
                 UNION ALL SELECT 2, 'Sales', {_type_sql('sales')} FROM a UNION ALL SELECT 3, 'Profit', {_type_sql('profit')} FROM a)),
b AS (SELECT id, sales, profit, id || 'x' AS line FROM a WHERE profit <> 'unknown'),
new AS (
  SELECT * FROM (SELECT 0 AS position, 'Order_ID' AS "column", {_type_sql('id')} AS dtype FROM b UNION ALL SELECT 1, 'Sales', {_type_sql('sales')} FROM b
                 UNION ALL SELECT 2, 'Profit', {_type_sql('profit')} FROM b UNION ALL SELECT 3, 'Line', {_type_sql('line')} FROM b))
SELECT 'first' AS run_id, "column", 'added' AS change, NULL AS old_dtype, dtype AS new_dtype FROM old
UNION ALL
SELECT 'second', "column", CASE WHEN o.dtype IS NULL THEN 'added' WHEN n.dtype IS NULL THEN 'removed' WHEN o.dtype <> n.dtype THEN 'retyped' ELSE 'moved' END,
       o.dtype, n.dtype
FROM old o FULL JOIN new n USING ("column") WHERE o.dtype IS DISTINCT FROM n.dtype OR o.position <> n.position""")
def q_schema_snapshot_extracts(spark: SparkSession, d: str) -> DataFrame:
    """Two extracts of the sales, typed by their rows: the history of schema changes that the kept snapshots give."""
    root, first = _folder(spark, "schemas"), DV.sale_report(spark, d)
    second = first.where("Profit <> 'unknown'").select("Order_ID", "Sales", "Profit", F.concat("Order_ID", F.lit("x")).alias("Line"))
    for run, extract in (("first", first), ("second", second), ("third", second)):
        SS.keep(spark, root, run, {"sales": SS.typed_snapshot(spark, FS.infer_types(extract))})
    return SS.history(spark, root).select("run_id", "column", "change", "old_dtype", "new_dtype")


@register("orders_one_month", "§2.11 date partitions", f"""
WITH v AS ({V.MERGE_EXISTING_SQL} UNION ALL {V.MERGE_BATCH_SQL}),
o AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY source, order_id ORDER BY ingested_at DESC) = 1)
SELECT source, order_id, created_at, total_price, financial_status, ingested_at FROM o
WHERE created_at >= TIMESTAMP '2000-06-01' AND created_at < TIMESTAMP '2000-07-01'""")
def q_orders_one_month(spark: SparkSession, d: str) -> DataFrame:
    """Three deliveries into a table partitioned by month, the last of which brings a few months anew; then one month is read."""
    path = _folder(spark, "dated")
    for batch in _loads(spark, d):
        DD.upsert(spark, path, batch, ORDER_ROWS, M.ORDER_KEYS, "created_at", "ingested_at", "month")
    month = dt.date(2000, 6, 1)
    return DD.read(spark, path, ORDER_ROWS, month, month).select("source", "order_id", "created_at", "total_price", "financial_status", "ingested_at")


UPDATED_ROWS = T.StructType().add("provider", "string").add("resource", "string").add("order_id", "string").add("total_price", "double").add(
    "raw_hash", "string").add("updated_at", "timestamp_ntz")


def order_updates(spark: SparkSession, d: str) -> DataFrame:
    """Every order as it came, and every third one dearer by 1 some days later; ``arrives``: when the provider shows the version, two days late for some."""
    o = V.table(spark, d, "orders")
    price, day = F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderdate")
    def version(rows: DataFrame, more: int, at) -> DataFrame:
        return rows.select(F.col("o_orderpriority").alias("provider"), F.lit("orders").alias("resource"), F.col("o_orderkey").cast("string").alias("order_id"),
                           (price + more).cast("double").alias("total_price"), F.lit(str(more)).alias("raw_hash"), at.cast("timestamp_ntz").alias("updated_at"),
                           F.col("o_orderkey").alias("_key"))
    both = version(o, 0, day).unionByName(version(o.where("o_orderkey % 3 = 0"), 1, day + F.make_dt_interval((F.col("o_orderkey") % 5 + 1).cast("int"))))
    late = F.when(F.col("_key") % 7 == 0, F.col("updated_at") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("updated_at"))
    return both.withColumn("arrives", late).drop("_key")


@register("incremental_by_updated_at", "§2.11 incremental read", """
SELECT o_orderpriority AS provider, CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS total_price,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 5 + 1 AS INTEGER)) ELSE o_orderdate END AS updated_at
FROM orders""")
def q_incremental_by_updated_at(spark: SparkSession, d: str) -> DataFrame:
    """Three pulls, each of which sees what has arrived by then: late versions lie in the overlap of the next one."""
    root, rows = _folder(spark, "pulls"), order_updates(spark, d)
    for cut in ("1998-01-01", "2000-03-01", "2100-01-01"):
        there = rows.where(F.col("arrives") <= F.lit(cut).cast("timestamp_ntz")).drop("arrives")
        WM.pull(spark, there, root, "orders", UPDATED_ROWS, f"{root}/marks", ["provider", "resource"], "updated_at", ["provider", "order_id"], "3 days")
    return TB.read_table(spark, root, "orders", UPDATED_ROWS, ["provider", "order_id"]).select("provider", "order_id", "total_price", "updated_at")
