"""Registry of the queries exposed through ``__spark_entry__``.

Each entry pairs a Spark plan over the supplied tables with an independent
DuckDB SQL oracle that spells out the same semantics (NULL rules, exact
money sums, pandas quantile interpolation). Entries without an oracle are
checked against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_sql
from ..operators import features as FE
from ..operators import kpis as K
from . import views as V


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, oracle: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, ids, fn, oracle)
        return fn
    return deco


P = f"({V.PRODUCTS_SQL})"
O = f"({V.ORDERS_SQL})"
EO = f"({V.EVENT_ORDERS_SQL})"


def _q(table_sql: str, value: str, probs: dict, by=(), count_alias="n") -> str:
    return quantile_sql(table_sql, value, probs, by, count_alias)


# ---------------------------------------------------------------------------
# W1-W3 rolling metrics (flagship)
# ---------------------------------------------------------------------------

def _rolling_sql(src: str) -> str:
    return f"""
WITH src AS (SELECT created_at, CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12)) AS v FROM {src} s WHERE created_at IS NOT NULL),
daily AS (SELECT CAST(created_at AS DATE) AS day, sum(v) AS gmv_dec, count(v) AS n_orders FROM src GROUP BY 1),
spine AS (SELECT CAST(d AS DATE) AS day FROM (SELECT min(day) AS lo, max(day) AS hi FROM daily) r,
          generate_series(CAST(r.lo AS TIMESTAMP), CAST(r.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
filled AS (SELECT spine.day, daily.gmv_dec, coalesce(daily.n_orders, 0) AS n_orders
           FROM spine LEFT JOIN daily ON spine.day = daily.day),
rolled AS (SELECT day, gmv_dec, n_orders,
           sum(gmv_dec) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS g7,
           sum(n_orders) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS o7 FROM filled)
SELECT day, CAST(gmv_dec AS DOUBLE) AS gmv, CAST(n_orders AS BIGINT) AS n_orders, CAST(g7 AS DOUBLE) AS gmv_7d,
       CAST(o7 AS BIGINT) AS orders_7d,
       CASE WHEN o7 > 0 THEN CAST(g7 AS DOUBLE) / CAST(o7 AS DOUBLE) END AS aov_7d
FROM rolled"""


@register("orders_rolling_7d", "W1 W2 W3", _rolling_sql(O))
def q_orders_rolling_7d(spark, d):
    return FE.rolling_7d(V.orders(spark, d))


@register("events_rolling_7d", "W1 W2 W3", _rolling_sql(EO))
def q_events_rolling_7d(spark, d):
    return FE.rolling_7d(V.event_orders(spark, d))


@register("orders_rolling_7d_by_source", "W2 (partitioned)", f"""
WITH src AS (SELECT source, created_at, CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12)) AS v FROM {O} s WHERE created_at IS NOT NULL),
daily AS (SELECT source, CAST(created_at AS DATE) AS day, sum(v) AS gmv_dec, count(v) AS n_orders FROM src GROUP BY 1, 2),
spine AS (SELECT r.source, CAST(d AS DATE) AS day FROM (SELECT source, min(day) AS lo, max(day) AS hi FROM daily GROUP BY 1) r,
          generate_series(CAST(r.lo AS TIMESTAMP), CAST(r.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
filled AS (SELECT spine.source, spine.day, daily.gmv_dec, coalesce(daily.n_orders, 0) AS n_orders
           FROM spine LEFT JOIN daily ON spine.day = daily.day AND spine.source = daily.source),
rolled AS (SELECT source, day, gmv_dec, n_orders,
           sum(gmv_dec) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS g7,
           sum(n_orders) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS o7 FROM filled)
SELECT source, day, CAST(gmv_dec AS DOUBLE) AS gmv, CAST(n_orders AS BIGINT) AS n_orders, CAST(g7 AS DOUBLE) AS gmv_7d,
       CAST(o7 AS BIGINT) AS orders_7d,
       CASE WHEN o7 > 0 THEN CAST(g7 AS DOUBLE) / CAST(o7 AS DOUBLE) END AS aov_7d
FROM rolled""")
def q_orders_rolling_7d_by_source(spark, d):
    return FE.rolling_7d(V.orders(spark, d), by=["source"])


# ---------------------------------------------------------------------------
# A12-A14 daily metrics
# ---------------------------------------------------------------------------

def _daily_sql(src: str) -> str:
    return (f"SELECT CAST(created_at AS DATE) AS day, "
            f"CAST(coalesce(sum(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12))), 0) AS DOUBLE) AS gmv, count(*) AS n_orders, "
            f"CAST(coalesce(sum(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12))), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS aov "
            f"FROM {src} s WHERE created_at IS NOT NULL GROUP BY 1")


@register("orders_daily_metrics", "A12 A13", _daily_sql(O))
def q_orders_daily_metrics(spark, d):
    return K.daily_metrics(V.orders(spark, d))


@register("events_daily_metrics", "A12 A13", _daily_sql(EO))
def q_events_daily_metrics(spark, d):
    return K.daily_metrics(V.event_orders(spark, d))


def _daily_summary_sql(src: str) -> str:
    return f"""
WITH daily AS ({_daily_sql(src)})
SELECT CAST(sum(CAST(CAST(gmv AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS gmv_total, CAST(sum(n_orders) AS BIGINT) AS orders_total,
       CAST(date_diff('day', min(day), max(day)) AS BIGINT) AS days_span,
       list_reduce(list_transform(list_sort(list({{'day': day, 'aov': aov}})), lambda x: x.aov), lambda a, b: a + b)
         / CAST(count(aov) AS DOUBLE) AS aov_mean
FROM daily"""


@register("daily_aov_mean", "A13 A14", _daily_summary_sql(O))
def q_daily_aov_mean(spark, d):
    return K.daily_summary(V.orders(spark, d))


@register("events_daily_aov_mean", "A13 A14", _daily_summary_sql(EO))
def q_events_daily_aov_mean(spark, d):
    return K.daily_summary(V.event_orders(spark, d))


# ---------------------------------------------------------------------------
# W4 recency, F-5..F-7 enriched orders
# ---------------------------------------------------------------------------

@register("orders_recency", "W4 F-7", f"""
SELECT order_id, (epoch_us((SELECT max(created_at) FROM {EO} m)) - epoch_us(created_at)) / 86400000000.0 AS recency_days
FROM {EO} s""")
def q_orders_recency(spark, d):
    return FE.recency(V.event_orders(spark, d)).select("order_id", "recency_days")


@register("orders_enriched", "F-5 F-6 F-7 J5", f"""
WITH r AS ({_rolling_sql(EO)}), s AS (SELECT * FROM {EO} s)
SELECT s.order_id, s.total_price AS order_value_num, r.gmv_7d, r.orders_7d, r.aov_7d,
       (epoch_us((SELECT max(created_at) FROM s)) - epoch_us(s.created_at)) / 86400000000.0 AS recency_days
FROM s LEFT JOIN r ON CAST(s.created_at AS DATE) = r.day""")
def q_orders_enriched(spark, d):
    e = FE.enrich_orders(V.event_orders(spark, d))
    return e.select("order_id", "order_value_num", "gmv_7d", "orders_7d", "aov_7d", "recency_days")


# ---------------------------------------------------------------------------
# A1-A7 product KPIs
# ---------------------------------------------------------------------------

@register("product_price_stats", "A1 A2 A3", f"""
WITH p AS (SELECT * FROM {P} p),
base AS (SELECT count(*) AS count, count(DISTINCT source) AS distinct_sources, min(price_amount) AS price_min,
         max(price_amount) AS price_max,
         CAST(sum(CAST(CAST(price_amount AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / count(price_amount) AS price_mean FROM p),
top AS (SELECT category AS top_category FROM p WHERE category IS NOT NULL GROUP BY category
        ORDER BY count(*) DESC, category ASC LIMIT 1),
q AS ({_q(V.PRODUCTS_SQL, 'price_amount', {'price_median': 0.5, 'price_p90': 0.9})})
SELECT base.count, base.distinct_sources, top.top_category, base.price_min, q.price_median, base.price_mean,
       q.price_p90, base.price_max
FROM base, top, q""")
def q_product_price_stats(spark, d):
    return K.product_summary(V.products(spark, d))


def _fence_sql() -> str:
    return _q(V.PRODUCTS_SQL, "price_amount", {"q1": 0.25, "q3": 0.75})


@register("product_outliers_iqr2", "A5", f"""
WITH f AS ({_fence_sql()}),
g AS (SELECT n, q1, q3, CASE WHEN q3 - q1 <> 0 THEN q3 - q1 ELSE 1.0 END AS iqr FROM f),
h AS (SELECT n, iqr, q1 - 1.5 * iqr AS lo, q3 + 1.5 * iqr AS hi FROM g),
k AS (SELECT count(*) AS rows_, count(*) FILTER (WHERE p.price_amount > h.hi OR p.price_amount < h.lo) AS k
      FROM {P} p, h)
SELECT CASE WHEN h.n > 5 THEN CAST(k.k AS DOUBLE) / CAST(k.rows_ AS DOUBLE) END AS outlier_price_ratio,
       CASE WHEN h.n > 5 THEN k.k END AS outlier_count,
       CASE WHEN h.n > 5 THEN h.iqr END AS iqr, CASE WHEN h.n > 5 THEN h.lo END AS fence_lower,
       CASE WHEN h.n > 5 THEN h.hi END AS fence_upper
FROM k, h""")
def q_product_outliers_iqr2(spark, d):
    return K.outliers_two_sided(V.products(spark, d))


def _upper_sql() -> str:
    return f"""
WITH f AS ({_fence_sql()}), h AS (SELECT n, q3 + 1.5 * (q3 - q1) AS hi FROM f),
k AS (SELECT count(*) AS rows_, count(*) FILTER (WHERE p.price_amount > h.hi) AS k FROM {P} p, h)
SELECT CASE WHEN h.n > 0 THEN CAST((2 * k.k * 10000 + k.rows_) // (2 * k.rows_) AS DOUBLE) / 10000.0 END
         AS price_outlier_ratio,
       CASE WHEN h.n > 0 THEN h.hi END AS fence_upper
FROM k, h"""


@register("product_outliers_upper", "A6", _upper_sql())
def q_product_outliers_upper(spark, d):
    return K.outliers_upper(V.products(spark, d))


def _dupkey_sql(src: str, keys: str) -> str:
    cond = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""
WITH per AS (SELECT {keys}, count(*) AS n FROM {src} s WHERE {cond} GROUP BY {keys}),
a AS (SELECT count(*) FILTER (WHERE n > 1) AS duplicate_key_pairs, count(*) AS distinct_keys FROM per)
SELECT duplicate_key_pairs, distinct_keys,
       CASE WHEN distinct_keys > 0 THEN CAST(duplicate_key_pairs AS DOUBLE) / CAST(distinct_keys AS DOUBLE) ELSE 0.0 END
         AS duplicate_key_ratio,
       CASE WHEN distinct_keys > 0 THEN
         CAST((2 * duplicate_key_pairs * 10000 + distinct_keys) // (2 * distinct_keys) AS DOUBLE) / 10000.0 END
         AS duplicate_key_ratio_r4
FROM a"""


@register("product_duplicate_keys", "A4", _dupkey_sql(P, "source, source_id"))
def q_product_duplicate_keys(spark, d):
    return K.duplicate_keys(V.products(spark, d))


@register("customer_name_duplicate_keys", "A4", _dupkey_sql("customer", "c_mktsegment, c_nationkey"))
def q_customer_duplicate_keys(spark, d):
    return K.duplicate_keys(V.table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"])


@register("product_quality", "A7", f"""
WITH base AS (SELECT count(price_amount) AS price_non_null, min(price_amount) AS price_min,
              max(price_amount) AS price_max FROM {P} p),
q AS ({_q(V.PRODUCTS_SQL, 'price_amount', {'price_p50': 0.5, 'price_p90': 0.9})}),
up AS ({_upper_sql()}),
dk AS ({_dupkey_sql(P, 'source, source_id')})
SELECT base.price_non_null, base.price_min, q.price_p50, q.price_p90, base.price_max, up.price_outlier_ratio,
       dk.duplicate_key_pairs, dk.duplicate_key_ratio_r4 AS duplicate_key_ratio
FROM base, q, up, dk""")
def q_product_quality(spark, d):
    return K.product_quality(V.products(spark, d))


# ---------------------------------------------------------------------------
# A8, A9, A23 distributions
# ---------------------------------------------------------------------------

def _top_sql(src: str, col: str, name: str, k: int = 10, null_label: str | None = None) -> str:
    key = f"coalesce({col}, '{null_label}')" if null_label else col
    return f"""
WITH t AS (SELECT count(*) AS total FROM {src} s),
c AS (SELECT {key} AS {name}, count(*) AS count FROM {src} s WHERE {key} IS NOT NULL GROUP BY 1)
SELECT {name}, count, CAST(count AS DOUBLE) / CAST(t.total AS DOUBLE) AS ratio
FROM c, t ORDER BY count DESC, {name} ASC LIMIT {k}"""


@register("product_source_top10", "A8", _top_sql(P, "source", "source"))
def q_product_source_top10(spark, d):
    return K.top_values(V.products(spark, d), "source", 10)


@register("order_source_top10", "A8", _top_sql(O, "source", "source"))
def q_order_source_top10(spark, d):
    return K.top_values(V.orders(spark, d), "source", 10)


@register("category_top10", "A9", _top_sql(P, "category", "category", 10, "<null>"))
def q_category_top10(spark, d):
    return K.top_values(V.products(spark, d), "category", 10, null_label="<null>")


@register("status_distribution", "A23", f"""
SELECT financial_status, count(*) AS count FROM {O} s WHERE financial_status IS NOT NULL GROUP BY 1""")
def q_status_distribution(spark, d):
    return K.value_counts(V.orders(spark, d), "financial_status")


@register("segment_distribution", "A23", """
SELECT c_mktsegment, count(*) AS count FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1""")
def q_segment_distribution(spark, d):
    return K.value_counts(V.table(spark, d, "customer"), "c_mktsegment")


# ---------------------------------------------------------------------------
# A10, A11 order summary; A19 KPI rollup; A18 availability
# ---------------------------------------------------------------------------

def _order_summary_sql(src_sql: str) -> str:
    src = f"({src_sql})"
    return f"""
WITH base AS (SELECT count(*) AS count,
  CAST(floor((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 86400000000.0) AS BIGINT) AS timespan_days,
  CAST(sum(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS gmv_total,
  CAST(sum(CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / count(total_price) AS gmv_mean FROM {src} s),
med AS ({_q(src_sql, 'total_price', {'gmv_median': 0.5})})
SELECT base.count, base.timespan_days, base.gmv_total, base.gmv_mean, med.gmv_median FROM base, med"""


@register("gmv_stats", "A10 A11", _order_summary_sql(V.ORDERS_SQL))
def q_gmv_stats(spark, d):
    return K.order_summary(V.orders(spark, d))


@register("events_gmv_stats", "A10 A11", _order_summary_sql(V.EVENT_ORDERS_SQL))
def q_events_gmv_stats(spark, d):
    return K.order_summary(V.event_orders(spark, d))


def _provider_json_sql(src: str) -> str:
    return (f"(SELECT '{{' || string_agg('\"' || source || '\":' || CAST(count AS VARCHAR), ',' ORDER BY source) || '}}' "
            f"FROM (SELECT source, count(*) AS count FROM ({src}) s WHERE source IS NOT NULL GROUP BY source) tv)")


@register("kpi_rollup", "A19", f"""
WITH f AS ({_fence_sql()}),
g AS (SELECT n, q1, q3, CASE WHEN q3 - q1 <> 0 THEN q3 - q1 ELSE 1.0 END AS iqr FROM f),
h AS (SELECT n, q1 - 1.5 * iqr AS lo, q3 + 1.5 * iqr AS hi FROM g),
outl AS (SELECT CASE WHEN max(h.n) > 5 THEN count(*) FILTER (WHERE p.price_amount > h.hi OR p.price_amount < h.lo) END
         AS products_outliers_price FROM {P} p, h),
gmv AS ({_order_summary_sql(V.ORDERS_SQL)})
SELECT (SELECT count(*) FROM part) AS products_total,
       {_provider_json_sql(P)} AS products_by_provider,
       CAST(NULL AS BIGINT) AS products_new, CAST(NULL AS BIGINT) AS products_updated,
       outl.products_outliers_price,
       (SELECT count(*) FROM orders) AS orders_total,
       {_provider_json_sql(O)} AS orders_by_provider,
       CAST(NULL AS BIGINT) AS orders_outliers_total,
       gmv.gmv_mean AS aov_mean, gmv.gmv_median AS aov_median
FROM outl, gmv""")
def q_kpi_rollup(spark, d):
    return K.kpi_rollup(V.products(spark, d), V.orders(spark, d))


@register("availability", "A18 F-8", f"""
SELECT 'products' AS dataset, count(*) AS rows, true AS enriched FROM part
UNION ALL SELECT 'orders', count(*), true FROM orders
UNION ALL SELECT 'run_log', count(*), false FROM ({V.RUN_LOG_SQL}) r""")
def q_availability(spark, d):
    return K.availability({"products": V.products(spark, d), "orders": V.orders(spark, d),
                           "run_log": V.run_log(spark, d)},
                          {"products": True, "orders": True})


# ---------------------------------------------------------------------------
# F-1..F-4 product features, A15 bucket distribution
# ---------------------------------------------------------------------------

def _edges_sql(src_sql: str = V.PRODUCTS_SQL) -> str:
    probs = {"e0": 0.0, "e1": 0.2, "e2": 0.4, "e3": 0.6000000000000001, "e4": 0.8, "e5": 1.0}  # numpy.linspace(0, 1, 6)
    return (f"SELECT list_distinct_ordered AS edges FROM (SELECT "
            f"list_sort(list_distinct([e0, e1, e2, e3, e4, e5])) AS list_distinct_ordered "
            f"FROM ({_q(src_sql, 'price_amount', probs)}) qq) ee")


def _enriched_products_sql(src_sql: str = V.PRODUCTS_SQL) -> str:
    return f"""
WITH p AS (SELECT * FROM ({src_sql}) p),
e AS ({_edges_sql(src_sql)}),
b AS (SELECT p.*, CASE WHEN price_amount IS NOT NULL AND len(e.edges) >= 2 THEN
        CAST(len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x < price_amount)) AS INTEGER) END AS price_bucket,
        e.edges FROM p, e),
sf AS (SELECT source, count(*) AS source_freq FROM p WHERE source IS NOT NULL GROUP BY 1),
cf AS (SELECT coalesce(category, '<null>') AS cat, count(*) AS category_freq FROM p GROUP BY 1)
SELECT b.source_id, b.price_amount AS price_num,
       CASE WHEN (SELECT max(price_amount > 0) FROM p) THEN ln(1 + b.price_amount) END AS price_log,
       b.price_bucket,
       CASE WHEN b.price_bucket IS NOT NULL THEN b.edges[b.price_bucket + 1] END AS price_bucket_lo,
       CASE WHEN b.price_bucket IS NOT NULL THEN b.edges[b.price_bucket + 2] END AS price_bucket_hi,
       sf.source_freq, cf.category_freq
FROM b LEFT JOIN sf ON b.source = sf.source LEFT JOIN cf ON coalesce(b.category, '<null>') = cf.cat"""


@register("product_features", "F-1 F-2 F-3 F-4 W7 J4", f"""
SELECT source_id, price_num, round(price_log, 9) AS price_log, price_bucket, price_bucket_lo, price_bucket_hi,
       source_freq, category_freq FROM ({_enriched_products_sql()}) x""")
def q_product_features(spark, d):
    e = FE.enrich_products(V.products(spark, d))
    return e.select("source_id", "price_num", F.round("price_log", 9).alias("price_log"), "price_bucket",
                    "price_bucket_lo", "price_bucket_hi", "source_freq", "category_freq")


@register("price_bucket_distribution", "A15 F-3", f"""
WITH b AS ({_enriched_products_sql()}), t AS (SELECT count(*) AS total FROM b)
SELECT price_bucket, count(*) AS count, CAST(count(*) AS DOUBLE) / CAST(max(t.total) AS DOUBLE) AS ratio
FROM b, t GROUP BY price_bucket""")
def q_price_bucket_distribution(spark, d):
    return K.bucket_distribution(FE.enrich_products(V.products(spark, d)))


_ORDERS_AS_PRODUCTS_SQL = ("SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS source_id, "
                           "o_totalprice AS price_amount, o_orderstatus AS category FROM orders")


@register("order_value_buckets", "F-3 A15", f"""
WITH b AS ({_enriched_products_sql(_ORDERS_AS_PRODUCTS_SQL)}), t AS (SELECT count(*) AS total FROM b)
SELECT price_bucket, count(*) AS count, CAST(count(*) AS DOUBLE) / CAST(max(t.total) AS DOUBLE) AS ratio
FROM b, t GROUP BY price_bucket""")
def q_order_value_buckets(spark, d):
    return K.bucket_distribution(FE.enrich_products(
        V.orders(spark, d).select("source", F.col("order_id").alias("source_id"),
                                  F.col("total_price").alias("price_amount"),
                                  F.col("financial_status").alias("category"))))


# ---------------------------------------------------------------------------
# A25 / A26 histograms
# ---------------------------------------------------------------------------

def _hist_sql(values_sql: str, bins: int) -> str:
    return f"""
WITH v AS (SELECT CAST(x AS DOUBLE) AS v FROM ({values_sql}) vv WHERE x IS NOT NULL AND NOT isnan(CAST(x AS DOUBLE))),
r0 AS (SELECT min(v) AS mn, max(v) AS mx FROM v),
r AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r0),
c AS (SELECT CAST(least(floor(CAST({bins} AS DOUBLE) * (v.v - r.lo) / (r.hi - r.lo)) + 1, {bins}) AS BIGINT) AS bin,
      count(*) AS count FROM v, r GROUP BY 1),
axis AS (SELECT CAST(b AS BIGINT) AS bin, r.lo + CAST(b - 1 AS DOUBLE) * ((r.hi - r.lo) / CAST({bins} AS DOUBLE)) AS bin_lo,
         CASE WHEN b = {bins} THEN r.hi ELSE r.lo + CAST(b AS DOUBLE) * ((r.hi - r.lo) / CAST({bins} AS DOUBLE)) END
           AS bin_hi
         FROM r, range(1, {bins} + 1) t(b) WHERE r.lo IS NOT NULL)
SELECT axis.bin, axis.bin_lo, axis.bin_hi, coalesce(c.count, 0) AS count FROM axis LEFT JOIN c ON axis.bin = c.bin"""


@register("hist_price_40", "A25", _hist_sql("SELECT p_retailprice AS x FROM part", 40))
def q_hist_price_40(spark, d):
    return FE.histogram(V.products(spark, d), "price_amount", 40)


@register("hist_price_20", "A25", _hist_sql("SELECT p_retailprice AS x FROM part", 20))
def q_hist_price_20(spark, d):
    return FE.histogram(V.products(spark, d), "price_amount", 20)


@register("hist_order_value_40", "A25", _hist_sql("SELECT o_totalprice AS x FROM orders", 40))
def q_hist_order_value_40(spark, d):
    return FE.histogram(V.orders(spark, d), "total_price", 40)


@register("hist_sales_50", "A25", _hist_sql("SELECT l_extendedprice AS x FROM lineitem", 50))
def q_hist_sales_50(spark, d):
    return FE.histogram(V.table(spark, d, "lineitem"), "l_extendedprice", 50)


@register("hist_daily_aov_20", "A25 A13", _hist_sql(f"SELECT aov AS x FROM ({_daily_sql(O)}) dd", 20))
def q_hist_daily_aov_20(spark, d):
    return FE.histogram(K.daily_metrics(V.orders(spark, d)), "aov", 20)


@register("hist_price_log_20", "A26", f"""
SELECT bin, round(bin_lo, 9) AS bin_lo, round(bin_hi, 9) AS bin_hi, count FROM
 ({_hist_sql("SELECT log10(p_retailprice) AS x FROM part WHERE p_retailprice > 0", 20)}) h""")
def q_hist_price_log_20(spark, d):
    h = FE.log10_histogram(V.products(spark, d), "price_amount", 20)
    # log10 may differ in the last bit between math libraries: edges are reported to 1e-9
    return h.select("bin", F.round("bin_lo", 9).alias("bin_lo"), F.round("bin_hi", 9).alias("bin_hi"), "count")


@register("hist_price_log_20_counts", "A26", f"""
SELECT bin, count FROM ({_hist_sql("SELECT log10(p_retailprice) AS x FROM part WHERE p_retailprice > 0", 20)}) h""")
def q_hist_price_log_20_counts(spark, d):
    return FE.log10_histogram(V.products(spark, d), "price_amount", 20).select("bin", "count")


# ---------------------------------------------------------------------------
# A20-A22, A24 generic profiling
# ---------------------------------------------------------------------------

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS "column", s.count, s.mean, s.std, s.min, q.q25, q.q50, q.q75, s.max FROM
 (SELECT count({c}) AS count,
         CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / count({c}) AS mean,
         round(stddev_samp({c}), 6) AS std,
         CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM ({src}) t) s,
 ({_q(f"SELECT {c} FROM ({src}) t", c, {'q25': 0.25, 'q50': 0.5, 'q75': 0.75})}) q""")
    return " UNION ALL ".join(parts)


@register("describe_numeric", "A22", _describe_sql("SELECT * FROM lineitem", LINEITEM_NUMERIC))
def q_describe_numeric(spark, d):
    # moments merge in no fixed order: the last bits of std are rounded off on both sides
    return K.describe(V.table(spark, d, "lineitem"), LINEITEM_NUMERIC).withColumn("std", F.round("std", 6))


@register("null_counts", "A20", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM labels"
    for c in ["doc_id", "quality", "toxic"]))
def q_null_counts(spark, d):
    return K.null_counts(V.table(spark, d, "labels"))


@register("duplicate_rows", "A21", """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(n) AS BIGINT) AS rows FROM
 (SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang) g""")
def q_duplicate_rows(spark, d):
    return K.duplicate_rows(V.table(spark, d, "documents"), ["text", "lang"])


def _delivery_days_sql() -> str:
    return ("SELECT o.o_orderkey, CAST(floor((epoch_us(l.last_ship) - epoch_us(o.o_orderdate)) / 86400000000.0) AS BIGINT)"
            " AS delivery_days FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem "
            "GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey")


def delivery_days(spark, d):
    from ..functions import exprs as X
    o = V.table(spark, d, "orders")
    last = V.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = o.join(last, o["o_orderkey"] == last["l_orderkey"])
    return j.select("o_orderkey", X.floor_days(F.col("o_orderdate"), F.col("last_ship")).alias("delivery_days"))


@register("delivery_stats", "A24", f"""
WITH d AS ({_delivery_days_sql()}),
base AS (SELECT count(delivery_days) AS n, CAST(sum(delivery_days) AS DOUBLE) / CAST(count(delivery_days) AS DOUBLE)
           AS mean_days,
         round(stddev_samp(delivery_days), 6)
           AS std_days FROM d),
med AS ({_q(_delivery_days_sql(), 'delivery_days', {'median_days': 0.5})})
SELECT base.n, base.mean_days, base.std_days, med.median_days FROM base, med""")
def q_delivery_stats(spark, d):
    return K.days_stats(delivery_days(spark, d), "delivery_days").withColumn("std_days", F.round("std_days", 6))


@register("hist_delivery_30", "A25 A24", _hist_sql(f"SELECT delivery_days AS x FROM ({_delivery_days_sql()}) dd", 30))
def q_hist_delivery_30(spark, d):
    return FE.histogram(delivery_days(spark, d), "delivery_days", 30)


# ---------------------------------------------------------------------------
# M1-M9, J1-J3 incremental merge
# ---------------------------------------------------------------------------

from ..operators import merge as M  # noqa: E402


def _merge_sql(existing_sql: str, batch_sql: str, keys: list[str], order_col: str, mode: str) -> str:
    on3 = " AND ".join(f"e.{k} IS NOT DISTINCT FROM b.{k}" for k in [*keys, "raw_hash"])
    on2 = " AND ".join(f"e.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    part = ", ".join(keys)
    if mode == "triple":
        return (f"WITH e AS ({existing_sql}), b AS ({batch_sql}) "
                f"SELECT * FROM e UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE {on3})")
    return (f"WITH e AS ({existing_sql}), b0 AS ({batch_sql}), "
            f"b AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {part} "
            f"ORDER BY {order_col} DESC, raw_hash DESC) AS rn_ FROM b0) x WHERE rn_ = 1) "
            f"SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM b WHERE {on2}) UNION ALL SELECT * FROM b")


def _merge_counts_sql(existing_sql: str, batch_sql: str, keys: list[str], order_col: str) -> str:
    on3 = " AND ".join(f"e.{k} IS NOT DISTINCT FROM b.{k}" for k in [*keys, "raw_hash"])
    on2 = " AND ".join(f"e.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    part = ", ".join(keys)
    return (f"WITH e AS ({existing_sql}), b AS ({batch_sql}), "
            f"bk AS (SELECT DISTINCT {part} FROM b) "
            f"SELECT 'triple' AS mode, (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE {on3})) AS new, "
            f"CAST(0 AS BIGINT) AS updated "
            f"UNION ALL SELECT 'pair', "
            f"(SELECT count(*) FROM bk b WHERE NOT EXISTS (SELECT 1 FROM e WHERE {on2})), "
            f"(SELECT count(*) FROM bk b WHERE EXISTS (SELECT 1 FROM e WHERE {on2}))")


def _both_counts(existing: DataFrame, batch: DataFrame, fn) -> DataFrame:
    t = fn(existing, batch, "triple").counts.select(F.lit("triple").alias("mode"), "new", "updated")
    p = fn(existing, batch, "pair").counts.select(F.lit("pair").alias("mode"), "new", "updated")
    return t.unionByName(p)


@register("merge_orders_triple", "M3 M5 J1", _merge_sql(V.MERGE_EXISTING_SQL, V.MERGE_BATCH_SQL,
                                                         ["source", "order_id"], "ingested_at", "triple"))
def q_merge_orders_triple(spark, d):
    return M.merge_orders(V.merge_existing(spark, d), V.merge_batch(spark, d), "triple").table


@register("merge_orders_pair", "M4 M5 M6 J2", _merge_sql(V.MERGE_EXISTING_SQL, V.MERGE_BATCH_SQL,
                                                         ["source", "order_id"], "ingested_at", "pair"))
def q_merge_orders_pair(spark, d):
    return M.merge_orders(V.merge_existing(spark, d), V.merge_batch(spark, d), "pair").table


@register("merge_orders_counts", "J3 M9", _merge_counts_sql(V.MERGE_EXISTING_SQL, V.MERGE_BATCH_SQL,
                                                           ["source", "order_id"], "ingested_at"))
def q_merge_orders_counts(spark, d):
    return _both_counts(V.merge_existing(spark, d), V.merge_batch(spark, d), M.merge_orders)


@register("merge_products_triple", "M1 M5 J1", _merge_sql(V.PRODUCT_EXISTING_SQL, V.PRODUCT_BATCH_SQL,
                                                          ["source", "source_id"], "collected_at", "triple"))
def q_merge_products_triple(spark, d):
    return M.merge_products(V.product_existing(spark, d), V.product_batch(spark, d), "triple").table


@register("merge_products_pair", "M2 M5 M6 J2", _merge_sql(V.PRODUCT_EXISTING_SQL, V.PRODUCT_BATCH_SQL,
                                                            ["source", "source_id"], "collected_at", "pair"))
def q_merge_products_pair(spark, d):
    return M.merge_products(V.product_existing(spark, d), V.product_batch(spark, d), "pair").table


@register("merge_products_counts", "J3 M9", _merge_counts_sql(V.PRODUCT_EXISTING_SQL, V.PRODUCT_BATCH_SQL,
                                                             ["source", "source_id"], "collected_at"))
def q_merge_products_counts(spark, d):
    return _both_counts(V.product_existing(spark, d), V.product_batch(spark, d), M.merge_products)


# ---------------------------------------------------------------------------
# N1-N14 normalizers over JSON rendered from the supplied tables
# ---------------------------------------------------------------------------

from ..operators import normalize as N  # noqa: E402
from . import raw_views as R  # noqa: E402

_PRODUCT_OUT = ["source", "source_id", "title", "price_amount", "price_currency", "image_url", "category"]


@register("normalize_shopify_products", "N1 N6 N13 N14", R.SHOPIFY_PRODUCTS_SQL)
def q_normalize_shopify_products(spark, d):
    out = N.normalize_shopify_products(R.shopify_products_raw(spark, d), N.batch_stamp(R.STAMP))
    return out.select(*_PRODUCT_OUT)


@register("normalize_amazon_items", "N2", R.AMAZON_SQL)
def q_normalize_amazon_items(spark, d):
    out = N.normalize_amazon_items(R.amazon_raw(spark, d), N.batch_stamp(R.STAMP))
    return out.select(*_PRODUCT_OUT, "url")


@register("normalize_ebay_search", "N3", R.EBAY_SQL)
def q_normalize_ebay_search(spark, d):
    out = N.normalize_ebay_search(R.ebay_raw(spark, d), N.batch_stamp(R.STAMP))
    return out.select(*_PRODUCT_OUT, "url")


@register("normalize_shopify_orders", "N4 N8 N9 N10 N11 N12", R.SHOPIFY_ORDERS_SQL)
def q_normalize_shopify_orders(spark, d):
    out = N.normalize_shopify_orders(R.shopify_orders_raw(spark, d), N.batch_stamp(R.STAMP))
    return out.select("source", "order_id", "source_order_number", "currency", "total_price", "total_discount",
                      "total_shipping", "financial_status", "line_items_count", "line_items_skus", "customer_id",
                      "customer_email_hash")


@register("provider_union", "N5", f"""
SELECT source, count(*) AS products, count(price_amount) AS priced, count(category) AS categorised FROM (
  SELECT source, price_amount, category FROM ({R.SHOPIFY_PRODUCTS_SQL}) a UNION ALL
  SELECT source, price_amount, category FROM ({R.AMAZON_SQL}) b UNION ALL
  SELECT source, price_amount, category FROM ({R.EBAY_SQL}) c) u GROUP BY source""")
def q_provider_union(spark, d):
    stamp = N.batch_stamp(R.STAMP)
    batch = N.union_batches([N.normalize_shopify_products(R.shopify_products_raw(spark, d), stamp),
                             N.normalize_amazon_items(R.amazon_raw(spark, d), stamp),
                             N.normalize_ebay_search(R.ebay_raw(spark, d), stamp)])
    return batch.groupBy("source").agg(F.count(F.lit(1)).alias("products"), F.count("price_amount").alias("priced"),
                                       F.count("category").alias("categorised"))


@register("content_hash", "N14", None)
def q_content_hash(spark, d):
    """Batch hash of the landed order file: order-insensitive digest of the
    canonical per-record hashes, combined map-side."""
    from ..functions.exprs import multiset_digest
    raw = R.shopify_orders_raw(spark, d)
    return raw.agg(multiset_digest("raw_hash").alias("batch_hash"), F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------------------
# C1-C21 cleaning jobs over text extracts rendered from the supplied tables
# ---------------------------------------------------------------------------

from ..operators import clean as C  # noqa: E402
from . import dirty_views as DV  # noqa: E402

_CLEAN_IDS = {"E-commerce Dataset": "C10", "online_retail": "C11", "Sale Report": "C12", "orders": "C13",
              "order_items": "C14", "customers": "C15", "payments": "C16", "reviews": "C17", "products": "C18",
              "sellers": "C19", "geolocation": "C20", "category_translation": "C21"}


def _clean_query(dataset: str):
    view, sql, cols = DV.EXTRACTS[dataset]
    rule = C.RULES[dataset]
    name = "clean_" + dataset.lower().replace(" ", "_").replace("-", "_")

    def build(spark, d):
        return C.clean(view(spark, d), rule)

    register(name, f"C1-C8 {_CLEAN_IDS[dataset]}", C.clean_sql(sql, cols, rule))(build)


for _ds in DV.EXTRACTS:
    _clean_query(_ds)


# ---------------------------------------------------------------------------
# A17, O3, O4, W5 run-log trends (run log = one run per event day)
# ---------------------------------------------------------------------------

from ..operators import runlog as RL  # noqa: E402

_RL = f"({V.RUN_LOG_SQL})"


@register("runlog_rollup", "A17 O3", f"""
WITH r AS (SELECT * FROM {_RL} r),
a AS (SELECT count(*) AS total_runs,
  arg_max(new_products, started_at) AS latest_new_products, arg_max(updated_products, started_at) AS latest_updated_products,
  arg_max(new_orders, started_at) AS latest_new_orders, arg_max(updated_orders, started_at) AS latest_updated_orders,
  CAST(coalesce(sum(new_products), 0) AS BIGINT) AS cum_new_products,
  CAST(coalesce(sum(updated_products), 0) AS BIGINT) AS cum_updated_products,
  CAST(coalesce(sum(new_orders), 0) AS BIGINT) AS cum_new_orders,
  CAST(coalesce(sum(updated_orders), 0) AS BIGINT) AS cum_updated_orders FROM r)
SELECT *,
  CAST((2 * cum_updated_products * 100 + (CASE WHEN cum_new_products <> 0 THEN cum_new_products ELSE 1 END))
       // (2 * (CASE WHEN cum_new_products <> 0 THEN cum_new_products ELSE 1 END)) AS DOUBLE) / 100.0
       AS products_update_ratio,
  CAST((2 * cum_updated_orders * 100 + (CASE WHEN cum_new_orders <> 0 THEN cum_new_orders ELSE 1 END))
       // (2 * (CASE WHEN cum_new_orders <> 0 THEN cum_new_orders ELSE 1 END)) AS DOUBLE) / 100.0
       AS orders_update_ratio
FROM a""")
def q_runlog_rollup(spark, d):
    return RL.rollup(V.run_log(spark, d))


@register("runlog_long", "O4", f"""
SELECT started_at, metric, CAST(value AS BIGINT) AS value FROM
 (SELECT started_at, new_products, updated_products, new_orders, updated_orders FROM {_RL} r)
UNPIVOT (value FOR metric IN (new_products, updated_products, new_orders, updated_orders))""")
def q_runlog_long(spark, d):
    return RL.melt(V.run_log(spark, d))


@register("runlog_cumulative", "W5 O1", f"""
SELECT started_at,
""" + ",\n".join(f"  CAST(sum({m}) OVER (ORDER BY started_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
                 f" AS BIGINT) AS cum_{m}" for m in RL.METRICS) + f"""
FROM {_RL} r""")
def q_runlog_cumulative(spark, d):
    return RL.cumulative(V.run_log(spark, d))


@register("runlog_describe", "A22 (run log)", _describe_sql(V.RUN_LOG_SQL, RL.METRICS))
def q_runlog_describe(spark, d):
    return K.describe(V.run_log(spark, d), RL.METRICS).withColumn("std", F.round("std", 6))


# ---------------------------------------------------------------------------
# Q1-Q7 quality and contracts
# ---------------------------------------------------------------------------

from ..operators import quality as QA  # noqa: E402

# Fixed EDA requirement list of the international dataset (Ship_Date is absent
# from the extract, so it must be reported as not present).
ECOMMERCE_REQUIRED = ["Sales", "Gender", "Product_Category", "Order_Date", "Ship_Date"]


def _na_select(cols: list[str]) -> str:
    return ", ".join(f'CASE WHEN "{c}" IN ({C.NA_SQL_LIST}) THEN NULL ELSE "{c}" END AS "{c}"' for c in cols)


_ECOM_PRESENT = ["Sales", "Gender", "Product_Category", "Order_Date"]


@register("required_columns", "Q2",
          f"WITH e AS (SELECT {_na_select(_ECOM_PRESENT)} FROM ({DV.ECOMMERCE_SQL}) x) "
          + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", true AS present, "
              f"CAST(count(\"{c}\") AS DOUBLE) / CAST(count(*) AS DOUBLE) AS non_null_ratio FROM e"
              for c in _ECOM_PRESENT)
          + " UNION ALL SELECT 'Ship_Date', false, CAST(NULL AS DOUBLE)")
def q_required_columns(spark, d):
    return QA.completeness(C.with_na_tokens(DV.ecommerce(spark, d)), ECOMMERCE_REQUIRED)


@register("required_columns_by_batch", "Q2 (per batch)", f"""
WITH e AS (SELECT financial_status, total_discount, customer_email_hash, source_order_number
           FROM ({R.SHOPIFY_ORDERS_SQL}) x)
""" + " UNION ALL ".join(
    f"SELECT financial_status, '{c}' AS \"column\", true AS present, "
    f"CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS non_null_ratio FROM e GROUP BY financial_status"
    for c in ["total_discount", "customer_email_hash", "source_order_number"]))
def q_required_columns_by_batch(spark, d):
    orders = N.normalize_shopify_orders(R.shopify_orders_raw(spark, d), N.batch_stamp(R.STAMP))
    return QA.completeness(orders, ["total_discount", "customer_email_hash", "source_order_number"],
                           batch_col="financial_status")


@register("feature_presence", "Q3", f"""
SELECT 'price_num' AS "column", true AS present, CAST(count(price_amount) AS DOUBLE) / count(*) AS non_null_ratio FROM ({V.PRODUCTS_SQL}) p
UNION ALL SELECT 'source_freq', true, CAST(count(source) AS DOUBLE) / count(*) FROM ({V.PRODUCTS_SQL}) p
UNION ALL SELECT 'order_value_num', true, CAST(count(total_price) AS DOUBLE) / count(*) FROM {O} o""")
def q_feature_presence(spark, d):
    prod = QA.completeness(FE.enrich_products(V.products(spark, d)), ["price_num", "source_freq"])
    ords = QA.completeness(FE.enrich_orders(V.orders(spark, d)), ["order_value_num"])
    return prod.unionByName(ords)


# Fixed contract for unified orders: keys, hash format, order-number format,
# status enum, minimum order value.
ORDER_CONTRACT = [
    QA.Rule("order_id_required", "order_id", "required"),
    QA.Rule("email_hash_pattern", "customer_email_hash", "pattern", "^[0-9a-f]{64}$"),
    QA.Rule("order_number_pattern", "source_order_number", "pattern", "^[0-9]+$"),
    QA.Rule("status_enum", "financial_status", "enum", ("F", "O")),
    QA.Rule("total_minimum", "total_price", "minimum", 1000.0),
    QA.Rule("skus_type", "line_items_skus", "type", "bigint"),
]


@register("contract_violations", "Q4", f"""
WITH o AS ({R.SHOPIFY_ORDERS_SQL}),
v AS (
  SELECT 'order_id_required' AS rule, count(*) FILTER (WHERE order_id IS NULL) AS violations FROM o
  UNION ALL SELECT 'email_hash_pattern', count(*) FILTER (WHERE NOT regexp_matches(customer_email_hash, '^[0-9a-f]{{64}}$')) FROM o
  UNION ALL SELECT 'order_number_pattern', count(*) FILTER (WHERE NOT regexp_matches(source_order_number, '^[0-9]+$')) FROM o
  UNION ALL SELECT 'status_enum', count(*) FILTER (WHERE financial_status NOT IN ('F', 'O')) FROM o
  UNION ALL SELECT 'total_minimum', count(*) FILTER (WHERE total_price < 1000.0) FROM o
  UNION ALL SELECT 'skus_type', count(*) FILTER (WHERE line_items_skus IS NOT NULL
                                                  AND TRY_CAST(line_items_skus AS BIGINT) IS NULL) FROM o)
SELECT rule, violations FROM v WHERE violations > 0""")
def q_contract_violations(spark, d):
    orders = N.normalize_shopify_orders(R.shopify_orders_raw(spark, d), N.batch_stamp(R.STAMP))
    return QA.violation_counts(orders, ORDER_CONTRACT)


def _doc_manifest(spark, d):
    docs = V.table(spark, d, "documents")
    labels = V.table(spark, d, "labels")
    path = F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    # every 13th listed file has gone, every 11th has other contents than listed
    gone, changed = F.col("doc_id") % 13 == 0, F.col("doc_id") % 11 == 0
    listed = labels.join(docs, "doc_id", "left").select(
        F.concat(F.when(gone, "archive/").otherwise("documents/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.col("n_chars").alias("size_bytes"),
        F.sha2(F.concat(F.col("text"), F.when(changed, "?").otherwise("")), 256).alias("sha256"))
    actual = docs.select(path.alias("path"), F.octet_length("text").cast("bigint").alias("size_bytes"),
                         F.sha2(F.col("text"), 256).alias("sha256"))
    return QA.manifest_check(listed, actual)


@register("manifest_integrity", "Q5 Q7 S9", """
WITH listed AS (SELECT CASE WHEN l.doc_id % 13 = 0 THEN 'archive/' ELSE 'documents/' END || CAST(l.doc_id AS VARCHAR) || '.txt' AS path,
                       d.n_chars AS listed_size,
                       sha256(CASE WHEN l.doc_id % 11 = 0 THEN d.text || '?' ELSE d.text END) AS listed_sha256
                FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id),
actual AS (SELECT 'documents/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, CAST(octet_length(encode(text)) AS BIGINT)
                  AS actual_size, sha256(text) AS actual_sha256 FROM documents),
j AS (SELECT coalesce(l.path, a.path) AS path, l.path IS NOT NULL AS is_listed, a.path IS NOT NULL AS is_actual,
             listed_size, actual_size, listed_sha256, actual_sha256 FROM listed l FULL OUTER JOIN actual a ON l.path = a.path)
SELECT CASE WHEN NOT is_actual THEN 'missing' WHEN NOT is_listed THEN 'unexpected'
            WHEN listed_sha256 IS NOT NULL AND listed_sha256 <> actual_sha256 THEN 'hash_mismatch'
            WHEN listed_size IS NOT NULL AND listed_size <> actual_size THEN 'size_mismatch' ELSE 'ok' END AS status,
       count(*) AS files
FROM j GROUP BY 1""")
def q_manifest_integrity(spark, d):
    return _doc_manifest(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


_KEY_PROFILE_SQL = """
SELECT batch, key, CASE json_type(value) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID'
         ELSE json_type(value) END AS type, count(*) AS records
FROM (SELECT batch, key, json_extract(props, '$."' || key || '"') AS value
      FROM (SELECT batch, props, unnest(json_keys(props)) AS key FROM ({src}) s) k) v
GROUP BY ALL"""

# The feed as it drifts: a key that comes and goes (weekends) and one that changes its type (odd days).
_DRIFTING_SQL = """
SELECT CAST(ts AS DATE) AS batch, left(props, length(props) - 1)
         || CASE WHEN isodow(ts) >= 6 THEN ', "weekend": true' ELSE '' END
         || CASE WHEN day(ts) % 2 = 1 THEN ', "shift": "late"' ELSE ', "shift": 1' END || '}' AS props FROM events"""


def _drifting_events(spark, d):
    ev = V.table(spark, d, "events")
    weekend = F.when(F.weekday("ts") >= 5, ', "weekend": true').otherwise("")
    shift = F.when(F.dayofmonth("ts") % 2 == 1, ', "shift": "late"').otherwise(', "shift": 1')
    body = F.expr("left(props, length(props) - 1)")
    return ev.select(F.to_date("ts").alias("day"), F.concat(body, weekend, shift, F.lit("}")).alias("props"))


@register("schema_drift_events", "Q1", f"""
WITH prof AS (SELECT DISTINCT batch, key, type FROM ({_KEY_PROFILE_SQL.format(src=_DRIFTING_SQL)}) p),
seqs AS (SELECT batch, row_number() OVER (ORDER BY batch) AS seq FROM (SELECT DISTINCT batch FROM prof) b),
cur AS (SELECT seq, key, type FROM prof JOIN seqs USING (batch)),
both_ AS (SELECT coalesce(c.seq, p.seq + 1) AS seq, coalesce(c.key, p.key) AS key, p.type AS old_type, c.type AS new_type
          FROM cur c FULL OUTER JOIN cur p ON c.key = p.key AND c.seq = p.seq + 1)
SELECT batch, key, CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'retyped' END AS change,
       old_type, new_type
FROM both_ JOIN seqs USING (seq) WHERE old_type IS DISTINCT FROM new_type""")
def q_schema_drift_events(spark, d):
    return QA.json_schema_drift(_drifting_events(spark, d), "day", "props")


@register("json_key_profile_events", "Q1", _KEY_PROFILE_SQL.format(src="SELECT CAST(ts AS DATE) AS batch, props FROM events"))
def q_json_key_profile_events(spark, d):
    ev = V.table(spark, d, "events")
    return QA.json_key_profile(ev.withColumn("day", F.to_date("ts")), "day", "props")


@register("content_hash_events", "N14", """
WITH keys AS (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events),
canon AS (SELECT event_id, sha256('{' || string_agg('"' || key || '":' || CAST(json_extract(props, '$."' || key || '"') AS VARCHAR), ',' ORDER BY key) || '}') AS h
          FROM keys GROUP BY event_id)
SELECT sha256(concat_ws('|', CAST(count(*) AS VARCHAR),
         CAST(sum(CAST('0x' || h[1:15] AS HUGEINT)) AS VARCHAR), CAST(sum(CAST('0x' || h[16:30] AS HUGEINT)) AS VARCHAR),
         CAST(sum(CAST('0x' || h[31:45] AS HUGEINT)) AS VARCHAR), CAST(sum(CAST('0x' || h[46:60] AS HUGEINT)) AS VARCHAR),
         CAST(sum(CAST('0x' || h[61:64] AS HUGEINT)) AS VARCHAR))) AS batch_hash, count(*) AS records FROM canon""")
def q_content_hash_events(spark, d):
    from ..functions import exprs as X
    ev = V.table(spark, d, "events").select(X.canonical_json_hash("props").alias("h"))
    return ev.agg(X.multiset_digest("h").alias("batch_hash"), F.count(F.lit(1)).alias("records"))


# Language guard re-aimed at the supplied multilingual corpus: function words
# of German, French and Spanish flagged wherever they occur (the reference's
# own Portuguese list is run as well, see term_scan_reference_terms).
GUARD_TERMS = [r"\bder\b", r"\bund\b", r"\bdie\b", r"\bles\b", r"\bdes\b", r"\bpour\b", r"\bque\b", r"\bmit\b"]


def _term_counts_sql(terms: list[str]) -> str:
    bodies = [QA._strip_bounds(t) for t in terms]
    cases = " UNION ALL ".join(f"SELECT '{t}' AS term, '{b}' AS body" for t, b in zip(terms, bodies))
    return f"""
WITH toks AS (SELECT doc_id, lower(unnest(regexp_split_to_array(text, '[^\\p{{L}}\\p{{N}}_]+'))) AS tok FROM documents),
terms AS ({cases})
SELECT doc_id, term, count(*) AS n FROM toks JOIN terms ON regexp_full_match(tok, body) GROUP BY doc_id, term"""


@register("term_counts", "Q6", _term_counts_sql(GUARD_TERMS))
def q_term_counts(spark, d):
    return QA.term_counts(V.table(spark, d, "documents"), "text", "doc_id", GUARD_TERMS)


# Texts fall apart into words and what stands between them; running lengths give each word's place.
_TERM_SCAN_SQL = """
WITH src AS ({src}),
pieces AS (SELECT doc_id, unnest(parts) AS tok, unnest(range(len(parts))) AS i FROM
           (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') AS parts FROM src) s),
placed AS (SELECT *, coalesce(sum(length(tok)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos_
           FROM pieces),
terms AS ({terms}),
hits AS (SELECT doc_id, term, tok, pos_ FROM placed JOIN terms ON regexp_full_match(lower(tok), body))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos_) - 1 AS INTEGER) AS occurrence, term, tok AS match,
       replace(substr(text, greatest(pos_ - 20, 0) + 1, least(pos_, 20) + length(tok) + 20), chr(10), ' ') AS context
FROM hits JOIN src USING (doc_id)"""

_GUARD_TERMS_SQL = " UNION ALL ".join(f"SELECT '\\b{w}\\b' AS term, '{w}' AS body" for w in
                                      ("der", "und", "die", "les", "des", "pour", "que", "mit"))
_REFERENCE_TERMS_SQL = " UNION ALL ".join(f"SELECT '\\b{w}\\b' AS term, '{w}' AS body" for w in (
    "produto(s)?", "pedido(s)?", "preço", "categoria(s)?", "fonte(s)?", "execução", "criado", "atualizado"))


@register("term_scan", "Q6", _TERM_SCAN_SQL.format(src="SELECT doc_id, text FROM documents", terms=_GUARD_TERMS_SQL))
def q_term_scan(spark, d):
    return QA.term_matches(V.table(spark, d, "documents"), "text", "doc_id", GUARD_TERMS)


# The supplied texts have no Portuguese; every third gets a remark at its end and every fifth one at its start.
@register("term_scan_reference_terms", "Q6", _TERM_SCAN_SQL.format(terms=_REFERENCE_TERMS_SQL, src="""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Execução: Produtos e fonte. ' ELSE '' END || text
         || CASE WHEN doc_id % 3 = 0 THEN ' pedido criado; PREÇO (categorias)' ELSE '' END AS text FROM documents"""))
def q_term_scan_reference_terms(spark, d):
    start = F.when(F.col("doc_id") % 5 == 0, "Execução: Produtos e fonte. ").otherwise("")
    end = F.when(F.col("doc_id") % 3 == 0, " pedido criado; PREÇO (categorias)").otherwise("")
    docs = V.table(spark, d, "documents")
    return QA.term_matches(docs.withColumn("text", F.concat(start, "text", end)), "text", "doc_id")


# ---------------------------------------------------------------------------
# E3 report document (S11, A16, A19) and its contract check (Q4)
# ---------------------------------------------------------------------------

from . import report as RP  # noqa: E402


def _figures(spark, d):
    """One asset for each benchmark item."""
    return V.table(spark, d, "benchmark").select(
        F.concat(F.lit("figures/item_"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"),
        F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("size_bytes"))


def _report(spark, d):
    return RP.build_report(V.products(spark, d), V.orders(spark, d), V.run_log(spark, d),
                           providers=["part", "orders"], key_mode="pair", generated_at="2024-06-01T00:00:00Z",
                           figures=_figures(spark, d), expected_figures=["item_0.txt", "overview.txt"])


@register("report_document", "E3 S11 A16 A18 A19", None)
def q_report_document(spark, d):
    return _report(spark, d)


def _broken_reports(spark, d):
    """One report stub for each event day, with faults that depend on the day: what a consumer of many reports checks."""
    days = V.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    day = F.dayofmonth("day")
    none = F.array().cast("array<string>")
    figure = F.struct(F.concat(F.lit("f"), day.cast("string")).alias("name"), F.lit("figures/f").alias("path"),
                      F.when(day % 5 == 0, "not a digest").otherwise(F.sha2(F.col("day").cast("string"), 256)).alias("sha256"),
                      F.when(day % 6 == 0, 0).otherwise(F.col("n")).cast("bigint").alias("size_bytes"))
    no = F.lit(None)
    return days.select(
        F.when(day % 2 == 0, "1.0").otherwise("1.0.0").alias("schema_version"),
        F.when(day % 3 == 0, F.col("day").cast("string")).otherwise(F.concat(F.col("day").cast("string"), F.lit("T00:00:00Z"))).alias("generated_at_utc"),
        F.struct(none.alias("providers"), F.when(day % 7 == 0, "single").otherwise("pair").alias("dedup_key_mode"), no.cast("bigint").alias("seed"),
                 no.cast("bigint").alias("limit"), F.lit("none").alias("fake_mode"), F.lit(1).alias("debug")).alias("inputs"),
        F.struct(F.col("n").alias("products_total"), F.create_map(F.lit("a"), F.col("n")).alias("products_by_provider"),
                 no.cast("bigint").alias("products_new"), no.cast("bigint").alias("products_updated"), F.lit("many").alias("products_outliers_price"),
                 F.col("n").alias("orders_total"), F.create_map(F.lit("a"), F.col("n")).alias("orders_by_provider"), no.cast("bigint").alias("orders_outliers_total"),
                 no.cast("double").alias("aov_mean")).alias("kpis"),
        F.array(figure).alias("figures"),
        F.struct(F.when(day % 4 != 0, "fine").alias("summary"), F.lit("-").alias("details")).alias("narrative"),
        F.struct(F.col("n").alias("products_rows"), F.col("n").alias("orders_rows"), F.lit(True).alias("products_enriched"),
                 F.lit(True).alias("orders_enriched")).alias("data_availability"),
        F.struct(F.lit(1).alias("figure_count"), F.array(F.lit("f")).alias("figure_ids")).alias("integrity"),
        F.lit(1).alias("extra_part"))


@register("report_contract_violations", "Q4 (report contract)", """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d, day(ts) AS k FROM events),
v AS (SELECT 'schema_version_semver' AS rule, count(*) FILTER (WHERE k % 2 = 0) AS violations FROM days
  UNION ALL SELECT 'generated_at_date_time', count(*) FILTER (WHERE k % 3 = 0) FROM days
  UNION ALL SELECT 'dedup_key_mode_enum', count(*) FILTER (WHERE k % 7 = 0) FROM days
  UNION ALL SELECT 'null:narrative.summary', count(*) FILTER (WHERE k % 4 = 0) FROM days
  UNION ALL SELECT 'figure_sha256_pattern', count(*) FILTER (WHERE k % 5 = 0) FROM days
  UNION ALL SELECT 'figure_size_minimum', count(*) FILTER (WHERE k % 6 = 0) FROM days
  UNION ALL SELECT 'extra:extra_part', 1 UNION ALL SELECT 'extra:inputs.debug', 1
  UNION ALL SELECT 'missing:kpis.aov_median', 1 UNION ALL SELECT 'type:kpis.products_outliers_price', 1)
SELECT rule, violations FROM v WHERE violations > 0""")
def q_report_contract_violations(spark, d):
    return RP.report_contract_violations(_broken_reports(spark, d))


@register("latest_rolling_7d", "A16", f"""
WITH e AS ({_rolling_sql(EO)}),
s AS (SELECT CAST(created_at AS DATE) AS day, created_at FROM {EO} x)
SELECT arg_max(e.gmv_7d, s.created_at) FILTER (WHERE e.gmv_7d IS NOT NULL) AS gmv_7d,
       arg_max(e.orders_7d, s.created_at) FILTER (WHERE e.orders_7d IS NOT NULL) AS orders_7d,
       arg_max(e.aov_7d, s.created_at) FILTER (WHERE e.aov_7d IS NOT NULL) AS aov_7d
FROM s JOIN e ON s.day = e.day""")
def q_latest_rolling_7d(spark, d):
    return RP.latest_rolling(FE.enrich_orders(V.event_orders(spark, d)))


# ---------------------------------------------------------------------------
# A20 / A21 on extracts that really hold missing values and repeated rows
# ---------------------------------------------------------------------------

_ECOM_COLS = DV.EXTRACTS["E-commerce Dataset"][2]


@register("null_counts_extract", "A20", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM "
    f"(SELECT {_na_select(_ECOM_COLS)} FROM ({DV.ECOMMERCE_SQL}) x) e" for c in _ECOM_COLS))
def q_null_counts_extract(spark, d):
    return K.null_counts(C.with_na_tokens(DV.ecommerce(spark, d)))


@register("duplicate_rows_extract", "A21", f"""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(n) AS BIGINT) AS rows FROM
 (SELECT seller_id, seller_state, count(*) AS n FROM ({DV.BR_SELLERS_SQL}) s GROUP BY seller_id, seller_state) g""")
def q_duplicate_rows_extract(spark, d):
    return K.duplicate_rows(DV.br_sellers(spark, d))


# W2 per group on timestamped data: purchases and other valued events per type
_EVENTS_BY_TYPE_SQL = "SELECT event_type AS source, ts AS created_at, value AS total_price FROM events"


@register("events_rolling_7d_by_type", "W1 W2 W3 (partitioned, times of day)", f"""
WITH src AS (SELECT source, created_at, CAST(CAST(total_price AS VARCHAR) AS DECIMAL(38,12)) AS v FROM ({_EVENTS_BY_TYPE_SQL}) s
             WHERE created_at IS NOT NULL),
daily AS (SELECT source, CAST(created_at AS DATE) AS day, sum(v) AS gmv_dec, count(v) AS n_orders FROM src GROUP BY 1, 2),
spine AS (SELECT r.source, CAST(d AS DATE) AS day FROM (SELECT source, min(day) AS lo, max(day) AS hi FROM daily GROUP BY 1) r,
          generate_series(CAST(r.lo AS TIMESTAMP), CAST(r.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
filled AS (SELECT spine.source, spine.day, daily.gmv_dec, coalesce(daily.n_orders, 0) AS n_orders
           FROM spine LEFT JOIN daily ON spine.day = daily.day AND spine.source = daily.source),
rolled AS (SELECT source, day, gmv_dec, n_orders,
           sum(gmv_dec) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS g7,
           sum(n_orders) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS o7 FROM filled)
SELECT source, day, CAST(gmv_dec AS DOUBLE) AS gmv, CAST(n_orders AS BIGINT) AS n_orders, CAST(g7 AS DOUBLE) AS gmv_7d,
       CAST(o7 AS BIGINT) AS orders_7d,
       CASE WHEN o7 > 0 THEN CAST(g7 AS DOUBLE) / CAST(o7 AS DOUBLE) END AS aov_7d
FROM rolled""")
def q_events_rolling_7d_by_type(spark, d):
    ev = V.table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("ts").alias("created_at"),
                                             F.col("value").alias("total_price"))
    return FE.rolling_7d(ev, by=["source"])


# ---------------------------------------------------------------------------
# Landed runs that arrive one after another
# ---------------------------------------------------------------------------

@register("etl_successive_runs", "E1 S1 S2 M4 M6 M7 M9", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 2
            WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END::DOUBLE AS total_price
FROM orders""")
def q_etl_successive_runs(spark, d):
    """All orders land, then a third of them dearer by 1, then a fifth dearer by 2; the ETL runs after the first landing, after both others
    together, and once with nothing new. The table holds the last version of each order."""
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..sources import landing as L
    from ..sources import tables as TB
    from .. import schemas as SC
    from . import etl
    root = f"{ensure_checkpoint_dir(spark)}/successive-{uuid.uuid4().hex}"
    landing, tables, log = f"{root}/landing", f"{root}/tables", f"{root}/runs"
    orders = V.table(spark, d, "orders")

    def land(run: str, part: DataFrame, more: int) -> None:
        price = F.col("o_totalprice").cast("decimal(18,2)") + more
        L.write_raw(part.select(F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), price.cast("string").alias("total_price"))).alias("json")),
                    landing, "shopify", "orders", run)

    land("run_c", orders, 0)
    etl.run_pipeline(spark, landing, tables, log, key_mode="pair")
    land("run_b", orders.where("o_orderkey % 3 = 0"), 1)
    land("run_a", orders.where("o_orderkey % 5 = 0"), 2)
    etl.run_pipeline(spark, landing, tables, log, key_mode="pair")
    etl.run_pipeline(spark, landing, tables, log, key_mode="pair")
    return TB.read_table(spark, tables, "orders", SC.ORDERS).select("order_id", "total_price")


# tables kept up to date batch by batch; registered on import
from . import table_queries  # noqa: E402, F401
