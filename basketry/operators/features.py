"""Feature engineering and windowed metrics (F-1..F-8, W1..W7, J4, J5, A25, A26).

Windows without a partition key only ever run over day-level series (one row
per calendar day), never over raw rows, so a single task handles them at any
data volume. Per-key frequencies are computed as aggregates joined back
(AQE broadcasts the small side after measuring it) rather than as
``count() over (partition by key)``, which would pull a hot key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.quantiles import quantiles
from .kpis import DATE_CANDIDATES, PRICE_CANDIDATES, QCUT_PROBS, VALUE_CANDIDATES, resolve_column, scalar_row


# --- W1-W3 calendar spine + rolling 7 days -----------------------------------

def rolling_7d(orders: DataFrame, date_col: str | None = None, value_col: str | None = None,
               by: Sequence[str] = ()) -> DataFrame:
    """Daily GMV (NULL on a day without values), count of valued orders (0 on
    gap days), and 7-calendar-day rolling GMV / orders / AOV per day of the
    dense spine between the first and the last order day (per ``by`` group)."""
    date_col = date_col or resolve_column(orders, DATE_CANDIDATES)
    value_col = value_col or resolve_column(orders, VALUE_CANDIDATES)
    by = list(by)
    v = X.numeric_col(orders, value_col)
    dated = orders.where(F.col(date_col).isNotNull())
    daily = dated.groupBy(*by, F.to_date(date_col).alias("day")).agg(
        X.exact_sum(v).alias("gmv_dec"),
        F.count(v).alias("n_orders"))
    span = daily.groupBy(*by).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = span.select(*by, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    filled = spine.join(daily, on=[*by, "day"], how="left")
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(-6, 0) if by else \
        Window.orderBy("day").rowsBetween(-6, 0)
    gmv_7d = F.sum("gmv_dec").over(w)
    orders_7d = F.sum(F.coalesce(F.col("n_orders"), F.lit(0))).over(w)
    out = filled.select(
        *by, "day",
        F.col("gmv_dec").cast("double").alias("gmv"),
        F.coalesce(F.col("n_orders"), F.lit(0)).alias("n_orders"),
        gmv_7d.cast("double").alias("gmv_7d"),
        orders_7d.alias("orders_7d"),
    )
    return out.withColumn("aov_7d", F.when(F.col("orders_7d") > 0,
                                           F.col("gmv_7d") / F.col("orders_7d").cast("double")))


# --- W4 recency -----------------------------------------------------------------

def recency(orders: DataFrame, date_col: str | None = None) -> DataFrame:
    """Fractional days between each order and the latest order."""
    date_col = date_col or resolve_column(orders, DATE_CANDIDATES)
    latest = scalar_row(orders.agg(F.max(date_col).alias("mx")))["mx"]
    return orders.withColumn("recency_days", X.fractional_days(F.col(date_col), latest))


# --- F-5..F-7 enriched orders (J5 with the day-level join fix) --------------------

def enrich_orders(orders: DataFrame, date_col: str | None = None, value_col: str | None = None) -> DataFrame:
    date_col = date_col or resolve_column(orders, DATE_CANDIDATES)
    value_col = value_col or resolve_column(orders, VALUE_CANDIDATES)
    roll = rolling_7d(orders, date_col, value_col).select("day", "gmv_7d", "orders_7d", "aov_7d")
    enriched = orders.withColumn("order_value_num", X.numeric_col(orders, value_col)) \
        .withColumn("_day", F.to_date(date_col))
    # one row per calendar day between the first and the last order: small at any number of orders
    enriched = enriched.join(F.broadcast(roll), enriched["_day"] == roll["day"], "left").drop("_day", "day")
    return recency(enriched, date_col)


# --- F-1..F-4 enriched products --------------------------------------------------

def qcut_edges(q: DataFrame) -> DataFrame:
    """Quintile edges with duplicates dropped (``qcut(q=5, duplicates='drop')``) from a row with QCUT_PROBS."""
    return q.select(F.array_distinct(F.array(*[F.col(k) for k in QCUT_PROBS])).alias("edges"))


def qcut_index(value, edges) -> F.Column:
    """Right-closed bucket index (lowest edge included); NULL with < 2 edges."""
    inner = F.slice(edges, 2, F.size(edges) - 2)
    idx = F.size(F.filter(inner, lambda e: e < value))
    return F.when(value.isNotNull() & (F.size(edges) >= 2), idx)


def enrich_products(products: DataFrame, price_col: str | None = None, q: DataFrame | None = None) -> DataFrame:
    """``q``: the row of ``kpis.price_quantiles``, if it is there already."""
    price_col = price_col or resolve_column(products, PRICE_CANDIDATES)
    df = products.withColumn("price_num", X.numeric_col(products, price_col))
    any_positive = scalar_row(df.agg(F.max(F.col("price_num") > 0).alias("pos")))["pos"]
    df = df.withColumn("price_log", F.when(F.coalesce(any_positive, F.lit(False)), F.log1p("price_num")))
    # the edges array is materialised as a column first: subqueries may not
    # appear inside the higher-order function that locates the bucket
    q = q if q is not None else quantiles(df, "price_num", QCUT_PROBS)
    df = df.withColumn("_edges", scalar_row(qcut_edges(q))["edges"])
    edges = F.col("_edges")
    b = qcut_index(F.col("price_num"), edges)
    df = df.withColumn("price_bucket", b) \
        .withColumn("price_bucket_lo", F.when(b.isNotNull(), F.element_at(edges, b + 1))) \
        .withColumn("price_bucket_hi", F.when(b.isNotNull(), F.element_at(edges, b + 2))) \
        .drop("_edges")
    src = products.where(F.col("source").isNotNull()).groupBy("source") \
        .agg(F.count(F.lit(1)).alias("source_freq"))
    df = df.join(src, "source", "left")
    cat_key = F.coalesce(F.col("category"), F.lit("<null>"))
    cat = products.groupBy(cat_key.alias("_cat")).agg(F.count(F.lit(1)).alias("category_freq"))
    df = df.withColumn("_cat", cat_key).join(cat, "_cat", "left").drop("_cat")
    return df


# --- A25 / A26 equal-width histograms ----------------------------------------------

def histogram(df: DataFrame, value, bins: int) -> DataFrame:
    """Dense equal-width histogram over [min, max] with the last bin closed
    (numpy.histogram layout; an all-equal column gets the range v +/- 0.5).
    Returns bin (1..bins), bin_lo, bin_hi, count."""
    v = X.col_(value).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    rng = vals.agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    rng = rng.select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - F.lit(0.5)).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + F.lit(0.5)).otherwise(F.col("mx")).alias("hi"))
    r = scalar_row(rng)
    lo, hi = r["lo"], r["hi"]
    n = F.lit(bins).cast("double")
    idx = F.least(F.floor(n * (F.col("v") - lo) / (hi - lo)) + F.lit(1), F.lit(bins)).cast("bigint")
    counts = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    step = (hi - lo) / n
    # no value at all: no bins (the range is undefined)
    axis = rng.where(F.col("lo").isNotNull()) \
        .select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin"))
    axis = axis.select(
        "bin",
        (lo + (F.col("bin") - F.lit(1)).cast("double") * step).alias("bin_lo"),
        F.when(F.col("bin") == F.lit(bins), hi).otherwise(lo + F.col("bin").cast("double") * step).alias("bin_hi"))
    return axis.join(counts, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def log10_histogram(df: DataFrame, value, bins: int = 20) -> DataFrame:
    """Histogram of log10 of the strictly positive values."""
    v = X.col_(value).cast("double")
    pos = df.select(v.alias("v")).where(F.col("v") > 0)
    return histogram(pos, F.log10("v"), bins)
