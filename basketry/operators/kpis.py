"""KPI and profiling aggregations (products, orders, generic tables).

Every function takes DataFrames in the unified products / orders schema (or
any table for the generic profilers) and returns a small DataFrame. Scalars
computed from a whole table (fences, extrema, quantile edges) are attached as
scalar subqueries: Spark runs them once and ships the value to every task,
so no table is ever collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.quantiles import quantiles

# Fixed column-name candidates, tried in this order.
DATE_CANDIDATES = ["created_at", "order_date", "date", "timestamp"]
VALUE_CANDIDATES = ["total_price", "total", "amount", "grand_total", "price"]
PRICE_CANDIDATES = ["price", "price_amount"]
RUNTIME_CANDIDATES = ["timestamp", "started_at", "run_time", "time"]


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate present in ``df`` (plan-time decision, no data touched)."""
    return next((c for c in candidates if c in df.columns), None)


def columns_like(df: DataFrame, prefixes: Sequence[str] = (), suffixes: Sequence[str] = (),
                 exact: Sequence[str] = ()) -> list[str]:
    """Columns selected by prefix / suffix / exact name (plan-time helper)."""
    return [c for c in df.columns if c.startswith(tuple(prefixes)) or c.endswith(tuple(suffixes)) or c in exact]


def attach(base: DataFrame, *one_row_frames: DataFrame) -> DataFrame:
    """Append the columns of one-row frames to ``base`` as scalar subqueries."""
    cols: list[Column] = [F.col(c) for c in base.columns]
    for fr in one_row_frames:
        s = fr.select(F.struct(*[F.col(c) for c in fr.columns]).alias("s")).scalar()
        cols += [s[c].alias(c) for c in fr.columns]
    return base.select(*cols)


def scalar_row(df: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery."""
    return df.select(F.struct(*[F.col(c) for c in df.columns])).scalar()


# All quantiles that the product measures ask of the price; one ranking of the column serves them together.
# pandas steps qcut's edges by 0.2, so the fourth lies a rounding error above 3/5; with ties it can differ from the third.
QCUT_PROBS = {f"e{i}": i * 0.2 for i in range(6)}
PRICE_PROBS = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9} | QCUT_PROBS


def price_quantiles(products: DataFrame, price_col: str | None = None) -> DataFrame:
    """One row: n and the quantiles of PRICE_PROBS. The row is computed at once: several
    measures use each number several times, and their plans stay small."""
    p = X.numeric_col(products, price_col or resolve_column(products, PRICE_CANDIDATES))
    q = quantiles(products.select(p.alias("v")), "v", PRICE_PROBS)
    return products.sparkSession.createDataFrame([tuple(q.first())], q.schema)


# --- A1-A3 product summary ---------------------------------------------------

def product_summary(products: DataFrame, price_col: str | None = None, q: DataFrame | None = None) -> DataFrame:
    """``q``: the row of ``price_quantiles``, if it is there already (as in the functions below)."""
    price_col = price_col or resolve_column(products, PRICE_CANDIDATES)
    p = X.numeric_col(products, price_col)
    base = products.agg(
        F.count(F.lit(1)).alias("count"),
        F.countDistinct("source").alias("distinct_sources"),
        F.min(p).alias("price_min"),
        F.max(p).alias("price_max"),
        X.exact_mean(p).alias("price_mean"),
    )
    cats = products.where(F.col("category").isNotNull()).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    # mode, ties broken by the smaller category so the answer is deterministic
    top = cats.agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("top_category"))
    q = q if q is not None else quantiles(products.select(p.alias("p")), "p", {"q50": 0.5, "q90": 0.9})
    out = attach(base, top, q.select(F.col("q50").alias("price_median"), F.col("q90").alias("price_p90")))
    return out.select("count", "distinct_sources", "top_category", "price_min", "price_median",
                      "price_mean", "price_p90", "price_max")


# --- A5 / A6 IQR outliers -----------------------------------------------------

def _fences(df: DataFrame, value: Column, q: DataFrame | None) -> Column:
    q = q if q is not None else quantiles(df.select(value.alias("v")), "v", {"q25": 0.25, "q75": 0.75})
    return scalar_row(q.select(F.col("q25").alias("q1"), F.col("q75").alias("q3"), "n"))


def outliers_two_sided(products: DataFrame, price_col: str | None = None, q: DataFrame | None = None) -> DataFrame:
    """Report rule: >5 values needed, IQR of 0 replaced by 1, both fences;
    the ratio's denominator counts every row (NULL prices included)."""
    price_col = price_col or resolve_column(products, PRICE_CANDIDATES)
    p = X.numeric_col(products, price_col)
    f = _fences(products, p, q)
    raw_iqr = f["q3"] - f["q1"]
    iqr = F.when(raw_iqr != 0, raw_iqr).otherwise(F.lit(1.0))
    upper = f["q3"] + F.lit(1.5) * iqr
    lower = f["q1"] - F.lit(1.5) * iqr
    flagged = products.select(p.alias("p")).select(
        "p", ((F.col("p") > upper) | (F.col("p") < lower)).alias("out"))
    gated = F.coalesce(f["n"], F.lit(0)) > 5
    agg = flagged.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("out"), True)).alias("k"))
    return agg.select(
        F.when(gated, F.col("k").cast("double") / F.col("rows").cast("double")).alias("outlier_price_ratio"),
        F.when(gated, F.col("k")).alias("outlier_count"),
        F.when(gated, iqr).alias("iqr"),
        F.when(gated, lower).alias("fence_lower"),
        F.when(gated, upper).alias("fence_upper"),
    )


def outliers_upper(products: DataFrame, price_col: str | None = None, q: DataFrame | None = None) -> DataFrame:
    """Notebook rule: upper fence only, raw IQR, ratio rounded to 4 places."""
    price_col = price_col or resolve_column(products, PRICE_CANDIDATES)
    p = X.numeric_col(products, price_col)
    f = _fences(products, p, q)
    upper = f["q3"] + F.lit(1.5) * (f["q3"] - f["q1"])
    flagged = products.select(p.alias("p")).select((F.col("p") > upper).alias("out"))
    agg = flagged.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("out"), True)).alias("k"))
    gated = F.coalesce(f["n"], F.lit(0)) > 0
    return agg.select(F.when(gated, X.round_ratio(F.col("k"), F.col("rows"), 4)).alias("price_outlier_ratio"),
                      F.when(gated, upper).alias("fence_upper"))


# --- A4 duplicate logical keys ------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("source", "source_id")) -> DataFrame:
    keep = None
    for k in keys:
        c = F.col(k).isNotNull()
        keep = c if keep is None else keep & c
    per_key = df.where(keep).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    agg = per_key.agg(F.count(F.lit(1)).alias("distinct_keys"),
                      F.count(F.when(F.col("n") > 1, True)).alias("duplicate_key_pairs"))
    return agg.select(
        "duplicate_key_pairs", "distinct_keys",
        F.when(F.col("distinct_keys") > 0,
               F.col("duplicate_key_pairs").cast("double") / F.col("distinct_keys").cast("double"))
        .otherwise(F.lit(0.0)).alias("duplicate_key_ratio"),
        X.round_ratio(F.col("duplicate_key_pairs"), F.col("distinct_keys"), 4).alias("duplicate_key_ratio_r4"),
    )


# --- A7 product quality summary ----------------------------------------------

def product_quality(products: DataFrame, price_col: str | None = None) -> DataFrame:
    price_col = price_col or resolve_column(products, PRICE_CANDIDATES)
    p = X.numeric_col(products, price_col)
    base = products.agg(F.count(p).alias("price_non_null"), F.min(p).alias("price_min"), F.max(p).alias("price_max"))
    row = price_quantiles(products, price_col)
    q = row.select(F.col("q50").alias("price_p50"), F.col("q90").alias("price_p90"))
    up = outliers_upper(products, price_col, row).select("price_outlier_ratio")
    dk = duplicate_keys(products).select("duplicate_key_pairs",
                                         F.col("duplicate_key_ratio_r4").alias("duplicate_key_ratio"))
    out = attach(base, q, up, dk)
    return out.select("price_non_null", "price_min", "price_p50", "price_p90", "price_max",
                      "price_outlier_ratio", "duplicate_key_pairs", "duplicate_key_ratio")


# --- A8 / A9 / A23 distributions ---------------------------------------------

def top_values(df: DataFrame, column: str, k: int = 10, null_label: str | None = None,
               name: str | None = None) -> DataFrame:
    """Top-k values by count with their share of *all* rows (NULLs count in the
    denominator; they are listed only when ``null_label`` is given)."""
    name = name or column
    key = F.coalesce(F.col(column), F.lit(null_label)) if null_label is not None else F.col(column)
    counts = df.select(key.alias(name)).where(F.col(name).isNotNull()).groupBy(name) \
        .agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    tot = scalar_row(total)["total"]
    ranked = counts.orderBy(F.col("count").desc(), F.col(name).asc()).limit(k)
    return ranked.select(name, "count", (F.col("count").cast("double") / tot.cast("double")).alias("ratio"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every value (NULLs excluded), e.g. order status."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


# --- A10 / A11 order summary -------------------------------------------------

def order_summary(orders: DataFrame, date_col: str | None = None, value_col: str | None = None) -> DataFrame:
    date_col = date_col or resolve_column(orders, DATE_CANDIDATES)
    value_col = value_col or resolve_column(orders, VALUE_CANDIDATES)
    v = X.numeric_col(orders, value_col)
    ts = F.col(date_col)
    base = orders.agg(
        F.count(F.lit(1)).alias("count"),
        X.floor_days(F.min(ts), F.max(ts)).alias("timespan_days"),
        X.money_sum(v).alias("gmv_total"),
        X.exact_mean(v).alias("gmv_mean"),
    )
    med = quantiles(orders.select(v.alias("v")), "v", {"gmv_median": 0.5}).drop("n")
    return attach(base, med)


# --- A12 / A13 / A14 daily metrics ---------------------------------------------

def daily_metrics(orders: DataFrame, date_col: str | None = None, value_col: str | None = None) -> DataFrame:
    """Per calendar day with at least one dated order: GMV (exact sum; 0 when
    all values are missing), order count, AOV = GMV / count."""
    date_col = date_col or resolve_column(orders, DATE_CANDIDATES)
    value_col = value_col or resolve_column(orders, VALUE_CANDIDATES)
    v = X.numeric_col(orders, value_col)
    d = orders.where(F.col(date_col).isNotNull()).groupBy(F.to_date(date_col).alias("day")).agg(
        F.coalesce(X.money_sum(v), F.lit(0.0)).alias("gmv"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    return d.select("day", "gmv", "n_orders", (F.col("gmv") / F.col("n_orders").cast("double")).alias("aov"))


def daily_summary(orders: DataFrame, date_col: str | None = None, value_col: str | None = None) -> DataFrame:
    """gmv_total, orders_total, days_span (calendar dates) and aov_mean = mean of
    the daily AOVs. The mean folds the day series in date order; the series has
    one row per calendar day, so it stays small at any data volume."""
    daily = daily_metrics(orders, date_col, value_col)
    series = F.array_sort(F.collect_list(F.struct("day", "aov")))
    return daily.agg(
        X.money_sum("gmv").alias("gmv_total"),
        F.sum("n_orders").alias("orders_total"),
        F.datediff(F.max("day"), F.min("day")).cast("bigint").alias("days_span"),
        F.try_divide(F.aggregate(series, F.lit(0.0), lambda acc, x: acc + x["aov"]), F.count("aov").cast("double"))
        .alias("aov_mean"),
    )


# --- A15 bucket distribution ---------------------------------------------------

def bucket_distribution(enriched: DataFrame, bucket_col: str = "price_bucket") -> DataFrame:
    """Count and share of every bucket, the NULL bucket included."""
    counts = enriched.groupBy(bucket_col).agg(F.count(F.lit(1)).alias("count"))
    tot = scalar_row(enriched.agg(F.count(F.lit(1)).alias("t")))["t"]
    return counts.select(bucket_col, "count", (F.col("count").cast("double") / tot.cast("double")).alias("ratio"))


# --- A18 availability / A19 KPI rollup ----------------------------------------

def availability(tables: dict[str, DataFrame], enriched: dict[str, bool] | None = None) -> DataFrame:
    enriched = enriched or {}
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(bool(enriched.get(name, False))).alias("enriched"))
        for name, df in tables.items()]
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr)
    return out


def provider_counts_json(df: DataFrame) -> Column:
    """Every source -> count as a JSON object with sorted keys (scalar subquery; one entry per provider)."""
    counts = value_counts(df, "source")
    js = counts.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "count")))))
                    .alias("j"))
    return scalar_row(js)["j"]


def kpi_rollup(products: DataFrame, orders: DataFrame) -> DataFrame:
    """The ten required KPIs of the report contract as one row."""
    prod = products.agg(F.count(F.lit(1)).alias("products_total"))
    ords = orders.agg(F.count(F.lit(1)).alias("orders_total"))
    outl = outliers_two_sided(products).select(F.col("outlier_count").alias("products_outliers_price"))
    gmv = order_summary(orders).select(F.col("gmv_mean").alias("aov_mean"), F.col("gmv_median").alias("aov_median"))
    out = attach(prod, ords, outl, gmv)
    return out.select(
        "products_total",
        provider_counts_json(products).alias("products_by_provider"),
        F.lit(None).cast("bigint").alias("products_new"),
        F.lit(None).cast("bigint").alias("products_updated"),
        "products_outliers_price",
        "orders_total",
        provider_counts_json(orders).alias("orders_by_provider"),
        F.lit(None).cast("bigint").alias("orders_outliers_total"),
        "aov_mean", "aov_median")


# --- A20-A24 generic profilers -------------------------------------------------

def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column, long format (column, null_count)."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), True)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "null_count")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group (NULLs compare equal).

    Rows are grouped by a sha-256 of their JSON form, so wide text rows are not
    shuffled, only 32-byte digests; partial aggregation collapses hot rows."""
    columns = list(columns or df.columns)
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)
    per = df.select(digest.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum(F.col("n") - F.lit(1)).alias("duplicate_rows"),
                   F.sum("n").alias("rows"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """pandas ``describe()`` for numeric columns, long format, exact quartiles.

    Moments are aggregated in one pass over the wide table (no unpivot of
    the data); only the quartiles work on the long (column, value) form,
    grouped by column."""
    cols = list(columns)
    vals = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), X.exact_mean(v).alias("mean"),
                             X.stddev(v).alias("std"), F.min(v).alias("min"),
                             F.max(v).alias("max")).alias(f"_{i}"))
    wide = vals.agg(*aggs)
    stats = wide.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(cols))])).alias("s")).select("s.*")
    long = vals.unpivot([], cols, "column", "value")
    q = quantiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["column"]).drop("n")
    return stats.join(q, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def days_stats(df: DataFrame, days_col: str) -> DataFrame:
    """mean / median / std (ddof=1) of an integer day count."""
    d = F.col(days_col)
    base = df.agg(F.count(d).alias("n"),
                  (F.sum(d).cast("double") / F.count(d).cast("double")).alias("mean_days"),
                  X.stddev(d).alias("std_days"))
    med = quantiles(df, days_col, {"median_days": 0.5}).drop("n")
    return attach(base, med)
