"""Exact quantiles without funnelling a column into one task.

Spark's built-in ``percentile`` merges every partial buffer (a map of value ->
count) in a single final task per group. On a 100 TB column with many
distinct values that buffer is unbounded, and a hot group lands on one task.

Here the column is first pre-aggregated to (group, value, count), which the
map-side combine shrinks before the shuffle (one hot value costs one row).
The distinct values are then dealt to ranges of values with about the same
number of them each, so that a huge group is spread over many tasks; each
range is ranked with a running sum of its own, and a small table of totals (one
row per group and range) turns local ranks into global ones. Only the
2 x len(probs) rows that hold the wanted ranks reach the last aggregation.

Interpolation is pandas' default ``linear``: with ``pos = (n - 1) * p`` and
``t`` its fraction, ``v[floor(pos)] + d * t`` or, from t = 1/2 on,
``v[ceil(pos)] - d * (1 - t)`` (d: the difference of the two values), which
decides whether tied edges come out equal to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _distinct_values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    v = df.select(*[F.col(b) for b in by], F.col(value).cast("double").alias("_v"))
    keep = F.col("_v").isNotNull() & ~F.isnan("_v")
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return v.where(keep).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
              count_alias: str = "n", method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """One row per group: ``by`` columns, the non-null count and one column per probability.

    NULL and NaN values are ignored (pandas semantics); rows whose group key is
    NULL are dropped (pandas ``groupby`` semantics). Groups without any value
    produce no row; without ``by`` there is always one row (n = 0 and NULL
    quantiles when the column holds no value). ``method``: 'exact' or 'approx'
    (``percentile_approx`` sketches: one aggregation, rank error about
    1/accuracy, no interpolation) for dashboards where exactness is not needed.
    """
    by = list(by)
    if method == "approx":
        return _approx_quantiles(df, value, probs, by, count_alias, accuracy)
    if method != "exact":
        raise ValueError(f"unknown method {method}")
    return _ranked_quantiles(_distinct_values(df, value, by), probs, by, count_alias)


def _approx_quantiles(df: DataFrame, value: str, probs, by: list[str], count_alias: str,
                      accuracy: int) -> DataFrame:
    v = F.col(value).cast("double")
    keep = v.isNotNull() & ~F.isnan(v)
    for b in by:
        keep = keep & F.col(b).isNotNull()
    names = list(probs)
    agg = df.where(keep).groupBy(*by).agg(
        F.count(F.lit(1)).alias(count_alias),
        F.percentile_approx(v, [float(probs[k]) for k in names], accuracy).alias("_q"))
    return agg.select(*by, count_alias, *[F.col("_q")[i].alias(k) for i, k in enumerate(names)])


def _pick(g: DataFrame, probs: Mapping[str, float], by: list[str], count_alias: str) -> DataFrame:
    """From ranked distinct values (_v, _gn, _lo, _hi) keep the rows holding the
    floor/ceil ranks of every probability and interpolate."""
    names = list(probs)
    pos = {k: (F.col("_gn") - F.lit(1)).cast("double") * F.lit(float(p)) for k, p in probs.items()}
    flo = {k: F.floor(pos[k]) for k in names}
    cei = {k: F.ceil(pos[k]) for k in names}

    def covers(rank):
        return (rank >= F.col("_lo")) & (rank <= F.col("_hi"))

    hit = None
    for k in names:
        cond = covers(flo[k]) | covers(cei[k])
        hit = cond if hit is None else hit | cond
    picked = g.where(hit)
    aggs = [F.max("_gn").alias("_gn")]
    for k in names:
        aggs.append(F.max(F.when(covers(flo[k]), F.col("_v"))).alias(f"_f_{k}"))
        aggs.append(F.max(F.when(covers(cei[k]), F.col("_v"))).alias(f"_c_{k}"))
    per_group = picked.groupBy(*by).agg(*aggs)
    out = [F.col(b) for b in by] + [F.coalesce(F.col("_gn"), F.lit(0)).alias(count_alias)]
    for k, p in probs.items():
        pos_k = (F.col("_gn") - F.lit(1)).cast("double") * F.lit(float(p))
        out.append(_interpolate(F.col(f"_f_{k}"), F.col(f"_c_{k}"), pos_k - F.floor(pos_k)).alias(k))
    return per_group.select(*out)


def _interpolate(lo: Column, hi: Column, t: Column) -> Column:
    return F.when(t >= 0.5, hi - (hi - lo) * (1 - t)).otherwise(lo + (hi - lo) * t)


def _ranked_quantiles(distinct: DataFrame, probs, by: list[str], count_alias: str) -> DataFrame:
    spark = distinct.sparkSession
    ensure_checkpoint_dir(spark)
    # written once to the shared checkpoint folder: the bounds, the totals and the ranks read the same rows
    distinct = distinct.checkpoint(eager=True)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one bound per range reaches the driver; where they lie decides the balance, not the result
    bounds = distinct.agg(F.percentile_approx("_v", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("q")).first()["q"] if ranges > 1 else None
    inf = float("inf")
    splits = [-inf, *sorted({b for b in bounds or [] if -inf < b < inf}), inf]
    distinct = Bucketizer(splits=splits, inputCol="_v", outputCol="_range").transform(distinct) if len(splits) > 2 \
        else distinct.withColumn("_range", F.lit(0.0))
    cell = [*by, "_range"]
    totals = distinct.groupBy(*cell).agg(F.sum("_n").alias("_sum"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*cell, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"), F.sum("_sum").over(group).alias("_gn"))
    local = Window.partitionBy(*cell).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = distinct.withColumn("_end", F.sum("_n").over(local)).join(offsets, on=cell)
    end = F.col("_off") + F.col("_end")
    g = g.select(*by, "_v", "_gn", (end - F.col("_n")).alias("_lo"), (end - 1).alias("_hi"))
    return _pick(g, probs, by, count_alias)


def quantile_sql(table_sql: str, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
                 count_alias: str = "n") -> str:
    """DuckDB SQL computing the same linear-interpolation quantiles (oracle side).

    Sorted per-group value lists are indexed at floor/ceil of ``(n-1)*p``.
    """
    by = list(by)
    key_sel = ", ".join(by)
    where = " AND ".join([f"{b} IS NOT NULL" for b in by] + [f"{value} IS NOT NULL", f"NOT isnan({value})"])
    group = f"GROUP BY {key_sel}" if by else ""
    cols = []
    for k, p in probs.items():
        pos = f"(CAST(n_ - 1 AS DOUBLE) * CAST({float(p)!r} AS DOUBLE))"
        lo = f"l_[CAST(floor({pos}) AS BIGINT) + 1]"
        hi = f"l_[CAST(ceil({pos}) AS BIGINT) + 1]"
        t = f"({pos} - floor({pos}))"
        cols.append(f"CASE WHEN {t} >= 0.5 THEN {hi} - ({hi} - {lo}) * (1 - {t}) ELSE {lo} + ({hi} - {lo}) * {t} END AS {k}")
    pre = f"{key_sel}, " if by else ""
    return (f"SELECT {pre}n_ AS {count_alias}, {', '.join(cols)} FROM ("
            f"SELECT {pre}count(*) AS n_, list_sort(list(CAST({value} AS DOUBLE))) AS l_ "
            f"FROM ({table_sql}) qsrc WHERE {where} {group}) qagg")
