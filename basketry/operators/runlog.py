"""Pipeline run-log analytics (A17, O3, O4, W5) and volume alerts.

The run log has one row per pipeline run, so its windows run over a series
that is tiny next to the data tables; still, nothing here collects it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .kpis import RUNTIME_CANDIDATES, resolve_column

# Fixed run-log counter names.
METRICS = ["new_products", "updated_products", "new_orders", "updated_orders"]


def _metrics(df: DataFrame, metrics: Sequence[str] | None) -> list[str]:
    return [m for m in (metrics or METRICS) if m in df.columns]


def rollup(runs: DataFrame, metrics: Sequence[str] | None = None, ts_col: str | None = None) -> DataFrame:
    """A17 + O3: run count, latest run's metrics (latest by start time),
    cumulative sums, and updated/new ratios (denominator 0 -> 1) to 2 places."""
    ts_col = ts_col or resolve_column(runs, RUNTIME_CANDIDATES)
    ms = _metrics(runs, metrics)
    latest = F.max_by(F.struct(*[F.col(m) for m in ms]), F.col(ts_col))
    agg = runs.agg(F.count(F.lit(1)).alias("total_runs"), latest.alias("_latest"),
                   *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(f"cum_{m}") for m in ms])
    cols = [F.col("total_runs")] + [F.col("_latest")[m].alias(f"latest_{m}") for m in ms] + \
           [F.col(f"cum_{m}") for m in ms]
    for entity in ("products", "orders"):
        new, upd = f"new_{entity}", f"updated_{entity}"
        if new in ms and upd in ms:
            den = F.when(F.col(f"cum_{new}") != 0, F.col(f"cum_{new}")).otherwise(F.lit(1))
            cols.append(X.round_ratio(F.col(f"cum_{upd}"), den, 2).alias(f"{entity}_update_ratio"))
    return agg.select(*cols)


def melt(runs: DataFrame, metrics: Sequence[str] | None = None, ts_col: str | None = None) -> DataFrame:
    """Wide metrics -> long (ts, metric, value)."""
    ts_col = ts_col or resolve_column(runs, RUNTIME_CANDIDATES)
    ms = _metrics(runs, metrics)
    return runs.select(ts_col, *[F.col(m).cast("bigint").alias(m) for m in ms]) \
        .unpivot([ts_col], ms, "metric", "value")


def cumulative(runs: DataFrame, metrics: Sequence[str] | None = None, ts_col: str | None = None) -> DataFrame:
    """Running totals by start time; a missing value stays missing and is skipped."""
    ts_col = ts_col or resolve_column(runs, RUNTIME_CANDIDATES)
    ms = _metrics(runs, metrics)
    w = Window.orderBy(ts_col, "run_id").rowsBetween(Window.unboundedPreceding, Window.currentRow) \
        if "run_id" in runs.columns else Window.orderBy(ts_col).rowsBetween(Window.unboundedPreceding, 0)
    return runs.select(ts_col, *[F.when(F.col(m).isNotNull(), F.sum(m).over(w)).cast("bigint").alias(f"cum_{m}")
                                 for m in ms])


def volume_alerts(volumes: DataFrame, by: Sequence[str], day: str = "day", volume: str = "volume", frame: int = 7, least: int = 3,
                  high: float = 2.0, low: float = 0.5) -> DataFrame:
    """(by, day, volume, median, n_before, status): each day's volume against the exact median of the ``frame`` calendar days before it.

    ``spike`` above ``high`` times the median, ``drop`` below ``low`` times it, ``missing`` for a day without any row between a provider's first day and the
    last day of all (volume null), ``ok`` otherwise, ``new`` with fewer than ``least`` days in the frame. Days without rows aren't in a frame; several
    rows of a day are summed; null days and volumes don't count.

    Every day is sent to the ``frame`` days after it, and each of those sorts what it gets: at most ``frame`` numbers, so no provider's series is ever in one task.
    """
    keys = list(by)
    daily = volumes.where(F.col(day).isNotNull() & F.col(volume).isNotNull()).groupBy(*keys, F.to_date(day).alias("day")).agg(F.sum(volume).alias("volume"))
    after = daily.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(frame))).alias("_d"), "day", "volume")
    before = after.select(*keys, F.date_add("day", F.col("_d")).alias("day"), F.col("volume").alias("_earlier"), F.lit(None).cast(daily.schema["volume"].dataType).alias("volume"))
    own = daily.select(*keys, "day", F.lit(None).cast(daily.schema["volume"].dataType).alias("_earlier"), "volume")
    g = own.unionByName(before).groupBy(*keys, "day").agg(F.sort_array(F.collect_list("_earlier")).alias("_e"), F.max("volume").alias("volume"))
    g = g.where(F.col("day") <= daily.agg(F.max("day")).scalar())
    n = F.size("_e")
    at = lambda i: F.get("_e", i.cast("int")).cast("double")
    median = F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)
    g = g.select(*keys, "day", "volume", median.alias("median"), n.cast("long").alias("n_before"))
    status = (F.when(F.col("volume").isNull(), "missing").when(F.col("n_before") < least, "new").when(F.col("volume") > high * F.col("median"), "spike")
              .when(F.col("volume") < low * F.col("median"), "drop").otherwise("ok"))
    return g.withColumn("status", status)
