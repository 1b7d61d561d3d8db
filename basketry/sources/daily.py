"""Daily aggregates of a merge table, kept up to date batch by batch.

    <root>/<daily>/mode=pair/batch=7/part-*.parquet     the states that batch 7 of the table changed

A state (one row for each day and group) holds what can be added and taken away exactly: a row count, a decimal sum, and counts of values in bins of
three significant digits, from which quantiles follow with a relative error of at most half a percent. For every batch of a pair table the new version of each
key is added and the version it replaces is taken away, on its own day and group. Only states that this changes are written, and they hide older ones.

The daily table's batch has the number of the table's batch that it follows, so an update that failed is made up for by the next one, and none counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from . import files as FS
from . import tables as TB

SUM = "decimal(38,6)"
UNITS = 100  # bins count hundredths
DIGITS = 3


def value_bin(value: Column) -> Column:
    """Lower edge, in units, of the value's bin: all but the first DIGITS digits are zero. Null for a null or non-finite value."""
    units = F.floor(F.abs(value).cast("decimal(38,6)") * UNITS).cast("decimal(38,0)")
    width = F.pow(F.lit(10).cast("decimal(38,0)"), F.greatest(F.length(units.cast("string")) - DIGITS, F.lit(0))).cast("decimal(38,0)")
    # pmod, not division: decimals divide to a fraction
    low = (units - F.pmod(units, width)).cast("long")
    return F.when(value < 0, -low).otherwise(low)


def bin_value(low: Column) -> Column:
    """The middle of a bin; bins one unit wide stand for their edge."""
    size = F.abs(low)
    width = F.pow(F.lit(10.0), F.greatest(F.length(size.cast("string")) - DIGITS, F.lit(0)))
    middle = F.when(width > 1, size + width / 2).otherwise(size.cast("double"))
    return F.when(low < 0, -middle).otherwise(middle) / UNITS


def schema(by: Sequence[str], fields: T.StructType) -> T.StructType:
    bins = T.MapType(T.LongType(), T.LongType())
    return T.StructType([T.StructField("day", T.DateType()), *(fields[b] for b in by), T.StructField("n_orders", T.LongType()),
                         T.StructField("n_values", T.LongType()), T.StructField("total", T.DecimalType(38, 6)), T.StructField("bins", bins)])


def states(rows: DataFrame, at: str, value: str, by: Sequence[str], sign: Column | None = None) -> DataFrame:
    """(day, by, n_orders, n_values, total, bins) of dated rows, each counted ``sign`` times. Values are summed to six decimals; a null or
    non-finite one counts as a row without a value. Sums combine map-side, so a day with a third of all rows is one row from each task and bin."""
    s = (sign if sign is not None else F.lit(1)).cast("long")
    v = F.col(value).try_cast("decimal(38,6)")
    each = rows.where(F.col(at).isNotNull()).select(F.to_date(at).alias("day"), *by, s.alias("_s"), v.alias("_v"), value_bin(v).alias("_bin"))
    per_bin = each.groupBy("day", *by, "_bin").agg(F.sum("_s").alias("_n"), F.sum(F.col("_v") * F.col("_s")).cast(SUM).alias("_total"))
    bins = F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("_bin").isNotNull() & (F.col("_n") != 0), F.struct("_bin", "_n")))))
    return per_bin.groupBy("day", *by).agg(
        F.sum("_n").alias("n_orders"), F.coalesce(F.sum(F.when(F.col("_bin").isNotNull(), F.col("_n"))), F.lit(0).cast("long")).alias("n_values"),
        F.coalesce(F.sum("_total"), F.lit(0)).cast(SUM).alias("total"), bins.alias("bins"))


def combined(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of equal day and group added up."""
    keys = ["day", *by]
    sums = parts.groupBy(*keys).agg(F.sum("n_orders").alias("n_orders"), F.sum("n_values").alias("n_values"), F.sum("total").cast(SUM).alias("total"))
    bins = parts.select(*keys, F.explode("bins").alias("_bin", "_n")).groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    bins = bins.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_bin", "_n")))).alias("_bins"))
    same = [sums[k].eqNullSafe(bins[f"_{k}"]) for k in keys]
    empty = F.map_from_entries(F.array().cast("array<struct<_bin:bigint,_n:bigint>>"))
    return sums.join(bins, same, "left").select(*keys, "n_orders", "n_values", "total", F.coalesce("_bins", empty).alias("bins"))


def changes(spark: SparkSession, root: str, name: str, fields: T.StructType, keys: Sequence[str], at: str, value: str, by: Sequence[str],
            number: int) -> DataFrame:
    """What batch ``number`` of the pair table adds to and takes from the states: its rows, and the versions that they replace."""
    cols = list(dict.fromkeys([*keys, at, value, *by]))
    rows = TB._stored(spark, root, name, fields)
    new = rows.where(F.col("batch") == number).select(*cols)
    before = rows.where(F.col("batch") < number).select(*cols, "batch")
    touched = new.select(*keys)
    old = M.latest_per_key(before.join(touched, M.null_safe_on(before, touched, keys), "left_semi"), keys, ["batch"]).drop("batch")
    signed = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
    changed = states(signed, at, value, by, F.col("_sign"))
    # a row that comes again unchanged takes away what it adds
    return changed.where((F.col("n_orders") != 0) | (F.col("total") != 0) | (F.size("bins") > 0))


def complete(spark: SparkSession, root: str, daily: str) -> list[int]:
    return [n for n, mode in TB.batches(spark, root, daily).items() if FS.path_exists(spark, f"{root.rstrip('/')}/{daily}/mode={mode}/batch={n}/_SUCCESS")]


def read_states(spark: SparkSession, root: str, daily: str, by: Sequence[str], fields: T.StructType) -> DataFrame:
    """The last state of every day and group."""
    done = complete(spark, root, daily)
    full = schema(by, fields)
    if not done:
        return spark.createDataFrame([], full)
    rows = TB._stored(spark, root, daily, full).where(F.col("batch") <= max(done)).drop("mode")
    keys = ["day", *by]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct("n_orders", "n_values", "total", "bins"), "batch").alias("_s"))
    return best.select(*keys, "_s.*")


def update(spark: SparkSession, root: str, name: str, daily: str, fields: T.StructType, keys: Sequence[str], at: str, value: str,
           by: Sequence[str] = ("source",)) -> list[int]:
    """Bring the daily table up to the merge table; returns the batches taken. Where the table was compacted since, its history is gone, and the
    states are made anew from its current rows."""
    there, done = TB.batches(spark, root, name), complete(spark, root, daily)
    if set(there.values()) - {"pair"}:
        raise ValueError("daily states follow pair tables: a triple table never replaces a row")
    last = max(done, default=0)
    ahead = [n for n in there if n > last]
    full = schema(by, fields)
    cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in full.fields]
    if ahead and last and last not in there:
        ahead = [max(there)]
        now = states(TB.read_table(spark, root, name, fields, keys), at, value, by)
        old = read_states(spark, root, daily, by, fields)
        gone = old.join(now, M.null_safe_on(old, now, ["day", *by]), "left_anti")
        empty = gone.select("day", *by, F.lit(0).alias("n_orders"), F.lit(0).alias("n_values"), F.lit(0).cast(SUM).alias("total"),
                            F.map_filter("bins", lambda k, v: F.lit(False)).alias("bins"))
        fresh = [(ahead[0], now.select(*cast).unionByName(empty.select(*cast)))]
    else:
        fresh = []
    for n in ahead:
        if fresh:
            out = fresh[0][1]
        else:
            change = changes(spark, root, name, fields, keys, at, value, by, n).select(*cast).checkpoint()
            old = read_states(spark, root, daily, by, fields).select(*full.names)
            held = old.join(change.select("day", *by), M.null_safe_on(old, change, ["day", *by]), "left_semi")
            out = combined(held.unionByName(change), by).select(*cast)
        out.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{daily}/mode=pair/batch={n}")
    return ahead


def quantile(bins: Column, n: Column, share: float) -> Column:
    """The value at rank ceil(share * n) of the binned values, to half a percent; null without values."""
    edges = F.array_sort(F.map_entries(bins))
    rank = F.greatest(F.ceil(n * F.lit(share)), F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("long").alias("at"))
    walk = F.aggregate(edges, start, lambda a, e: F.struct(
        (a["upto"] + e["value"]).alias("upto"), F.when(a["at"].isNull() & (a["upto"] + e["value"] >= rank), e["key"]).otherwise(a["at"]).alias("at")))
    return bin_value(walk["at"])


def read(spark: SparkSession, root: str, daily: str, fields: T.StructType, by: Sequence[str] = ("source",), quantiles: dict[str, float] | None = None) -> DataFrame:
    """(day, by, n_orders, gmv, aov, one column for each quantile) of the days that have orders."""
    s = read_states(spark, root, daily, by, fields).where(F.col("n_orders") > 0)
    gmv = F.col("total").cast("double")
    asked = quantiles if quantiles is not None else {"p50": 0.5, "p90": 0.9}
    return s.select("day", *by, "n_orders", gmv.alias("gmv"), (gmv / F.col("n_orders").cast("double")).alias("aov"),
                    *(quantile(F.col("bins"), F.col("n_values"), p).alias(name) for name, p in asked.items()))
