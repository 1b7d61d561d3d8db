"""Tables partitioned by date: a batch rewrites the dates it touches and no others.

    <path>/<part>=2024-03-01/part-*.parquet      part: the day, or the first day of the month or year

Rows are dealt to writers by ranges of (date, digest of the key), so a date with a third of all rows has many writers and a quiet one few files.
A rewrite is not atomic over several dates; repeating it after a failure gives the same table. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as M
from . import files as FS

PART = "part_date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed name of Spark's folder for null


def part_of(at: Column, unit: str = "day") -> Column:
    return F.to_date(F.date_trunc(unit, at))


def write(rows: DataFrame, path: str, keys: Sequence[str], writers: int | None = None) -> None:
    """Replace the dates that ``rows`` (with PART) hold; other dates' files stay as they are."""
    n = writers or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, PART, F.xxhash64(*keys))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def read(spark: SparkSession, path: str, schema, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Rows of the dates from ``first`` to ``last``; other folders aren't listed for the scan. ``schema``: the rows without PART."""
    rows = spark.read.schema(type(schema)([*schema.fields]).add(PART, "date")).parquet(path)
    if first is not None:
        rows = rows.where(F.col(PART) >= F.lit(first))
    return rows.where(F.col(PART) <= F.lit(last)) if last is not None else rows


def upsert(spark: SparkSession, path: str, batch: DataFrame, schema, keys: Sequence[str], at: str, order_col: str, unit: str = "day") -> list:
    """Bring the batch's latest row of each key into the table, wherever its date has moved; returns the dates rewritten.

    A row older than the table's row of its key changes nothing. Rows without a date have a folder of their own."""
    new = M.latest_per_key(batch.select(*schema.names), keys, [order_col], keyed=True).withColumn(PART, part_of(F.col(at), unit))
    if not FS.path_exists(spark, path):
        write(new.drop(M.KEY), path, keys)
        # the folders' names say it
        return sorted((r[0] for r in read(spark, path, schema).select(PART).distinct().collect()), key=str)
    # where the keys are now: key, order and date alone are read
    there = read(spark, path, schema).select(F.struct(*keys).alias(M.KEY), F.col(order_col).alias("_order"), F.col(PART).alias("_part"))
    moved = new.join(there, M.KEY, "left").drop(M.KEY).withColumn("_known", F.col("_order").isNotNull())
    moved = moved.where(~F.col("_known") | (F.col("_order") <= F.col(order_col))).checkpoint()
    # at most as many as the calendar has
    dates = {r[0] for r in moved.select(PART).unionByName(moved.where("_known").select(F.col("_part").alias(PART))).distinct().collect()}
    if not dates:
        return []
    known = [d for d in dates if d is not None]
    touched = F.col(PART).isin(known) if None not in dates else F.col(PART).isin(known) | F.col(PART).isNull()
    entering = moved.select(*schema.names, PART)
    # each key enters once, so there is nothing to make distinct
    old, theirs = read(spark, path, schema).where(touched), entering.select(F.struct(*keys).alias(M.KEY))
    kept = M.with_key(old, keys).join(theirs, M.KEY, "left_anti")
    rows = kept.select(*schema.names, PART).unionByName(entering).checkpoint()
    write(rows, path, keys)
    # a date that has lost its last row isn't overwritten by anything
    for d in dates - {r[0] for r in rows.select(PART).distinct().collect()}:
        fs, p = FS._fs(spark, f"{path.rstrip('/')}/{PART}={NO_DATE if d is None else d}")
        fs.delete(p, True)
    return sorted(dates, key=str)
