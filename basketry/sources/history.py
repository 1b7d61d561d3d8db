"""History tables: versions arrive in batches, in any order, and the table holds each key's validity intervals.

    <root>/<name>/versions/batch=3/part-*.parquet     what was said, once
    <root>/<name>/intervals/batch=3/part-*.parquet    all intervals of the keys that batch 3 says something new about

A batch writes the intervals of the keys it touches, which hide those of older batches. A late version cuts or joins intervals just as if it had
come in time, and a repeated batch writes nothing. A batch counts once its intervals are there: one that fails before is appended again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history as H
from . import files as FS
from .tables import _children


def _folder(root: str, name: str, part: str) -> str:
    return f"{root.rstrip('/')}/{name}/{part}"


def batches(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the complete batches."""
    base = _folder(root, name, "intervals")
    return sorted(int(n) for n in _children(spark, base, "batch=") if FS.path_exists(spark, f"{base}/batch={n}/_SUCCESS"))


def _versions(spark: SparkSession, root: str, name: str, numbers: Sequence[int]) -> DataFrame:
    schema = spark.read.parquet(f"{_folder(root, name, 'versions')}/batch={numbers[0]}").schema
    # an unfinished batch's versions aren't read
    return spark.read.schema(schema.add("batch", "long")).parquet(_folder(root, name, "versions")).where(F.col("batch") <= max(numbers)).drop("batch")


def append(spark: SparkSession, root: str, name: str, batch: DataFrame, keys: Sequence[str], at: str, state: Sequence[str],
           tie: Sequence[str] = ()) -> dict:
    """Add a batch of versions; returns {versions, keys, batch}: new versions, touched keys, the batch's number (None if nothing is new)."""
    known = batches(spark, root, name)
    cols = [*keys, at, *dict.fromkeys([*state, *tie])]
    said = batch.where(F.col(at).isNotNull()).select(*cols)
    if known:
        # a known version has a time of the batch; repeats and known ones go in one grouping
        span = said.agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
        there = _versions(spark, root, name, known).select(*cols).join(F.broadcast(span), F.col(at).between(F.col("_lo"), F.col("_hi"))).select(*cols)
        both = said.withColumn("_old", F.lit(False)).unionByName(there.withColumn("_old", F.lit(True)))
        said = both.groupBy(*cols).agg(F.max("_old").alias("_old")).where(~F.col("_old")).drop("_old")
    else:
        said = said.distinct()
    number = max(known, default=0) + 1
    path = f"{_folder(root, name, 'versions')}/batch={number}"
    said.write.mode("overwrite").parquet(path)
    new = spark.read.parquet(path)
    n = new.count()
    if not n:
        fs, p = FS._fs(spark, path)
        fs.delete(p, True)
        return {"versions": 0, "keys": 0, "batch": None}
    # a struct equals another with the same nulls, and what is dealt by it stays so up to the intervals
    touched = new.select(F.struct(*keys).alias(H.KEY)).distinct()
    versions = _versions(spark, root, name, [*known, number])
    frequent = H.any_frequent(versions, keys)
    theirs = versions.withColumn(H.KEY, F.struct(*keys)).join(touched, H.KEY, "left_semi")
    H.intervals(theirs, keys, at, state, tie, frequent=frequent).write.mode("overwrite").parquet(f"{_folder(root, name, 'intervals')}/batch={number}")
    return {"versions": n, "keys": touched.count(), "batch": number}


def read(spark: SparkSession, root: str, name: str, keys: Sequence[str]) -> DataFrame:
    """(keys, state, valid_from, valid_to): every key's intervals, from the last batch that touched it."""
    known = batches(spark, root, name)
    base = _folder(root, name, "intervals")
    schema = spark.read.parquet(f"{base}/batch={known[-1]}").schema
    rows = spark.read.schema(schema.add("batch", "long")).parquet(base).where(F.col("batch") <= known[-1])
    if len(known) == 1:
        return rows.drop("batch")
    rows = rows.withColumn(H.KEY, F.struct(*keys))
    last = rows.groupBy(F.col(H.KEY).alias("_k")).agg(F.max("batch").alias("_last"))
    # both sides are dealt by the key alone, once
    return rows.join(last, (rows[H.KEY] == last["_k"]) & (rows["batch"] >= last["_last"]), "left_semi").drop("batch", H.KEY)


def compact(spark: SparkSession, root: str, name: str, keys: Sequence[str]) -> int | None:
    """Fold the interval batches into one; the versions stay."""
    known = batches(spark, root, name)
    if len(known) < 2:
        return None
    number = known[-1] + 1
    # an empty batch of versions keeps the numbers of both folders alike
    _versions(spark, root, name, known).limit(0).write.mode("overwrite").parquet(f"{_folder(root, name, 'versions')}/batch={number}")
    read(spark, root, name, keys).write.mode("overwrite").parquet(f"{_folder(root, name, 'intervals')}/batch={number}")
    for n in known:
        fs, p = FS._fs(spark, f"{_folder(root, name, 'intervals')}/batch={n}")
        fs.delete(p, True)
    return number
