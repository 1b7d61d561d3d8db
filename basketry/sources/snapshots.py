"""Kept schema snapshots (Q1): what a dataset's columns were when a run last succeeded.

    <root>/<dataset>/v=<n>       (position, column, dtype) of the last run that changed it
    <root>/_history              one JSON line for each change a run found

A run compares first and keeps last: if it fails in between, the next run finds the same changes again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from . import files as FS

SNAPSHOT = T.StructType().add("position", "integer").add("column", "string").add("dtype", "string")
HISTORY = T.StructType().add("dataset", "string").add("run_id", "string").add("column", "string").add("change", "string").add(
    "old_dtype", "string").add("new_dtype", "string")


def latest(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """The kept snapshot, None before the first run."""
    versions = FS.committed_versions(spark, root, dataset)
    return spark.read.schema(SNAPSHOT).parquet(f"{root.rstrip('/')}/{dataset}/v={versions[-1]}") if versions else None


def compare(spark: SparkSession, root: str, dataset: str, current: DataFrame) -> DataFrame:
    """(dataset, column, change, old_dtype, new_dtype): how ``current`` (position, column, dtype) differs from the kept snapshot."""
    return Q.compare_snapshots(latest(spark, root, dataset), current).select(F.lit(dataset).alias("dataset"), "column", "change", "old_dtype", "new_dtype")


def keep(spark: SparkSession, root: str, run_id: str, snapshots: Mapping[str, DataFrame]) -> DataFrame:
    """Append the changes of every dataset to the history and replace the snapshots that changed; returns the changes.

    A few rows for each dataset: columns, not data."""
    found = []
    for dataset, current in snapshots.items():
        rows = compare(spark, root, dataset, current).collect()
        if rows:
            found += [(dataset, run_id, *r[1:]) for r in rows]
    changes = spark.createDataFrame(found, HISTORY)
    if found:
        FS.append_json_lines(changes.coalesce(1), f"{root.rstrip('/')}/_history")
        for dataset in dict.fromkeys(f[0] for f in found):
            FS.write_version(snapshots[dataset].select(*SNAPSHOT.names).coalesce(1), root, dataset)
    return changes


def history(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/_history"
    return FS.read_json_lines(spark, path, HISTORY) if FS.path_exists(spark, path) else spark.createDataFrame([], HISTORY)


def typed_snapshot(spark: SparkSession, types: Mapping[str, str]) -> DataFrame:
    """(position, column, dtype) of inferred types."""
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(types.items())], SNAPSHOT)
