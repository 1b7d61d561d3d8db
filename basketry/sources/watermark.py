"""Incremental reads by an update time, with a high-water mark for each provider and resource.

A pull takes the rows above the mark less an overlap, in which late records are found; those the table already has in that version or a newer
one are left out, so nothing counts twice. The mark moves once the rows are in the table: a pull that fails in between is made again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files as FS
from . import tables as TB

MARK = "mark"


def marks(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """(by, mark): the greatest mark written for each provider and resource."""
    schema = T.StructType([*(T.StructField(b, T.StringType()) for b in by), T.StructField(MARK, T.TimestampNTZType())])
    if not FS.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).groupBy(*by).agg(F.max(MARK).alias(MARK))


def due(source: DataFrame, known: DataFrame, by: Sequence[str], updated: str, overlap: str, until: Column | None = None) -> DataFrame:
    """Rows of ``source`` updated after their mark less ``overlap`` (an interval such as "3 days"), all of them where there is no mark; not those
    updated after ``until``. Rows without an update time are always due."""
    k = known.select(*(F.col(b).alias(f"_{b}") for b in by), (F.col(MARK) - F.expr(f"INTERVAL {overlap}")).alias("_from"))
    rows = source.join(k, [source[b].eqNullSafe(k[f"_{b}"]) for b in by], "left")
    rows = rows.where(F.col("_from").isNull() | F.col(updated).isNull() | (F.col(updated) > F.col("_from"))).drop("_from", *(f"_{b}" for b in by))
    return rows.where(F.col(updated).isNull() | (F.col(updated) <= until)) if until is not None else rows


def pull(spark: SparkSession, source: DataFrame, root: str, name: str, schema: T.StructType, mark_path: str, by: Sequence[str], updated: str,
         keys: Sequence[str], overlap: str = "1 day", until: Column | None = None) -> dict:
    """Merge what is due into the pair table; returns {read, new, updated}. Of several versions of a key the one updated last counts;
    one that the table has seen, or an older one, changes nothing."""
    taken = due(source, marks(spark, mark_path, by), by, updated, overlap, until).checkpoint()
    now = TB.read_table(spark, root, name, schema, keys).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(updated).alias("_now"))
    seen = [taken[k].eqNullSafe(now[f"_{k}"]) for k in keys]
    # without times there is nothing to compare: such a row enters only as a key's first
    older = F.coalesce(now["_now"] >= taken[updated], F.lit(True))
    fresh = taken.join(now, [*seen, older], "left_anti")
    out = TB.merge_into(spark, root, name, schema, fresh, "pair", keys, updated)
    moved = taken.where(F.col(updated).isNotNull()).groupBy(*by).agg(F.max(updated).alias(MARK))
    FS.append_json_lines(moved.coalesce(1), mark_path)  # one row for each provider and resource
    return {"read": taken.count(), "new": out["new"], "updated": out["updated"]}
