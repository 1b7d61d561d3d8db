"""Merge tables: the unified products / orders tables at scale.

A merge appends, it never rewrites: every batch is one folder, and a reader
takes the latest row of each key.

    <root>/<name>/mode=pair/batch=7/part-*.parquet
    <root>/<name>/mode=triple/batch=8/part-*.parquet

* triple mode appends the rows whose (key, hash) the table does not hold yet;
  every version stays
* pair mode appends the batch's latest row per key, which hides every earlier
  row with that key

What is written follows the batch, not the table. ``compact`` folds the
batches of a pair table into one when there are many. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from . import files as FS

POSITION = "_pos"  # optional batch column: place of the record among those with one stamp


def _base(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p = FS._fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def batches(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """Batch number -> mode, in order. One entry per merge since the last compaction."""
    base = _base(root, name)
    return dict(sorted((int(n), mode) for mode in _children(spark, base, "mode=")
                       for n in _children(spark, f"{base}/mode={mode}", "batch=")))


def _stored(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("mode", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(full).parquet(_base(root, name))


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType,
               keys: Sequence[str] | None = None) -> DataFrame:
    """Current rows: of each key the row of the last pair batch, and all triple
    rows appended after it. Falls back to ``<name>.csv`` / empty (S3) when the
    table has no batch yet. ``keys``: only needed for tables other than
    products and orders."""
    modes = set(batches(spark, root, name).values())
    if not modes:
        return FS.load_table(spark, root, name, schema)
    keys = list(keys or M.TABLE_KEYS[name])
    rows = _stored(spark, root, name, schema)
    if modes == {"triple"}:
        return rows.drop("mode", "batch")
    # the greatest batch per key: a map-side combined aggregation
    latest = M.latest_per_key(rows.where("mode = 'pair'").drop("mode"), keys, ["batch"])
    if modes == {"pair"}:
        return latest.drop("batch")
    versions = rows.where("mode = 'triple'").drop("mode")
    last = latest.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("batch").alias("_last"))
    on = None
    for k in keys:
        same = versions[k].eqNullSafe(last[f"_{k}"])
        on = same if on is None else on & same
    later = versions.join(last, on, "left").where(F.col("_last").isNull() | (F.col("batch") > F.col("_last")))
    return latest.select(*schema.names).unionByName(later.select(*schema.names))


def merge_into(spark: SparkSession, root: str, name: str, schema: T.StructType, batch: DataFrame, mode: str,
               keys: Sequence[str], order_col: str, dry_run: bool = False) -> dict:
    """Merge ``batch`` into the table; returns {new, updated, batch}.

    The rows entering the table are written once, to their own folder, and
    counted from there; nothing new leaves nothing behind. Of several records
    of a key the latest stamp wins, then the later position (column ``_pos``)
    or, without positions, the greater hash."""
    M.check_mode(mode)
    before = batches(spark, root, name)
    wanted = [F.col(f.name).cast(f.dataType) for f in schema.fields]
    placed = POSITION in batch.columns
    batch = batch.select(*wanted, *([POSITION] if placed else []))
    if mode == "triple":
        existing = read_table(spark, root, name, schema, keys)
        delta = M.anti_join(batch.drop(POSITION), existing, [*keys, "raw_hash"])
    else:
        # whether a key is known needs its column alone, from whichever batch
        existing = _stored(spark, root, name, schema) if before else FS.load_table(spark, root, name, schema)
        delta = M.latest_per_key(batch, keys, [order_col, POSITION if placed else "raw_hash"]).drop(POSITION)

    def counted(rows: DataFrame) -> dict:
        if mode == "triple":
            return {"new": rows.count(), "updated": 0}
        c = M.key_counts(rows, existing, keys).first()
        return {"new": int(c["new"]), "updated": int(c["updated"])}

    if dry_run:
        return {**counted(delta), "batch": None}
    number = max(before, default=0) + 1
    path = f"{_base(root, name)}/mode={mode}/batch={number}"
    delta.write.parquet(path)
    out = counted(spark.read.schema(schema).parquet(path))
    if not out["new"] and not out["updated"]:
        fs, p = FS._fs(spark, path)
        fs.delete(p, True)
        number = None
    return {**out, "batch": number}


def compact(spark: SparkSession, root: str, name: str, schema: T.StructType, keys: Sequence[str] | None = None) -> int | None:
    """Fold a pair table's batches into one. The new batch holds every key and
    so hides the older ones at once; they are deleted after it is complete."""
    before = batches(spark, root, name)
    if set(before.values()) - {"pair"}:
        raise ValueError("only pair tables are compacted: a triple table keeps every appended row as it is")
    if len(before) < 2:
        return None
    number = max(before) + 1
    read_table(spark, root, name, schema, keys).write.parquet(f"{_base(root, name)}/mode=pair/batch={number}")
    for n in before:
        fs, p = FS._fs(spark, f"{_base(root, name)}/mode=pair/batch={n}")
        fs.delete(p, True)
    return number
