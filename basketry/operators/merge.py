"""Incremental merge of a new batch into a table.

Two key modes:

* ``triple`` keeps every version: a batch row is appended when its
  (source, id, raw_hash) is not in the table yet (NULLs compare equal).
  Repeats inside the batch are kept, as in the reference.
* ``pair`` keeps one row per (source, id): the batch is reduced to its latest
  row per key (by the ingest timestamp, then raw_hash, then the row digest as
  a total tie-break), table rows whose key the batch carries are replaced.

All steps are joins and aggregations on the key columns only, so Spark
shuffles by key once per side; "latest per key" is a ``max_by`` aggregation,
which combines map-side, so a key holding a third of the batch does not end
up as one giant window partition. Counts come back as a one-row DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("triple", "pair")

PRODUCT_KEYS = ("source", "source_id")
PRODUCT_ORDER = "collected_at"
ORDER_KEYS = ("source", "order_id")
ORDER_ORDER = "ingested_at"
TABLE_KEYS = {"products": PRODUCT_KEYS, "orders": ORDER_KEYS}


@dataclass
class MergeResult:
    table: DataFrame      # merged table (not yet written)
    delta: DataFrame      # rows of the batch that enter the table
    counts: DataFrame     # one row: new (bigint), updated (bigint)


def check_mode(mode: str) -> str:
    """M8: unknown modes are rejected before any data is touched."""
    if mode not in MODES:
        raise ValueError(f"Unknown key_mode: {mode}")
    return mode


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


KEY = "_key"  # struct of the key columns


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds KEY. A struct equals another with the same nulls, and rows grouped by it lie as a join on it
    needs them, so they are dealt once."""
    return df.withColumn(KEY, F.struct(*keys))


def row_digest(df: DataFrame) -> Column:
    """Cheap deterministic tie-break over the whole row (only decides between
    rows that agree on every ordering column)."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], keyed: bool = False) -> DataFrame:
    """One row per key, the greatest by ``order_cols`` then row digest. ``keyed``: with KEY, and dealt by it."""
    ordering = F.struct(*[F.col(c) for c in order_cols], row_digest(df))
    by = [F.struct(*keys).alias(KEY)] if keyed else keys
    best = df.groupBy(*by).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), ordering).alias("_row"))
    return best.select(*([KEY] if keyed else []), *[F.col("_row")[c].alias(c) for c in df.columns])


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``. The
    right keys are de-duplicated first (map-side), so a key repeated a million
    times in a batch is one row in the join."""
    r = right.select(F.struct(*keys).alias(KEY)).distinct()
    return with_key(left, keys).join(r, KEY, "left_anti").drop(KEY)


def key_counts(batch_keys: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """new = batch keys absent from the table, updated = present ones."""
    ek = existing.select(F.struct(*keys).alias(KEY)).distinct().withColumn("_hit", F.lit(True))
    j = batch_keys.select(F.struct(*keys).alias(KEY)).join(ek, KEY, "left")
    return j.agg(F.count(F.when(F.col("_hit").isNull(), True)).alias("new"),
                 F.count(F.when(F.col("_hit"), True)).alias("updated"))


def merge(existing: DataFrame, batch: DataFrame, mode: str, keys: Sequence[str], order_col: str,
          hash_col: str = "raw_hash") -> MergeResult:
    check_mode(mode)
    batch = batch.select(*existing.columns) if set(existing.columns) <= set(batch.columns) else batch
    if mode == "triple":
        triple = [*keys, hash_col]
        delta = anti_join(batch, existing, triple)
        table = existing.unionByName(delta, allowMissingColumns=True)
        counts = delta.agg(F.count(F.lit(1)).alias("new"), F.lit(0).cast("bigint").alias("updated"))
        return MergeResult(table, delta, counts)
    latest = latest_per_key(batch, keys, [order_col, hash_col])
    kept = anti_join(existing, batch, keys)
    table = kept.unionByName(latest, allowMissingColumns=True)
    return MergeResult(table, latest, key_counts(latest, existing, keys))


def merge_products(existing: DataFrame, batch: DataFrame, mode: str = "triple") -> MergeResult:
    """M1 / M2."""
    return merge(existing, batch, mode, PRODUCT_KEYS, PRODUCT_ORDER)


def merge_orders(existing: DataFrame, batch: DataFrame, mode: str = "triple") -> MergeResult:
    """M3 / M4 (pair mode also dedups the first load; reference quirk K6 fixed)."""
    return merge(existing, batch, mode, ORDER_KEYS, ORDER_ORDER)
