"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Arrow batches are cut again to about this many text bytes, so that long texts don't add up in a worker.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from those files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def narrow(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names (other columns can't clash)."""
    return df.select(*(F.col(f"`{src}`").alias(name) for name, src in cols.items()))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of text."""
    for batch in batches:
        size = batch.column(text).nbytes
        step = max(1, int(batch.num_rows * min(1.0, SLICE_BYTES / max(1, size))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_texts(df: DataFrame, text: str, schema: str,
              fn: Callable[[pa.RecordBatch, list[bytes]], dict]) -> DataFrame:
    """``fn`` gets a batch and its raw texts and returns the output columns by name."""

    def run(batches):
        for batch in slices(batches, text):
            out = fn(batch, raw_texts(batch.column(text)))
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema)


def finite_vector(vector: Column) -> Column:
    """True unless the vector is null or has a null or non-finite component."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def lookup(rows: DataFrame, entries: DataFrame, on: dict[str, str], bound: int = 100_000) -> DataFrame:
    """Inner join of ``rows`` with ``entries`` (a written table), column -> key of the entries, nulls alike; the entries' keys go.

    Up to ``bound`` entries are broadcast, after counting them. More are joined by a shuffle, where adaptive execution splits the rows of a frequent key.
    """
    same = [rows[c].eqNullSafe(entries[k]) for c, k in on.items()]
    return rows.join(F.broadcast(entries) if entries.count() <= bound else entries, same).drop(*on.values())


def crc_class(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(mod))


def bounded_share(df: DataFrame, id_col: str, bound: int, seed: int) -> DataFrame:
    """All rows if there are at most ``bound``; else about that many, chosen by a hash of the id."""
    n = df.count()
    if n <= bound:
        return df
    keep = int(bound / n * (1 << 31))
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 31)) < keep)


def class_share(df: DataFrame, keys: list[str], label: str, bound: int, seed: int) -> DataFrame:
    """All rows if there are at most ``bound``; else about that many, chosen by a hash of ``keys``.

    Classes are drawn in proportion, but none gives fewer than a tenth of its equal part of the bound (or all that it has), so a rare class is
    not lost in a large table.
    """
    sizes = materialize(df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n")))
    classes, n = sizes.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if (n or 0) <= bound:
        return df
    share = F.least(F.lit(1.0), F.greatest(F.lit(bound / n), F.lit(bound / (10 * classes)) / F.col("_n")))
    drawn = lookup(df, sizes.withColumn("_keep", (share * (1 << 31)).cast("long")).drop("_n"), {label: "_label"})
    return drawn.where(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 31)) < F.col("_keep")).drop("_keep")


def within(sample: DataFrame, keys: list[str], cost: Column, limit: int, seed: int) -> DataFrame:
    """Whole rows of a sample of bounded size, in the order of a hash of their ``keys`` (which tell them apart), whose ``cost`` sums to
    ``limit`` at most. Rows that cost more by themselves are passed over.
    """
    sample = materialize(sample.withColumn("_key", F.xxhash64(*keys, F.lit(seed))))
    # a number for each row of the bounded sample, no texts
    costs = sample.select("_key", cost.cast("long").alias("_cost")).where(F.col("_cost") <= limit)
    upto = F.sum("_cost").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = costs.withColumn("_sum", upto).where(F.col("_sum") <= limit).select("_key").distinct()
    return sample.join(F.broadcast(kept), "_key").drop("_key")


def running(df: DataFrame, group: list[str], key: str, ties: list[str], rank: str | None = None,
            before: dict[str, str] | None = None, total: str | None = None, bits: int = 10) -> DataFrame:
    """Position and running sums of each row within its group, in the order of ``key`` (a long
    spread evenly over its range) and ``ties``, without any group in one task.

    Rows are dealt to (group, leading ``bits`` of the key); the totals of those cells give each cell's start.
    ``rank``: name of the 0-based position. ``before``: new column -> column whose values before the row are summed.
    ``total``: name of the group's number of rows.
    ``df`` is read twice. Rows alike in key and ties are interchangeable.
    """
    before = before or {}
    cell = [*group, "_cell"]
    df = df.withColumn("_cell", F.shiftright(F.col(key), 64 - bits))
    totals = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), *(F.sum(v).alias(f"_t_{k}") for k, v in before.items()))
    prior = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *(F.col(c).alias(f"_s_{c}") for c in cell), F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_start"),
        *(F.coalesce(F.sum(f"_t_{k}").over(prior), F.lit(0)).alias(f"_start_{k}") for k in before),
        *([F.sum("_n").over(Window.partitionBy(*group)).alias(total)] if total else []))
    order = Window.partitionBy(*cell).orderBy(key, *ties)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", (F.row_number().over(order) - 1).cast("long").alias("_r"),
                      *(F.coalesce(F.sum(v).over(upto), F.lit(0)).alias(f"_r_{k}") for k, v in before.items()))
    on = [local[c].eqNullSafe(starts[f"_s_{c}"]) for c in cell]
    out = local.join(starts, on)
    add = {k: F.col(f"_r_{k}") + F.col(f"_start_{k}") for k in before}
    if rank:
        add[rank] = F.col("_r") + F.col("_start")
    return out.withColumns(add).drop("_r", "_start", *(f"_s_{c}" for c in cell), "_cell",
                                     *(f"_{a}_{k}" for k in before for a in ("r", "start")))
