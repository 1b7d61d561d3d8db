"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source. Sorted by fractional rank (rank + 1/2) / rows of the source, the
sources interleave in proportion, so that every cut of that order holds the mixture; it is cut into shards whose row counts
are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize, narrow, running


def seeded_key(seed: int, *cols: str) -> Column:
    """A long spread evenly over its range (in steps of 16), from an md5 of seed and columns, null as empty."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") - (1 << 59)) * 16


def interleave(rows: DataFrame, shards: int, seed: int, mark_col: str) -> DataFrame:
    """Adds ``shard`` and ``slot`` to (doc_id, source, ...) rows; all other columns serve as tie-breakers.

    The shuffle hashes the id and ``mark_col``, so the rows of a null or repeated id spread. Rows alike in all columns are interchangeable: each
    partition ranks them as one row with a count, and that one becomes rows again where its copies get their ranks.
    """
    names = rows.columns
    ties = ["doc_id", *(c for c in names if c not in ("doc_id", "source"))]
    rows = rows.withColumn("_part", F.spark_partition_id()).groupBy(*names, "_part").agg(F.count(F.lit(1)).alias("_copies"))
    rows = materialize(rows.withColumn("_key", seeded_key(seed, "doc_id", mark_col)))
    sizes = materialize(rows.groupBy(F.col("source").alias("_source")).agg(F.sum("_copies").alias("_rows")))
    n = sizes.agg(F.sum("_rows")).first()[0] or 0
    ranked = lookup(running(rows, ["source"], "_key", [*ties, "_part"], before={"_before": "_copies"}), sizes, {"source": "_source"})
    ranked = ranked.select(*names, "_rows", F.explode(F.sequence("_before", F.col("_before") + F.col("_copies") - 1)).alias("_rank"))
    share = (F.col("_rank") + 0.5) / F.col("_rows")
    # shares lie strictly between 0 and 1; equal ones go by source (code points, null last) and rank
    ranked = materialize(ranked.withColumns({"_share": share, "_null": F.col("source").isNull(),
                                             "_key": ((share - 0.5) * float(1 << 63) * 2).cast("long")}))
    placed = running(ranked, [], "_key", ["_share", "_null", "source", "_rank"], rank="_pos")
    shard = F.expr(f"cast(_pos * {shards} div {max(n, 1)} as int)")
    return placed.withColumn("shard", shard).withColumn("slot", F.expr(f"_pos - (cast(shard as bigint) * {n} + {shards - 1}) div {shards}")).select(
        *names, "shard", "slot")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          shards: int = 40, seed: int = 3, overhead: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per row of ``docs``.

    The law is ``rows``: shards differ by one row at most; grown_shard is null. Size is the text's UTF-8 bytes plus ``overhead``.
    A null text has no bytes and the crc of the empty string; null sources are a stratum of their own. Repeated rows
    get slots of their own and are interchangeable, a null doc_id stays null, an empty table gives an empty result, other columns are ignored.
    With fewer rows than shards some shards stay empty.
    """
    rows = narrow(docs, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return interleave(rows, shards, seed, "text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
