"""Streaming delivery of the incremental merge (section 2.12).

New landing files are picked up by a file-source stream; every micro-batch
is normalized and merged into the table inside ``foreachBatch``. Lines that are no JSON
object are set aside with their text, they do not stop the stream.
The merge is idempotent, so a micro-batch replayed after a failure does not
merge twice; the stream checkpoint records progress.
``trigger(availableNow=True)`` processes everything present, then stops.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import exprs as X
from ..operators import merge as M
from ..sources import tables as TB


def raw_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text-file stream of JSON records -> typed payload, raw_file, raw_hash."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing_dir)
    return lines.where(F.trim("value") != "").select(
        F.from_json("value", schema).alias("payload"), F.col("_metadata.file_path").alias("raw_file"),
        X.canonical_json_hash(F.col("value")).alias("raw_hash"), F.col("value").alias("_json"),
        F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_block_start").alias("_block"))


def merge_batch_fn(table_root: str, name: str, schema: T.StructType, key_mode: str,
                   normalizer: Callable[[DataFrame, object], DataFrame], stamp=None,
                   keys=M.ORDER_KEYS, order_col: str = M.ORDER_ORDER) -> Callable[[DataFrame, int], None]:
    M.check_mode(key_mode)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # A replayed micro-batch is harmless: triple mode anti-joins on
        # (key, raw_hash), pair mode appends the same rows again.
        # one ingest stamp per micro-batch, fixed on the driver, so every task
        # of the batch (a recomputed one included) sees the same value
        if stamp is not None:
            stamp_col = stamp
        else:
            now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
            stamp_col = F.lit(now).cast("timestamp_ntz")
        good = X.is_json_object("_json")
        bad = batch.where(~good).select("raw_file", F.col("_json").alias("json"))
        if not bad.isEmpty():
            bad.write.mode("overwrite").json(f"{table_root.rstrip('/')}/_rejected/{name}/micro_batch={batch_id}")
        # of several records of a key the later file wins, then the later line
        pos = F.struct("_landed", F.col("raw_file").alias("file"), F.col("_block").alias("block"),
                       F.monotonically_increasing_id().alias("row"), F.lit(0).alias("item"))
        normalized = normalizer(batch.withColumn("_pos", pos).where(good), stamp_col)
        TB.merge_into(batch.sparkSession, table_root, name, schema, normalized, key_mode, keys, order_col)

    return apply


def start_merge_stream(spark: SparkSession, landing_dir: str, raw_schema: T.StructType, table_root: str,
                       name: str, table_schema: T.StructType, normalizer, checkpoint_dir: str,
                       key_mode: str = "pair", keys=M.ORDER_KEYS, order_col: str = M.ORDER_ORDER, stamp=None,
                       max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    stream = raw_stream(spark, landing_dir, raw_schema, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(
        merge_batch_fn(table_root, name, table_schema, key_mode, normalizer, stamp, keys, order_col)) \
        .option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
