"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE re-plans joins at run time
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of garbage-collected frames are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "basketry",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is never
    overridden here. Only when it is unset (tests, a laptop) a private
    scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive the loss of an executor
            raise RuntimeError("spark.checkpoint.dir is not set: it must name shared storage on a cluster")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
