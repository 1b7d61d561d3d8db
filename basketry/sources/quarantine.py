"""Checked merges: records that break a rule go to quarantine, not into the table.

    <root>/_staging/<name>/run=<run>/ok=true|false/      one pass over the batch routes every record
    <root>/_quarantine/<name>/run=<run>/part-*.parquet   rejected records with the rules they break
    <root>/_released/<name>/part-*.parquet               ids of quarantined records whose mended form is in the table

``stage`` makes the batch ready and nothing visible; ``check_share`` stops a run with too many violations; ``publish`` writes the quarantine,
then merges. A run that fails in between is simply run again: a record is quarantined under a digest of its content, so twice is once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from ..operators import quality as Q
from . import files as FS
from . import tables as TB

ID, BROKEN = "quarantine_id", "violations"


class TooManyViolations(Exception):
    """The share of records that break a rule is above the run's limit."""


@dataclass(frozen=True)
class Staged:
    name: str
    run: str
    path: str
    good: int
    bad: int


def _path(root: str, kind: str, name: str) -> str:
    return f"{root.rstrip('/')}/_{kind}/{name}"


def record_id(cols: Sequence[str]) -> Column:
    """Digest of a record's content."""
    return F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in cols)), {"ignoreNullFields": "false"}), 256)


def stage(batch: DataFrame, root: str, name: str, schema: T.StructType, rules: Sequence[Q.Rule], run: str) -> Staged:
    """Write the batch once, every record to the good or the bad side. A rule that gives null (nothing to say) isn't broken."""
    spark = batch.sparkSession
    extra = [TB.POSITION] if TB.POSITION in batch.columns else []
    cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    checked = Q.violations(batch.select(*cast, *extra), rules)
    path = f"{_path(root, 'staging', name)}/run={run}"
    checked.withColumn("ok", F.size(BROKEN) == 0).write.mode("overwrite").partitionBy("ok").parquet(path)
    n = {r["ok"]: r["count"] for r in _staged(spark, path, checked.schema).groupBy("ok").count().collect()}
    return Staged(name, run, path, n.get(True, 0), n.get(False, 0))


def _staged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if schema is None:
        return spark.read.parquet(path)
    # both sides may be empty
    full = T.StructType([f for f in schema.fields if f.name != "ok"]).add("ok", "boolean")
    return spark.read.schema(full).parquet(path)


def check_share(staged: Sequence[Staged], most: float | None) -> None:
    """Stop the run before anything of it is visible if more than ``most`` of any entity's records break a rule."""
    over = [f"{s.name}: {s.bad} of {s.good + s.bad}" for s in staged if most is not None and s.bad > most * (s.good + s.bad)]
    if over:
        raise TooManyViolations("; ".join(over))


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    for s in staged:
        fs, p = FS._fs(spark, s.path)
        fs.delete(p, True)


def publish(spark: SparkSession, staged: Staged, root: str, schema: T.StructType, mode: str, keys: Sequence[str], order_col: str,
            dry_run: bool = False) -> dict:
    """Quarantine the bad side, merge the good one; returns merge_into's counts and ``quarantined``."""
    if staged.bad and not dry_run:
        bad = spark.read.parquet(f"{staged.path}/ok=false")
        # the stamp is the run's, not the record's
        bad = bad.select(record_id([c for c in schema.names if c != order_col]).alias(ID), BROKEN, *schema.names)
        bad.write.mode("overwrite").parquet(f"{_path(root, 'quarantine', staged.name)}/run={staged.run}")
    out = {"new": 0, "updated": 0, "batch": None}
    if staged.good:
        out = TB.merge_into(spark, root, staged.name, schema, spark.read.parquet(f"{staged.path}/ok=true").drop(BROKEN), mode, keys, order_col, dry_run)
    return {**out, "quarantined": staged.bad}


def merge_checked(spark: SparkSession, root: str, name: str, schema: T.StructType, batch: DataFrame, mode: str, keys: Sequence[str],
                  order_col: str, rules: Sequence[Q.Rule], run: str, most: float | None = None) -> dict:
    """``merge_into`` for the records that keep every rule; the others go to quarantine. With more than ``most`` of them
    the run raises TooManyViolations and leaves table and quarantine as they were."""
    M.check_mode(mode)
    staged = stage(batch, root, name, schema, rules, run)
    try:
        check_share([staged], most)
        return publish(spark, staged, root, schema, mode, keys, order_col)
    finally:
        discard(spark, [staged])


def quarantined(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """(quarantine_id, violations, columns of the table): every open record once."""
    full = T.StructType([T.StructField(ID, T.StringType()), T.StructField(BROKEN, T.ArrayType(T.StringType())), *schema.fields])
    path = _path(root, "quarantine", name)
    if not FS.path_exists(spark, path):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(T.StructType([*full.fields, T.StructField("run", T.StringType())])).parquet(path)
    # a record quarantined by several runs is one: its id is its content
    rows = rows.groupBy(ID).agg(F.max_by(F.struct(*full.names[1:]), "run").alias("_r")).select(ID, "_r.*")
    released = _path(root, "released", name)
    if FS.path_exists(spark, released):
        rows = rows.join(spark.read.schema(f"{ID} string").parquet(released), ID, "left_anti")
    return rows


def replay(spark: SparkSession, root: str, name: str, schema: T.StructType, mended: DataFrame, mode: str, keys: Sequence[str], order_col: str,
           rules: Sequence[Q.Rule]) -> dict:
    """Merge mended quarantine records (``quarantined`` rows with changed columns); returns {new, updated, released, superseded, kept}.

    Those that now keep every rule enter the table and leave the quarantine; the others stay there as they were. In pair mode a record older than the table's
    row of its key is superseded: it leaves the quarantine, and the table keeps its row. Rows with an id that isn't open
    are ignored, so a replay that failed between the merge and the release can be repeated."""
    open_ids = quarantined(spark, root, name, schema).select(ID)
    checked = Q.violations(mended.drop(BROKEN).join(open_ids, ID, "left_semi"), rules).checkpoint()
    good = checked.where(F.size(BROKEN) == 0)
    entering = good
    if mode == "pair":
        now = TB.read_table(spark, root, name, schema, keys).select(F.struct(*keys).alias("_k"), F.col(order_col).alias("_now"))
        good = M.with_key(good, keys)
        entering = good.join(now, (good[M.KEY] == now["_k"]) & (now["_now"] > good[order_col]), "left_anti").drop(M.KEY).checkpoint()
    superseded = good.count() - entering.count()
    out = TB.merge_into(spark, root, name, schema, entering.drop(BROKEN, ID), mode, keys, order_col)
    ids = good.select(ID).distinct()
    ids.write.mode("append").parquet(_path(root, "released", name))
    n = checked.agg(F.count_distinct(F.when(F.size(BROKEN) == 0, F.col(ID))), F.count(F.when(F.size(BROKEN) > 0, True))).first()
    return {"new": out["new"], "updated": out["updated"], "released": n[0], "superseded": superseded, "kept": n[1]}
