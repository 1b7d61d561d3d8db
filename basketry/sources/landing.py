"""Raw landing zone.

Layout (Hive-style partitions, so provider filters prune whole folders):

    <root>/provider=<p>/resource=<r>/run_id=<run>/part-*.txt   (one JSON record per line)

The reference keeps one file per (provider, resource, run) named
``<ts>_<run>[_tag].json``; here the run and an optional tag are partition
values and the files are written by Spark in parallel.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..session import ensure_checkpoint_dir
from . import files as FS


# A landed file below the root.
_RUN_FILE = r"provider=[^/]+/resource=[^/]+/run_id=[^/]+/[^/]+$"


@dataclass(frozen=True)
class Claim:
    """The landed files that a pass takes: (file, path, provider, run_id, modified), written once to the shared folder."""

    files: DataFrame
    n: int
    providers: tuple[str, ...]


def claim(spark: SparkSession, root: str, resources: dict[str, str], merged: DataFrame | None = None) -> Claim | None:
    """The files of the given provider -> resource pairs that aren't in ``merged`` (file), None without any. No file is opened, and
    nothing of a file but its listing reaches the driver."""
    folders = [f"{root.rstrip('/')}/provider={p}/resource={r}" for p, r in resources.items()]
    folders = [f for f in folders if FS.path_exists(spark, f)]
    if not folders:
        return None
    # the content column isn't selected: Spark only lists the files
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders) \
        .select("path", F.col("modificationTime").alias("modified"), F.regexp_extract("path", _RUN_FILE, 0).alias("file")).where(F.col("file") != "")
    if merged is not None:
        files = files.join(merged, "file", "left_anti")
    part = lambda name: F.url_decode(F.regexp_extract("file", f"{name}=([^/]+)/", 1))
    ensure_checkpoint_dir(spark)
    files = files.select("file", "path", part("provider").alias("provider"), part("run_id").alias("run_id"), "modified").checkpoint()
    got = files.agg(F.count(F.lit(1)), F.collect_set("provider")).first()
    return Claim(files, got[0], tuple(sorted(got[1]))) if got[0] else None


def write_raw(records: DataFrame, root: str, provider: str, resource: str, run_id: str,
              tag: str | None = None, json_col: str = "json") -> None:
    """Append JSON-text records for one provider/resource/run."""
    run = run_id if not tag else f"{run_id}_{tag}"
    out = records.select(F.col(json_col).alias("value"),
                         F.lit(provider).alias("provider"), F.lit(resource).alias("resource"),
                         X.tag_slug(F.lit(run)).alias("run_id"))
    out.write.mode("append").partitionBy("provider", "resource", "run_id").text(root)


def _lines(raw: DataFrame) -> DataFrame:
    """Landed lines with their file and position; blank lines are no records."""
    pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"), F.lit(0).alias("item"))
    return raw.select("provider", "run_id", F.col("value").alias("json"), F.col("_metadata.file_path").alias("raw_file"), pos.alias("_pos")) \
        .where(F.trim("json") != "")


def _first_per_provider(lines: DataFrame, limit: int | None) -> DataFrame:
    if not limit:
        return lines
    # row_number <= n is planned as a group limit: every task keeps at most
    # n rows per provider before the shuffle
    w = Window.partitionBy("provider").orderBy("_pos")
    return lines.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")


def _typed(lines: DataFrame, schema: T.StructType, hash_scope: str) -> DataFrame:
    lines = lines.withColumn("_rec_hash", X.canonical_json_hash(F.col("json")))
    if hash_scope == "batch":
        per_run = lines.groupBy("provider", "run_id").agg(X.multiset_digest("_rec_hash").alias("raw_hash"))
        # A run is one join key: shuffling the records on it would put a whole
        # run into one task. There is one digest for each run folder, and the
        # driver has listed those folders, so the digests are always broadcast.
        lines = lines.join(F.broadcast(per_run), ["provider", "run_id"])
    elif hash_scope == "record":
        lines = lines.withColumn("raw_hash", F.col("_rec_hash"))
    else:
        raise ValueError(f"unknown hash_scope {hash_scope}")
    return lines.select("provider", "run_id", F.from_json("json", schema).alias("payload"), "raw_file", "raw_hash")


def read_raw(spark: SparkSession, root: str, schema: T.StructType, resource: str,
             providers: Sequence[str] | None = None, hash_scope: str = "batch",
             limit_per_provider: int | None = None) -> DataFrame:
    """S1 (+ S12): typed payloads of one resource with ``raw_file`` and ``raw_hash``.

    ``hash_scope='batch'`` gives every record of a landed batch (one provider
    run, however many files Spark wrote for it) the same order-insensitive
    digest of all its records, like the reference (K8);
    ``'record'`` hashes each record on its own. ``limit_per_provider`` keeps
    the first n records of each provider in file order. Lines that are no JSON
    object are left out (``rejected`` returns them)."""
    raw = spark.read.text(root).where(F.col("resource") == resource)
    if providers:
        raw = raw.where(F.col("provider").isin(*providers))
    good = _lines(raw).where(X.is_json_object("json"))
    return _typed(_first_per_provider(good, limit_per_provider), schema, hash_scope)


def claimed_lines(spark: SparkSession, root: str, taken: Claim, group: int = 10_000) -> DataFrame:
    """The lines of the claimed files: provider, run_id, json, raw_file, _pos, ``_good`` (a JSON object) and ``_rec_hash`` (its digest, null for others).

    At most ``group`` paths are in the driver and in a plan at once: more files are written as one table of lines, group by group. Digests, rejected lines, rows
    and marks go by the same files even if more land meanwhile."""
    paths = (r["path"] for r in taken.files.select("path").toLocalIterator())

    def lines(some: list[str]) -> DataFrame:
        # text by schema: inferred types would turn run 0017 into 17
        raw = spark.read.schema("value string, provider string, resource string, run_id string").option("basePath", root).text(some)
        return _lines(raw).withColumn("_good", X.is_json_object("json")).withColumn("_rec_hash", F.when(F.col("_good"), X.canonical_json_hash("json")))

    if taken.n <= group:
        return lines(list(paths))
    folder = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    while some := list(itertools.islice(paths, group)):
        lines(some).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def survey(taken: Claim, lines: DataFrame) -> DataFrame:
    """(provider, run_id, raw_hash, rejected, _run): of each run the digest of its records, the number of lines that are no JSON object, and its place.

    Runs are taken in the order in which the first of their files landed, by the files' own times; of equal or missing times the smaller run id, then the
    smaller provider comes first. One row for each run, written."""
    order = Window.orderBy(F.col("landed").asc_nulls_first(), "run_id", "provider")
    place = taken.files.groupBy("provider", "run_id").agg(F.min("modified").alias("landed")).withColumn("_run", F.row_number().over(order) - 1)
    seen = lines.groupBy("provider", "run_id").agg(X.multiset_digest("_rec_hash").alias("raw_hash"), F.count(F.when(~F.col("_good"), True)).alias("rejected"))
    return seen.join(place, ["provider", "run_id"]).drop("landed").checkpoint()


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON object, with their text."""
    return lines.where(~F.col("_good")).select("provider", "run_id", "raw_file", "json")


def typed_records(lines: DataFrame, runs: DataFrame, schema: T.StructType, stamp: Column, hash_scope: str = "batch",
                  limit_per_provider: int | None = None, bound: int = 100_000) -> DataFrame:
    """Typed payloads of ``claimed_lines``, with ``_pos`` and each run's own ``_stamp``: ``stamp`` plus a microsecond
    for every run before it, so that a later run has the later stamp. ``runs``: ``survey``'s table; up to ``bound`` of its rows are broadcast."""
    if hash_scope not in ("batch", "record"):
        raise ValueError(f"unknown hash_scope {hash_scope}")
    good = _first_per_provider(lines.where("_good"), limit_per_provider)
    of_run = runs.select("provider", "run_id", "raw_hash", "_run")
    # a run is one join key: beyond the bound adaptive execution splits the lines of a long one
    good = good.join(F.broadcast(of_run) if of_run.count() <= bound else of_run, ["provider", "run_id"])
    own = stamp + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_run") / 1e6).cast("decimal(18,6)"))
    digest = F.col("raw_hash") if hash_scope == "batch" else F.col("_rec_hash")
    return good.select("provider", "run_id", F.from_json("json", schema).alias("payload"), "raw_file", digest.alias("raw_hash"), "_pos", own.alias("_stamp"))


def merged_files(spark: SparkSession, table_root: str, entity: str) -> DataFrame | None:
    """(file): the landed files, below the landing's root, whose records are in the table already. Marks
    without a file (older tables) count for nothing: such runs are merged once more."""
    path = f"{table_root.rstrip('/')}/_merged/{entity}"
    if not FS.path_exists(spark, path):
        return None
    return spark.read.schema("file string").json(path).where(F.col("file").isNotNull())


def mark_merged(spark: SparkSession, table_root: str, entity: str, taken: Claim) -> None:
    """Recorded after the rows are in: a run that fails in between is merged again, which changes nothing."""
    FS.append_json_lines(taken.files.select("provider", "run_id", "file"), f"{table_root.rstrip('/')}/_merged/{entity}")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Multi-line JSON files (one document or a top-level list per file)."""
    return spark.read.schema(schema).option("multiLine", True).json(path) \
        .withColumn("raw_file", F.col("_metadata.file_path"))


# Fixed file-name layout of landed provider documents:
#   <root>/<provider>/<resource>/<timestamp>_<run_id>[_<tag>].json
_DOC_NAME = r"/([^/]+)/([^/]+)/([0-9TZ:.\-]+)_([0-9A-Za-z]+)(?:_([^/]*))?\.json$"


def read_landed_documents(spark: SparkSession, root: str, schema: T.StructType, resource: str,
                          providers: Sequence[str] | None = None, hash_scope: str = "batch") -> DataFrame:
    """S1 for landings kept as one JSON document per provider response
    (a top-level list yields one row per element, an object one row).
    Provider, resource, run and tag come from the path; every row of one file
    shares the file's order-insensitive digest (``hash_scope='batch'``)."""
    provs = "{" + ",".join(providers) + "}" if providers else "*"
    glob = f"{root.rstrip('/')}/{provs}/{resource}/*.json"
    raw = spark.read.text(glob, wholetext=True)
    path = F.col("_metadata.file_path")
    docs = raw.select(path.alias("raw_file"), F.col("value").alias("doc"))
    items = docs.select(
        "raw_file",
        F.regexp_extract("raw_file", _DOC_NAME, 1).alias("provider"),
        F.regexp_extract("raw_file", _DOC_NAME, 4).alias("run_id"),
        F.nullif(F.regexp_extract("raw_file", _DOC_NAME, 5), F.lit("")).alias("tag"),
        F.when(F.trim("doc").startswith("["), F.from_json("doc", T.ArrayType(T.StringType())))
        .otherwise(F.array(F.col("doc"))).alias("records"))
    # explode_outer: a plain explode would make Spark evaluate from_json twice
    rows = items.select("raw_file", "provider", "run_id", "tag", F.explode_outer("records").alias("json")) \
        .where(F.col("json").isNotNull())
    rows = rows.withColumn("_rec_hash", X.canonical_json_hash(F.col("json")))
    if hash_scope == "batch":
        per_file = rows.groupBy("raw_file").agg(X.multiset_digest("_rec_hash").alias("raw_hash"))
        # one file is one task here anyway (whole-text read), so its records may share a join key
        rows = rows.join(per_file, "raw_file")
    else:
        rows = rows.withColumn("raw_hash", F.col("_rec_hash"))
    return rows.select("provider", "run_id", "tag", F.from_json("json", schema).alias("payload"), "raw_file",
                       "raw_hash")
