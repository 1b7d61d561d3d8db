"""File sources and sinks.

Tables are written as versioned Parquet folders: a new version goes to
``<root>/<name>/v=<n>`` and only counts once Spark's committer has written
its ``_SUCCESS`` marker, so a reader never sees a half-written table and a
rewrite never overwrites the files it reads from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X


# --- Hadoop file system helpers (driver-side metadata only) --------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def committed_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    base = f"{root.rstrip('/')}/{name}"
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        n = st.getPath().getName()
        if n.startswith("v=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            try:
                out.append(int(n[2:]))
            except ValueError:
                continue
    return sorted(out)


# --- S3 / S4 tables ---------------------------------------------------------------

def load_table(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """S3: latest committed Parquet version, else ``<name>.csv`` with the
    schema applied, else an empty frame with the schema."""
    versions = committed_versions(spark, root, name)
    if versions:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}/v={versions[-1]}")
    csv = f"{root.rstrip('/')}/{name}.csv"
    if path_exists(spark, csv):
        raw = read_csv_text(spark, csv)
        return raw.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in raw.columns
                             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    return spark.createDataFrame([], schema)


def write_version(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                  version: int | None = None) -> int:
    """Write ``df`` as the next version (or the given one, for idempotent
    retries); returns the version number."""
    spark = df.sparkSession
    if version is None:
        versions = committed_versions(spark, root, name)
        version = (versions[-1] + 1) if versions else 1
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/{name}/v={version}")
    return version


# --- S5 / S6 CSV --------------------------------------------------------------------

def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header CSV with every column as text (no inference pass); quoted
    fields may hold commas and doubled quotes (RFC 4180). ``multiline`` also
    accepts line breaks inside quoted fields, at the price of reading each
    file in one task (such files cannot be split), so it is opt-in."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", multiline) \
        .option("escape", '"').csv(path)


# What pandas reads as a truth value, in any of its spellings.
_TRUTH = "(?i)true|false"
_WHOLE = r"[ \t]*[+-]?[0-9]+[ \t]*"


def infer_types(df: DataFrame) -> dict[str, str]:
    """Column -> type of a frame of text columns, from all of its rows in one aggregation.

    A column's values are folded up the lattice nothing < whole number < number, nothing < truth value, anything else text: ``bigint`` if all are whole numbers
    of at most 18 digits, ``double`` if all are numbers (or there is none), ``boolean`` if all are true / false, else ``string``. Missing-value tokens say
    nothing. Only one row of counts reaches the driver.
    """
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    counts = []
    for i, name in enumerate(text):
        v = X.na_to_null(F.col(f"`{name}`"))
        whole = v.rlike(f"^{_WHOLE}$") & (F.length(F.regexp_replace(v, "[^0-9]", "")) <= 18)
        for kind, told in (("n", v.isNotNull()), ("whole", whole), ("number", X.safe_double(v).isNotNull()), ("truth", v.rlike(f"^({_TRUTH})$"))):
            counts.append(F.count(F.when(told, True)).alias(f"{kind}_{i}"))
    if not text:
        return {f.name: f.dataType.simpleString() for f in df.schema.fields}
    got = df.agg(*counts).first()
    out = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for i, name in enumerate(text):
        n = got[f"n_{i}"]
        kinds = [("bigint", "whole"), ("double", "number"), ("boolean", "truth")]
        out[name] = "double" if not n else next((t for t, kind in kinds if got[f"{kind}_{i}"] == n), "string")
    return out


def cast_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to their inferred types, missing-value tokens as null."""
    cols = []
    for f in df.schema.fields:
        v = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "string":
            v = X.na_to_null(v)
            t = types.get(f.name, "string")
            v = X.safe_double(v) if t == "double" else F.trim(v).try_cast(t) if t != "string" else v
        cols.append(v.alias(f.name))
    return df.select(*cols)


def read_csv_typed(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S3: header CSV with types inferred from all rows (``infer_types``)."""
    raw = read_csv_text(spark, path, multiline)
    return cast_types(raw, infer_types(raw))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV with RFC 4180 quoting (quotes doubled, as pandas writes)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


# --- S7 / S8 JSON lines ---------------------------------------------------------------

def append_json_lines(df: DataFrame, path: str) -> None:
    """Append records (e.g. one run-log row) as JSON lines."""
    df.write.mode("append").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with an explicit schema; blank and malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


# --- S10 text tree ----------------------------------------------------------------------

def read_text_tree(spark: SparkSession, root: str, suffixes=("py", "md", "ipynb")) -> DataFrame:
    """Whole text of every file below ``root`` with one of the suffixes,
    skipping any path with a segment that starts with a dot."""
    glob = "*.{" + ",".join(suffixes) + "}"
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob) \
        .text(root, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    rel = F.expr(f"substring(path, {len(_as_uri_prefix(root)) + 1})")
    return df.where(~rel.rlike(r"(^|/)\."))


def _as_uri_prefix(root: str) -> str:
    r = root.rstrip("/")
    return ("file:" + r if r.startswith("/") else r) + "/"


# --- S11 / S13 sinks -------------------------------------------------------------------

def write_document(doc: DataFrame, path: str) -> None:
    """A one-row nested document as a single JSON file; null fields are written as null."""
    doc.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_enriched(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S13."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
