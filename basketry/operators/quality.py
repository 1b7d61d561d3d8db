"""Data-quality and contract operators (Q1-Q7).

* schema drift between batches: key -> type profile of JSON payloads per
  batch, compared batch to batch with joins (Q1); table schema snapshots
* completeness profile: presence and non-NULL share of required columns (Q2, Q3)
* contract validation of every record: required / type / enum / pattern /
  minimum rules, violations exploded and counted, good/bad split (Q4)
* file manifest integrity: listed vs actual size and sha-256 (Q5, Q7)
* term scan over whole texts with +/-20 characters of context (Q6)
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- Q1 schema drift ------------------------------------------------------------


def schema_snapshot(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Ordered (position, column, dtype) list of a table (metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, dtype string")


def compare_snapshots(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """added / removed / retyped / moved columns; no previous snapshot means
    every column counts as added (first run is a diff)."""
    if previous is None:
        return current.select("column", F.lit("added").alias("change"), F.lit(None).cast("string").alias("old_dtype"),
                              F.col("dtype").alias("new_dtype"))
    p = previous.select(F.col("column"), F.col("position").alias("p_pos"), F.col("dtype").alias("old_dtype"))
    c = current.select(F.col("column"), F.col("position").alias("c_pos"), F.col("dtype").alias("new_dtype"))
    j = p.join(c, "column", "full_outer")
    change = (F.when(F.col("p_pos").isNull(), "added").when(F.col("c_pos").isNull(), "removed")
              .when(F.col("old_dtype") != F.col("new_dtype"), "retyped")
              .when(F.col("p_pos") != F.col("c_pos"), "moved"))
    return j.select("column", change.alias("change"), "old_dtype", "new_dtype").where(F.col("change").isNotNull())


def json_key_profile(df: DataFrame, batch_col: str, json_col: str) -> DataFrame:
    """Per batch: every top-level key of the JSON objects with its value type
    and how many records carry it. Values are parsed as VARIANT, so no
    schema-inference pass over the data is needed; malformed records carry no keys."""
    parsed = df.select(F.col(batch_col).alias("batch"),
                       F.from_json(F.col(json_col), "map<string,variant>").alias("m"))
    # explode_outer: a plain explode makes Spark infer size(m) > 0 below the
    # generator and evaluate from_json twice
    kv = parsed.select("batch", F.explode_outer("m").alias("key", "value")).where(F.col("key").isNotNull())
    return kv.groupBy("batch", "key", F.schema_of_variant("value").alias("type")) \
        .agg(F.count(F.lit(1)).alias("records"))


def json_schema_drift(df: DataFrame, batch_col: str, json_col: str) -> DataFrame:
    """Key/type changes between consecutive batches (first batch: all added)."""
    prof = json_key_profile(df, batch_col, json_col).select("batch", "key", "type").distinct()
    batches = prof.select("batch").distinct()
    order = batches.withColumn("seq", F.dense_rank().over(Window.orderBy("batch")))
    prof = prof.join(order, "batch")
    prev = prof.select((F.col("seq") + 1).alias("seq"), "key", F.col("type").alias("old_type"))
    cur = prof.select("seq", "batch", "key", F.col("type").alias("new_type"))
    # keys of the previous batch that are absent now need the current batch id
    j = cur.join(prev, ["seq", "key"], "full_outer").join(order.select("seq", F.col("batch").alias("b2")), "seq")
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "retyped"))
    return j.select(F.col("b2").alias("batch"), "key", change.alias("change"), "old_type", "new_type") \
        .where(F.col("change").isNotNull())


# --- Q2 / Q3 completeness ------------------------------------------------------------

def completeness(df: DataFrame, required: Sequence[str], batch_col: str | None = None) -> DataFrame:
    """Per required column (and batch): present flag and share of non-NULL rows."""
    present = [c for c in required if c in df.columns]
    keys = [batch_col] if batch_col else []
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(c) for c in present]
    wide = df.groupBy(*keys).agg(*aggs)
    if present:
        long = wide.unpivot([*keys, "_rows"], present, "column", "_nn")
    else:
        long = wide.select(*keys, "_rows", F.lit(None).cast("string").alias("column"),
                           F.lit(None).cast("bigint").alias("_nn")).where(F.lit(False))
    out = long.select(*keys, "column", F.lit(True).alias("present"),
                      F.try_divide(F.col("_nn").cast("double"), F.col("_rows").cast("double")).alias("non_null_ratio"))
    missing = [c for c in required if c not in df.columns]
    for c in missing:
        # an absent column: one row per batch (or one row), present = false
        miss = wide.select(*keys, F.lit(c).alias("column"), F.lit(False).alias("present"),
                           F.lit(None).cast("double").alias("non_null_ratio"))
        out = out.unionByName(miss)
    return out


# --- Q4 contract validation -------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str              # required | type | enum | pattern | minimum
    arg: object = None


def rule_violation(rule: Rule):
    c = F.col(rule.column)
    if rule.kind == "required":
        return c.isNull()
    if rule.kind == "type":
        return c.isNotNull() & c.cast("string").try_cast(rule.arg).isNull()
    if rule.kind == "enum":
        return c.isNotNull() & ~c.isin(*rule.arg)
    if rule.kind == "pattern":
        return c.isNotNull() & ~c.rlike(rule.arg)
    if rule.kind == "minimum":
        return c.isNotNull() & (c < F.lit(rule.arg))
    raise ValueError(f"unknown rule kind {rule.kind}")


def violations(df: DataFrame, rules: Sequence[Rule], allowed_columns: Sequence[str] | None = None) -> DataFrame:
    """Adds ``violations``: array of the names of the rules a record breaks.
    Columns outside ``allowed_columns`` ("no extra properties") are reported
    per record as 'extra:<column>' when they hold a value."""
    checks = [F.when(rule_violation(r), F.lit(r.name)) for r in rules]
    if allowed_columns is not None:
        extra = [c for c in df.columns if c not in allowed_columns]
        checks += [F.when(F.col(c).isNotNull(), F.lit(f"extra:{c}")) for c in extra]
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn("violations", arr)


def violation_counts(df: DataFrame, rules: Sequence[Rule], allowed_columns: Sequence[str] | None = None) -> DataFrame:
    """Records breaking each rule (rules nobody breaks are left out). One
    conditional count per rule in a single aggregation: no per-record arrays."""
    checks = [(r.name, rule_violation(r)) for r in rules]
    if allowed_columns is not None:
        checks += [(f"extra:{c}", F.col(c).isNotNull()) for c in df.columns if c not in allowed_columns]
    if not checks:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    wide = df.agg(*[F.count(F.when(cond, True)).alias(f"_{i}") for i, (_, cond) in enumerate(checks)])
    names = F.array(*[F.lit(n) for n, _ in checks])
    long = wide.unpivot([], [f"_{i}" for i in range(len(checks))], "_r", "violations")
    return long.select(F.element_at(names, F.substring("_r", 2, 10).cast("int") + 1).alias("rule"), "violations") \
        .where(F.col("violations") > 0)


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    v = violations(df, rules)
    return v.where(F.size("violations") == 0).drop("violations"), v.where(F.size("violations") > 0)


# --- Q5 / Q7 manifest integrity ----------------------------------------------------------

def file_fingerprints(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, size_bytes, sha256) of every file under ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", glob).load(root)
    return files.select(F.col("path"), F.col("length").alias("size_bytes"), F.sha2(F.col("content"), 256).alias("sha256"))


def manifest_check(listed: DataFrame, actual: DataFrame, key: str = "path") -> DataFrame:
    """Full outer join of the manifest with what exists:
    ok / missing / unexpected / size_mismatch / hash_mismatch (per entry)."""
    lst = listed.select(F.col(key), F.col("size_bytes").alias("listed_size"), F.col("sha256").alias("listed_sha256"),
                        F.lit(True).alias("_listed"))
    act = actual.select(F.col(key), F.col("size_bytes").alias("actual_size"), F.col("sha256").alias("actual_sha256"),
                        F.lit(True).alias("_actual"))
    j = lst.join(act, key, "full_outer")
    status = (F.when(F.col("_actual").isNull(), "missing").when(F.col("_listed").isNull(), "unexpected")
              .when(F.col("listed_sha256").isNotNull() & (F.col("listed_sha256") != F.col("actual_sha256")),
                    "hash_mismatch")
              .when(F.col("listed_size").isNotNull() & (F.col("listed_size") != F.col("actual_size")), "size_mismatch")
              .otherwise("ok"))
    return j.select(key, "listed_size", "actual_size", "listed_sha256", "actual_sha256", status.alias("status"))


# --- Q6 term scan ----------------------------------------------------------------------------

# Fixed term list of the reference's language guard (Portuguese words).
REFERENCE_TERMS = [r"\bproduto(s)?\b", r"\bpedido(s)?\b", r"\bpreço\b", r"\bcategoria(s)?\b", r"\bfonte(s)?\b",
                   r"\bexecução\b", r"\bcriado\b", r"\batualizado\b"]
CONTEXT_CHARS = 20


def _strip_bounds(p: str) -> str:
    if p.startswith(r"\b"):
        p = p[2:]
    if p.endswith(r"\b"):
        p = p[:-2]
    return p


def term_matches(df: DataFrame, text_col: str, id_col: str, patterns: Sequence[str] = REFERENCE_TERMS,
                 context: int = CONTEXT_CHARS) -> DataFrame:
    """Every case-insensitive whole-word match of any pattern in the whole
    text, with ``context`` characters either side (newlines -> spaces).

    One regular expression carries all terms, a bounded look-behind captures
    the left context and a look-ahead the right one, so each text is scanned
    three times in the JVM (match, left, right) whatever the number of terms.
    Terms are whole words, so matches of different terms never overlap."""
    bodies = [_strip_bounds(p) for p in patterns]
    alt = "|".join(f"(?:{b})" for b in bodies)
    n_inner = re.compile(alt).groups
    left = rf"(\A.{{0,{context - 1}}}|.{{{context}}})"
    # the cheap look-ahead runs first at word boundaries, so the bounded
    # look-behind is only evaluated where a term actually starts
    rx = rf"(?isU)\b(?=(?:{alt})\b)(?<={left})(?:{alt})\b(?=(.{{0,{context}}}))"
    left_group = n_inner + 1
    right_group = 2 * n_inner + 2
    # a guard mostly finds nothing: one cheap pass decides whether the three
    # extraction passes are needed at all
    any_term = F.col(text_col).rlike(rf"(?iU)\b(?:{alt})\b")
    arrays = df.where(any_term).select(
        F.col(id_col).alias(id_col),
        F.regexp_extract_all(F.col(text_col), F.lit(rx), 0).alias("_m"),
        F.regexp_extract_all(F.col(text_col), F.lit(rx), left_group).alias("_l"),
        F.regexp_extract_all(F.col(text_col), F.lit(rx), right_group).alias("_r"))
    # posexplode_outer keeps Spark from inferring a size() filter that would
    # run the regex extraction a second time; texts without a match are dropped after
    rows = arrays.select(id_col, F.posexplode_outer(F.arrays_zip("_m", "_l", "_r")).alias("occurrence", "z")) \
        .where(F.col("z").isNotNull())
    term = F.coalesce(*[F.when(F.col("z._m").rlike(rf"(?iU)^(?:{b})$"), F.lit(p)) for b, p in zip(bodies, patterns)])
    ctx = F.regexp_replace(F.concat(F.col("z._l"), F.col("z._m"), F.col("z._r")), "\n", " ")
    return rows.select(id_col, "occurrence", term.alias("term"), F.col("z._m").alias("match"), ctx.alias("context"))


def term_counts(df: DataFrame, text_col: str, id_col: str, patterns: Sequence[str] = REFERENCE_TERMS) -> DataFrame:
    """Matches per (id, term): one regex pass over each text collects every
    match of any term; the short matches are then assigned to their term."""
    bodies = [_strip_bounds(p) for p in patterns]
    alt = "|".join(f"(?:{b})" for b in bodies)
    found = df.select(F.col(id_col), F.regexp_extract_all(F.col(text_col), F.lit(rf"(?iU)\b(?:{alt})\b"), 0)
                      .alias("_m"))
    # explode_outer: a plain explode would make Spark run the regex twice
    rows = found.select(id_col, F.explode_outer("_m").alias("m")).where(F.col("m").isNotNull())
    term = F.coalesce(*[F.when(F.col("m").rlike(rf"(?iU)^(?:{b})$"), F.lit(p)) for b, p in zip(bodies, patterns)])
    return rows.groupBy(id_col, term.alias("term")).agg(F.count(F.lit(1)).alias("n"))
