"""The KPI report as one nested document (S11, A16-A19, Q4 on the contract).

The document is a one-row DataFrame whose nested columns are filled by
scalar subqueries over the product / order / run-log tables, so the heavy
lifting stays distributed; only the final single row is written (as JSON).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as FE
from ..operators import kpis as K
from ..operators import runlog as RL

SCHEMA_VERSION = "1.0.0"
# Fixed top-level keys: the contract's required keys plus the ones the
# reference's own test demands (K12: the union of both).
REQUIRED_TOP_LEVEL = ["schema_version", "generated_at_utc", "inputs", "kpis", "figures", "narrative",
                      "data_availability", "integrity", "paths", "products", "orders", "enriched"]
ALLOWED_TOP_LEVEL = REQUIRED_TOP_LEVEL + ["run_logs", "notes", "$schema"]
# Fixed enums of the report contract.
KEY_MODES = ("pair", "triple")
FAKE_MODES = ("none", "fake", "fake-only")


def _row(df: DataFrame) -> Column:
    return K.scalar_row(df)


def _top10_array(df: DataFrame) -> Column:
    top = K.top_values(df, "source", 10)
    arr = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("k"), F.col("source"),
                                                       F.col("count"), F.col("ratio")))).alias("a"))
    # reshape inside the subquery: subqueries may not sit inside higher-order functions
    arr = arr.select(F.transform("a", lambda x: F.struct(x["source"].alias("source"), x["count"].alias("count"),
                                                          x["ratio"].alias("ratio"))).alias("a"))
    return _row(arr)["a"]


def _provider_map(df: DataFrame) -> Column:
    m = K.value_counts(df, "source").agg(F.map_from_entries(F.collect_list(F.struct("source", "count"))).alias("m"))
    return _row(m)["m"]


def latest_rolling(orders_enriched: DataFrame, metrics=("gmv_7d", "orders_7d", "aov_7d"),
                   date_col: str = "created_at") -> DataFrame:
    """Last non-NULL value of every rolling metric in date order."""
    return orders_enriched.agg(*[F.max_by(F.col(m), F.when(F.col(m).isNotNull(), F.col(date_col))).alias(m)
                                 for m in metrics])


def build_report(products: DataFrame, orders: DataFrame, run_log: DataFrame | None = None,
                 providers: Sequence[str] = (), key_mode: str = "triple", seed: int | None = None,
                 limit: int | None = None, figures: DataFrame | None = None,
                 expected_figures: Sequence[str] = (), generated_at: str | None = None) -> DataFrame:
    spark: SparkSession = products.sparkSession
    generated_at = generated_at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    prices = K.price_quantiles(products)    # one ranking of the price for the summary, the fences and the buckets
    ps = _row(K.product_summary(products, q=prices))
    dk = _row(K.duplicate_keys(products))
    out2 = _row(K.outliers_two_sided(products, q=prices))
    osum = _row(K.order_summary(orders))
    pe = FE.enrich_products(products, q=prices)
    oe = FE.enrich_orders(orders)
    buckets = K.bucket_distribution(pe).agg(F.sort_array(F.collect_list(F.struct(
        F.col("price_bucket").cast("string").alias("bucket"), F.col("count"), F.col("ratio")))).alias("a"))
    roll = _row(latest_rolling(oe))
    base = products.agg(F.count(F.lit(1)).alias("products_rows"))
    base = K.attach(base, orders.agg(F.count(F.lit(1)).alias("orders_rows")))

    products_section = F.struct(
        ps["count"].alias("count"), ps["distinct_sources"].alias("distinct_sources"),
        ps["top_category"].alias("top_category"),
        F.struct(ps["price_min"].alias("min"), ps["price_median"].alias("median"), ps["price_mean"].alias("mean"),
                 ps["price_p90"].alias("p90"), ps["price_max"].alias("max"), out2["iqr"].alias("iqr"),
                 out2["fence_lower"].alias("fence_lower"), out2["fence_upper"].alias("fence_upper")).alias("price"),
        dk["duplicate_key_pairs"].alias("duplicate_logical_key_pairs"),
        dk["duplicate_key_ratio"].alias("duplicate_logical_key_ratio"),
        out2["outlier_price_ratio"].alias("outlier_price_ratio"),
        _top10_array(products).alias("sources_top10"))
    orders_section = F.struct(
        osum["count"].alias("count"), osum["timespan_days"].alias("timespan_days"),
        F.struct(osum["gmv_total"].alias("total"), osum["gmv_mean"].alias("mean"),
                 osum["gmv_median"].alias("median")).alias("gmv"),
        _top10_array(orders).alias("sources_top10"))
    kpis = F.struct(
        F.col("products_rows").alias("products_total"), _provider_map(products).alias("products_by_provider"),
        F.lit(None).cast("bigint").alias("products_new"), F.lit(None).cast("bigint").alias("products_updated"),
        out2["outlier_count"].alias("products_outliers_price"),
        F.col("orders_rows").alias("orders_total"), _provider_map(orders).alias("orders_by_provider"),
        F.lit(None).cast("bigint").alias("orders_outliers_total"),
        osum["gmv_mean"].alias("aov_mean"), osum["gmv_median"].alias("aov_median"))
    enriched = F.struct(
        F.struct(F.array(*[F.lit(c) for c in K.columns_like(pe, suffixes=("_freq",), exact=(
            "price_num", "price_log", "price_bucket"))]).alias("columns"),
                 _row(buckets)["a"].alias("price_bucket_distribution")).alias("products"),
        F.struct(F.array(*[F.lit(c) for c in K.columns_like(oe, suffixes=("_7d",), exact=(
            "order_value_num", "recency_days"))]).alias("columns"),
                 F.struct(roll["gmv_7d"].alias("gmv_7d"), roll["orders_7d"].alias("orders_7d"),
                          roll["aov_7d"].alias("aov_7d")).alias("latest_rolling_7d")).alias("orders"))
    if figures is not None:
        figs = figures.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path",
                              F.lit("figures").alias("section"), "sha256", "size_bytes")
        fig_frame = figs.agg(F.sort_array(F.collect_list(F.struct("name", "path", "section", "sha256",
                                                                  "size_bytes"))).alias("a"))
        fig_frame = fig_frame.select("a", F.transform("a", lambda x: x["name"]).alias("ids"))
        fr = _row(fig_frame)
        fig_arr, fig_ids = fr["a"], fr["ids"]
    else:
        fig_arr = F.array().cast("array<struct<name:string,path:string,section:string,sha256:string,size_bytes:bigint>>")
        fig_ids = F.array().cast("array<string>")
    expected = F.array(*[F.lit(e) for e in expected_figures]).cast("array<string>")
    integrity = F.struct(F.size(fig_arr).cast("bigint").alias("figure_count"), fig_ids.alias("figure_ids"),
                         expected.alias("expected_figures"),
                         F.array_except(expected, fig_ids).alias("missing_figures"))
    cols = [
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at_utc"),
        F.struct(F.array(*[F.lit(p) for p in providers]).cast("array<string>").alias("providers"),
                 F.lit(key_mode).alias("dedup_key_mode"), F.lit(seed).cast("bigint").alias("seed"),
                 F.lit(limit).cast("bigint").alias("limit"), F.lit("none").alias("fake_mode")).alias("inputs"),
        kpis.alias("kpis"), fig_arr.alias("figures"),
        F.struct(F.concat(F.lit("Products: "), F.col("products_rows").cast("string"), F.lit(", orders: "),
                          F.col("orders_rows").cast("string"), F.lit(".")).alias("summary"),
                 F.lit("KPIs, distributions and quality measures computed on the unified tables.").alias("details"))
        .alias("narrative"),
        F.struct(F.col("products_rows"), F.col("orders_rows"), F.lit(True).alias("products_enriched"),
                 F.lit(True).alias("orders_enriched")).alias("data_availability"),
        integrity.alias("integrity"),
        F.struct(F.lit("tables/products").alias("products"), F.lit("tables/orders").alias("orders")).alias("paths"),
        products_section.alias("products"), orders_section.alias("orders"), enriched.alias("enriched"),
    ]
    if run_log is not None:
        rl = _row(RL.rollup(run_log))
        cols.append(rl.alias("run_logs"))
    return base.select(*cols)


# --- Q4 on the report contract ---------------------------------------------------

# Fixed: keys that the contract requires (a built report has all of REQUIRED_TOP_LEVEL).
CONTRACT_REQUIRED = ["schema_version", "generated_at_utc", "inputs", "kpis", "figures", "narrative",
                     "data_availability", "integrity"]
# Fixed contract of the nested sections: field -> type ("?": may be null), and whether other fields are allowed.
SECTIONS = {
    "inputs": (False, {"providers": "strings", "dedup_key_mode": "string", "seed": "integer?", "limit": "integer?",
                       "fake_mode": "string"}),
    "kpis": (True, {"products_total": "integer?", "products_by_provider": "counts", "products_new": "integer?",
                    "products_updated": "integer?", "products_outliers_price": "integer?", "orders_total": "integer?",
                    "orders_by_provider": "counts", "orders_outliers_total": "integer?", "aov_mean": "number?",
                    "aov_median": "number?"}),
    "narrative": (True, {"summary": "string", "details": "string"}),
    "data_availability": (False, {"products_rows": "integer", "orders_rows": "integer", "products_enriched": "boolean",
                                  "orders_enriched": "boolean"}),
    "integrity": (True, {"figure_count": "integer", "figure_ids": "strings"}),
}
OPTIONAL = {"integrity": {"expected_figures": "strings", "missing_figures": "strings"}}
FIGURE = {"name": "string", "path": "string", "sha256": "string", "size_bytes": "integer"}
DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def _is(kind: str, t: T.DataType) -> bool:
    return {
        "string": lambda: isinstance(t, T.StringType),
        "boolean": lambda: isinstance(t, T.BooleanType),
        "integer": lambda: isinstance(t, T.IntegralType),
        "number": lambda: isinstance(t, T.NumericType),
        "strings": lambda: isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType),
        "counts": lambda: isinstance(t, T.MapType) and isinstance(t.keyType, T.StringType) and isinstance(t.valueType, T.IntegralType),
    }[kind]()


def _fields(prefix: str, t: T.DataType, required: dict[str, str], optional: dict[str, str], open_: bool) -> list[str]:
    """What a struct type breaks by itself."""
    if not isinstance(t, T.StructType):
        return [f"type:{prefix}"]
    have = {f.name: f.dataType for f in t.fields}
    out = [f"missing:{prefix}.{k}" for k in required if k not in have]
    out += [f"extra:{prefix}.{k}" for k in have if not open_ and k not in required]
    return out + [f"type:{prefix}.{k}" for k, kind in (required | optional).items() if k in have and not _is(kind.rstrip("?"), have[k])]


def report_contract_violations(doc: DataFrame) -> DataFrame:
    """The whole report contract; (rule, violations). Required and extra keys
    and types follow from the schema at plan time, values from the row."""
    spark = doc.sparkSession
    types = {f.name: f.dataType for f in doc.schema.fields}
    broken = [f"missing:{k}" for k in CONTRACT_REQUIRED if k not in types]
    broken += [f"extra:{k}" for k in types if k not in ALLOWED_TOP_LEVEL]
    checks = {}

    def check(rule: str, path: str, bad) -> None:
        """``bad``: from a column to a condition; only where the field is there and of its type."""
        name = path.split(".")[0]
        if name in types and not any(b.split(":", 1)[1] in (name, path) for b in broken):
            checks[rule] = bad(F.col(path))

    for name, (open_, required) in SECTIONS.items():
        if name not in types:
            continue
        broken += _fields(name, types[name], required, OPTIONAL.get(name, {}), open_)
        for k, kind in required.items():
            if not kind.endswith("?"):
                check(f"null:{name}.{k}", f"{name}.{k}", lambda c: c.isNull())
    if "figures" in types:
        t = types["figures"]
        broken += _fields("figures", t.elementType, FIGURE, {"section": "string", "description": "string"}, True) if isinstance(t, T.ArrayType) else ["type:figures"]
        if not any(b.split(":", 1)[1].startswith("figures") for b in broken):
            some = lambda cond: lambda c: F.coalesce(F.exists(c, cond), F.lit(False))
            without = lambda k: lambda f: f[k].isNull()
            for k in FIGURE:
                check(f"null:figures.{k}", "figures", some(without(k)))
            check("figure_sha256_pattern", "figures", some(lambda f: ~f["sha256"].rlike("^[a-f0-9]{64}$")))
            check("figure_size_minimum", "figures", some(lambda f: f["size_bytes"] < 1))
    for k in ("schema_version", "generated_at_utc"):
        if k in types and not _is("string", types[k]):
            broken.append(f"type:{k}")
        check(f"null:{k}", k, lambda c: c.isNull())
    check("schema_version_semver", "schema_version", lambda c: ~c.rlike(r"^\d+\.\d+\.\d+$"))
    check("generated_at_date_time", "generated_at_utc", lambda c: ~c.rlike(DATE_TIME) | F.try_to_timestamp(c).isNull())
    check("dedup_key_mode_enum", "inputs.dedup_key_mode", lambda c: ~c.isin(*KEY_MODES))
    check("fake_mode_enum", "inputs.fake_mode", lambda c: ~c.isin(*FAKE_MODES))
    # only the fields that the checks look at are asked of the document
    wide = doc.agg(*[F.count(F.when(cond, True)).alias(f"r{i}") for i, cond in enumerate(checks.values())])
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations")) for i, rule in enumerate(checks)])
    counts = wide.select(F.explode(pairs).alias("x")).select("x.rule", "x.violations").where("violations > 0")
    if broken:
        counts = counts.unionByName(spark.createDataFrame([(b, 1) for b in broken], "rule string, violations bigint"))
    return counts
