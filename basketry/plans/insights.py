"""The analytics pass over the unified tables (product quality, daily
order metrics, run-log trends, enriched tables, feature validation, term
guard). Returns named DataFrames; ``export_dir`` writes the enriched tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..operators import kpis as K
from ..operators import quality as QA
from ..operators import runlog as RL
from ..sources import files as FS
from ..sources import snapshots as SS

# Fixed feature columns the validation step expects (Q3).
EXPECTED_PRODUCT_FEATURES = ["price_num", "source_freq"]
EXPECTED_ORDER_FEATURES = ["order_value_num"]


def run_insights(spark: SparkSession, products: DataFrame, orders: DataFrame, run_log: DataFrame | None = None,
                 text_root: str | None = None, export_dir: str | None = None, snapshot_root: str | None = None,
                 run_id: str | None = None, table_root: str | None = None) -> dict[str, DataFrame]:
    """``snapshot_root``: where the tables' schemas are kept; they are compared with the last successful run's, and replaced at the end.
    ``table_root``: the tables' files, fingerprinted."""
    out: dict[str, DataFrame] = {
        "product_quality": K.product_quality(products),
        "top_categories": K.top_values(products, "category", 10, null_label="<null>"),
        "top_sources": K.top_values(products, "source", 10),
        "daily_metrics": K.daily_metrics(orders),
        "daily_summary": K.daily_summary(orders),
        "daily_aov_hist": FE.histogram(K.daily_metrics(orders), "aov", 20),
        "price_hist": FE.histogram(products, K.resolve_column(products, K.PRICE_CANDIDATES), 20),
        "price_log_hist": FE.log10_histogram(products, K.resolve_column(products, K.PRICE_CANDIDATES), 20),
    }
    products_enriched = FE.enrich_products(products)
    orders_enriched = FE.enrich_orders(orders)
    out["products_enriched"] = products_enriched
    out["orders_enriched"] = orders_enriched
    out["feature_validation"] = QA.completeness(products_enriched, EXPECTED_PRODUCT_FEATURES).unionByName(
        QA.completeness(orders_enriched, EXPECTED_ORDER_FEATURES))
    out["freshness"] = K.availability({"products": products, "orders": orders})
    if run_log is not None:
        out["run_trend"] = RL.melt(run_log)
        out["run_cumulative"] = RL.cumulative(run_log)
        out["run_summary"] = K.describe(run_log, [m for m in RL.METRICS if m in run_log.columns])
    if text_root is not None:
        out["term_guard"] = QA.term_matches(FS.read_text_tree(spark, text_root), "text", "path")
    if export_dir is not None:
        FS.write_enriched(products_enriched, f"{export_dir.rstrip('/')}/products_enriched")
        FS.write_enriched(orders_enriched, f"{export_dir.rstrip('/')}/orders_enriched")
    if table_root is not None:
        out["table_fingerprints"] = QA.file_fingerprints(spark, table_root, "*.parquet")
    if snapshot_root is not None:
        now = {"products": QA.schema_snapshot(spark, products), "orders": QA.schema_snapshot(spark, orders)}
        out["schema_changes"] = SS.keep(spark, snapshot_root, run_id or uuid.uuid4().hex[:12], now)
    return out
