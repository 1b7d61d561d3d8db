"""The ETL run - newly landed runs -> normalized batch -> merge -> appended table batch -> run log.

A pipeline run takes the landed files that no earlier pipeline run has merged,
run by run in the order in which they landed; files that reach a merged run later
are taken by the next pass. With nothing new it reads and writes no data. Lines that are no JSON object do not end the run: they are set aside
with their text (``<table_root>/_rejected/<entity>``) and counted. With ``rules`` records are checked before they are merged: those that break a
rule go to quarantine, and a run with too many of them ends before any of it is visible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as SC
from ..operators import merge as M
from ..operators import normalize as N
from ..operators.quality import Rule
from ..sources import files as FS
from ..sources import landing as L
from ..sources import quarantine as QT
from ..sources import tables as T

# Fixed provider -> (resource, raw schema, normalizer) wiring.
PRODUCT_SOURCES = {
    "shopify": ("products", SC.RAW_SHOPIFY_PRODUCT, N.normalize_shopify_products),
    "amazon": ("items", SC.RAW_AMAZON_RESPONSE, N.normalize_amazon_items),
    "ebay": ("items", SC.RAW_EBAY_ITEM, N.normalize_ebay_search),
}
ORDER_SOURCES = {
    "shopify": ("orders", SC.RAW_SHOPIFY_ORDER, N.normalize_shopify_orders),
}


def normalized_batch(lines: DataFrame, taken: L.Claim, runs: DataFrame, sources: dict, stamp: Column, hash_scope: str, limit: int | None) -> DataFrame:
    frames = []
    for provider in taken.providers:
        _, schema, fn = sources[provider]
        raw = L.typed_records(lines.where(F.col("provider") == provider), runs, schema, stamp, hash_scope, limit)
        frames.append(fn(raw, F.col("_stamp")))
    return N.union_batches(frames)


def run_pipeline(spark: SparkSession, landing_root: str, table_root: str, runlog_path: str,
                 key_mode: str = "triple", providers: Sequence[str] | None = None, dry_run: bool = False,
                 batch_ts: str | None = None, hash_scope: str = "batch", limit: int | None = None,
                 rules: Mapping[str, Sequence[Rule]] | None = None, max_violation_share: float | None = None) -> dict:
    """Run one ETL pass; returns the run-log record (also appended as JSON line).

    ``rules``: entity (products, orders) -> rules its records must keep. All entities are staged and checked first; if more than
    ``max_violation_share`` of one's records break a rule the run raises, and tables, quarantine and the marks of merged files stay as they were.

    A pass with ``limit`` merges the first n records of each provider and leaves the runs, with their broken lines, to the
    next pass without one.
    """
    M.check_mode(key_mode)
    run_id = uuid.uuid4().hex[:12]
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = N.batch_stamp(batch_ts or started.strftime("%Y-%m-%d %H:%M:%S.%f"))
    record = {"run_id": run_id, "started_at": started, "status": "success", "raw_files": 0,
              "new_products": 0, "new_orders": 0, "updated_products": 0, "updated_orders": 0, "rejected_records": 0, "quarantined_records": 0,
              "providers": sorted(providers) if providers else sorted(set(PRODUCT_SOURCES) | set(ORDER_SOURCES))}
    staged: list[tuple] = []
    try:
        for entity, sources, schema, keys, order_col in (
                ("products", PRODUCT_SOURCES, SC.PRODUCTS, M.PRODUCT_KEYS, M.PRODUCT_ORDER),
                ("orders", ORDER_SOURCES, SC.ORDERS, M.ORDER_KEYS, M.ORDER_ORDER)):
            wanted = {p: resource for p, (resource, _, _) in sources.items() if not providers or p in providers}
            taken = L.claim(spark, landing_root, wanted, L.merged_files(spark, table_root, entity))
            if taken is None:
                continue
            record["raw_files"] += taken.n
            lines = L.claimed_lines(spark, landing_root, taken)
            runs = L.survey(taken, lines)
            bad = 0 if limit else runs.agg(F.coalesce(F.sum("rejected"), F.lit(0))).first()[0]
            record["rejected_records"] += bad
            if bad and not dry_run:
                L.rejected(lines).write.json(f"{table_root.rstrip('/')}/_rejected/{entity}/run={run_id}")
            batch = normalized_batch(lines, taken, runs, sources, stamp, hash_scope, limit)
            if rules is not None:  # an entity without rules waits for the check of the others too
                staged.append((QT.stage(batch, table_root, entity, schema, rules.get(entity, ()), run_id), entity, schema, keys, order_col, taken))
                continue
            res = T.merge_into(spark, table_root, entity, schema, batch, key_mode, keys, order_col, dry_run=dry_run)
            record[f"new_{entity}"] = res["new"]
            record[f"updated_{entity}"] = res["updated"]
            if not dry_run and not limit:
                L.mark_merged(spark, table_root, entity, taken)
        record["quarantined_records"] = sum(s[0].bad for s in staged)
        QT.check_share([s[0] for s in staged], max_violation_share)
        for made, entity, schema, keys, order_col, taken in staged:
            res = QT.publish(spark, made, table_root, schema, key_mode, keys, order_col, dry_run)
            record[f"new_{entity}"] = res["new"]
            record[f"updated_{entity}"] = res["updated"]
            if not dry_run and not limit:
                L.mark_merged(spark, table_root, entity, taken)
    except Exception:
        record["status"] = "error"
        raise
    finally:
        QT.discard(spark, [s[0] for s in staged])
        record["finished_at"] = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if not dry_run:
            FS.append_json_lines(spark.createDataFrame([record], SC.RUN_LOG), runlog_path)
    return record

