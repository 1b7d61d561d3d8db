"""Sources, sinks, the ETL run and the streaming merge."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from basketry import schemas as SC
from basketry.operators import merge as M
from basketry.operators import normalize as N
from basketry.plans import etl
from basketry.sources import files as FS
from basketry.sources import landing as L
from basketry.sources import tables as TB
from basketry.streaming import merge_stream as ST


def _json_df(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")


def test_landing_roundtrip_and_provider_pruning(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    L.write_raw(_json_df(spark, [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}]), root, "shopify", "products",
                "20240101", tag="Daily Run/EU")
    L.write_raw(_json_df(spark, [{"itemId": "e1"}]), root, "ebay", "items", "20240101")
    got = L.read_raw(spark, root, SC.RAW_SHOPIFY_PRODUCT, "products", ["shopify"])
    rows = got.collect()
    assert sorted(r["payload"]["id"] for r in rows) == ["1", "2"]
    assert {r["run_id"] for r in rows} == {"20240101_daily-run-eu"}
    assert len({r["raw_hash"] for r in rows}) == 1  # batch-scope hash (one landed batch)
    per_record = L.read_raw(spark, root, SC.RAW_SHOPIFY_PRODUCT, "products", ["shopify"], hash_scope="record")
    assert len({r["raw_hash"] for r in per_record.collect()}) == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "provider" in plan
    limited = L.read_raw(spark, root, SC.RAW_SHOPIFY_PRODUCT, "products", ["shopify"], limit_per_provider=1)
    assert limited.count() == 1


def test_versioned_tables_csv_fallback_and_jsonl(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    empty = FS.load_table(spark, root, "products", SC.PRODUCTS)
    assert empty.count() == 0 and empty.schema == SC.PRODUCTS
    os.makedirs(root)
    with open(os.path.join(root, "products.csv"), "w") as f:
        f.write("source,source_id,price_amount\nshopify,1,2.5\nshopify,2,oops\n")
    csv = FS.load_table(spark, root, "products", SC.PRODUCTS).collect()
    assert [r["price_amount"] for r in csv] == [2.5, None]
    v1 = FS.write_version(spark.createDataFrame(csv, SC.PRODUCTS), root, "products")
    v2 = FS.write_version(spark.createDataFrame(csv[:1], SC.PRODUCTS), root, "products")
    assert (v1, v2) == (1, 2) and FS.committed_versions(spark, root, "products") == [1, 2]
    assert FS.load_table(spark, root, "products", SC.PRODUCTS).count() == 1
    log = os.path.join(tmp_dir, "runs.jsonl")
    with open(log, "w") as f:
        f.write('{"run_id": "a", "new_products": 3}\n\nnot json\n{"run_id": "b", "new_orders": 1}\n')
    runs = FS.read_json_lines(spark, log, SC.RUN_LOG).collect()
    assert sorted(r["run_id"] for r in runs) == ["a", "b"]


def test_text_tree_skips_dot_paths(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tree")
    for rel in ["a.py", "sub/b.md", ".git/c.py", "sub/.cache/d.md", "e.txt"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("produto\n" + rel)
    got = sorted(r["path"].split("/tree/", 1)[1] for r in FS.read_text_tree(spark, root).collect())
    assert got == ["a.py", "sub/b.md"]


def _orders_docs(version):
    return [{"id": i, "order_number": 1000 + i, "total_price": str(10 * i + version),
             "line_items": [{"sku": f"s{i}"}]} for i in (1, 2)] + ([{"id": 3, "total_price": "5"}] if version == 2 else [])


def test_run_pipeline_twice(spark, tmp_dir):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    L.write_raw(_json_df(spark, _orders_docs(1)), landing, "shopify", "orders", "r1")
    L.write_raw(_json_df(spark, [{"id": 1, "title": "p", "variants": [{"price": "1"}]}]), landing, "shopify",
                "products", "r1")
    first = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair", batch_ts="2024-01-01 00:00:00")
    assert (first["new_orders"], first["updated_orders"], first["new_products"]) == (2, 0, 1)
    L.write_raw(_json_df(spark, _orders_docs(2)), landing, "shopify", "orders", "r2")
    second = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair", batch_ts="2024-01-02 00:00:00")
    assert (second["new_orders"], second["updated_orders"]) == (1, 2)
    orders = TB.read_table(spark, tables, "orders", SC.ORDERS)
    assert orders.count() == 3
    by_run = {}
    for r in orders.collect():
        by_run.setdefault(r["raw_file"].split("run_id=")[1].split("/")[0], set()).add(r["raw_hash"])
    assert all(len(h) == 1 for h in by_run.values())      # one digest per landed run (K8)
    assert {r["order_id"]: r["total_price"] for r in orders.collect()} == {"1": 12.0, "2": 22.0, "3": 5.0}
    log = FS.read_json_lines(spark, runs, SC.RUN_LOG).collect()
    assert len(log) == 2 and {r["status"] for r in log} == {"success"}
    L.write_raw(_json_df(spark, _orders_docs(3)), landing, "shopify", "orders", "r3")
    dry = etl.run_pipeline(spark, landing, tables, runs, key_mode="triple", dry_run=True)
    assert dry["new_orders"] == 2 and len(FS.read_json_lines(spark, runs, SC.RUN_LOG).collect()) == 2
    assert TB.read_table(spark, tables, "orders", SC.ORDERS).count() == 3


def _land(spark, landing, run, versions):
    """One run with a record of order 7 for each version, in this order, in one file."""
    docs = [{"id": 7, "total_price": str(v), "gateway": f"g{v}"} for v in versions]
    L.write_raw(_json_df(spark, docs).coalesce(1), landing, "shopify", "orders", run)


def _price(spark, tables):
    return [r["total_price"] for r in TB.read_table(spark, tables, "orders", SC.ORDERS).collect()]


def test_the_last_version_wins_whatever_its_contents(spark, tmp_dir):
    for i, (old, new) in enumerate([(10, 20), (20, 10), (1, 2), (7, 3), (99, 98)]):
        landing, tables, runs = (os.path.join(tmp_dir, f"{x}{i}") for x in ("raw", "tables", "runs"))
        _land(spark, landing, "b" if i % 2 else "a", [old])
        etl.run_pipeline(spark, landing, tables, runs, key_mode="pair", batch_ts="2024-01-02 00:00:00")
        time.sleep(0.01)
        _land(spark, landing, "a" if i % 2 else "b", [new])
        got = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair", batch_ts="2024-01-02 00:00:00")
        assert (got["new_orders"], got["updated_orders"]) == (0, 1)
        assert _price(spark, tables) == [float(new)]


def test_several_runs_in_one_pass_and_several_versions_in_one_run(spark, tmp_dir):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    for i, run in enumerate(("z", "m", "a")):
        _land(spark, landing, run, [50 - i, 60 + i, 40 + i])
        time.sleep(0.01)
    first = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    assert (first["new_orders"], first["updated_orders"], first["raw_files"]) == (1, 0, 3)
    assert _price(spark, tables) == [42.0]
    triple = os.path.join(tmp_dir, "triple")
    etl.run_pipeline(spark, landing, triple, runs, key_mode="triple")
    rows = TB.read_table(spark, triple, "orders", SC.ORDERS).collect()
    assert len(rows) == 9 and len({r["ingested_at"] for r in rows}) == 3    # each run has its own stamp


def test_nothing_new_writes_nothing(spark, tmp_dir):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    _land(spark, landing, "r1", [5])
    etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    before = sorted(os.walk(tables))
    again = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    assert (again["raw_files"], again["new_orders"], again["updated_orders"]) == (0, 0, 0)
    assert sorted(os.walk(tables)) == before


def test_a_limited_pass_takes_nothing_from_the_next_one(spark, tmp_dir):
    for mode in ("pair", "triple"):
        landing, tables, runs = (os.path.join(tmp_dir, f"{x}_{mode}") for x in ("raw", "tables", "runs"))
        lines = [*(json.dumps({"id": i, "total_price": str(i)}) for i in range(6)), "{broken"]
        L.write_raw(spark.createDataFrame([(x,) for x in lines], "json string"), landing, "shopify", "orders", "r1")
        part = etl.run_pipeline(spark, landing, tables, runs, key_mode=mode, limit=2)
        assert (part["new_orders"], part["rejected_records"]) == (2, 0)
        whole = etl.run_pipeline(spark, landing, tables, runs, key_mode=mode)
        assert (whole["new_orders"], whole["rejected_records"]) == (4, 1)
        assert sorted(r["order_id"] for r in TB.read_table(spark, tables, "orders", SC.ORDERS).collect()) == list("012345")
        assert etl.run_pipeline(spark, landing, tables, runs, key_mode=mode)["raw_files"] == 0


def test_files_that_reach_a_merged_run_later_are_taken(spark, tmp_dir, monkeypatch):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    order = lambda i: _json_df(spark, [{"id": i, "total_price": str(i)}])
    passes = lambda: etl.run_pipeline(spark, landing, tables, runs, key_mode="triple")
    L.write_raw(order(1), landing, "shopify", "orders", "0017")
    assert passes()["new_orders"] == 1
    L.write_raw(order(2), landing, "shopify", "orders", "0017")
    merge = etl.T.merge_into

    def late(*args, **kwargs):                                  # one more file while the pass is at work
        L.write_raw(order(3), landing, "shopify", "orders", "0017")
        return merge(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(etl.T, "merge_into", late)
        assert passes()["new_orders"] == 1
    assert passes()["new_orders"] == 1 and passes()["raw_files"] == 0
    rows = TB.read_table(spark, tables, "orders", SC.ORDERS).collect()
    assert sorted(r["order_id"] for r in rows) == ["1", "2", "3"] and all(r["ingested_at"] for r in rows)


def test_broken_lines_are_set_aside(spark, tmp_dir):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    lines = ['{"id": 1, "total_price": "3"}', "{broken", "", "[1, 2]", "17", '{"id": 2}']
    L.write_raw(spark.createDataFrame([(x,) for x in lines], "json string"), landing, "shopify", "orders", "r1")
    got = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    assert (got["status"], got["new_orders"], got["rejected_records"]) == ("success", 2, 3)
    aside = spark.read.option("recursiveFileLookup", True).json(os.path.join(tables, "_rejected", "orders")).collect()
    assert sorted(r["json"] for r in aside) == ["17", "[1, 2]", "{broken"]
    assert FS.read_json_lines(spark, runs, SC.RUN_LOG).collect()[0]["rejected_records"] == 3
    stream_in = os.path.join(tmp_dir, "stream_in")
    os.makedirs(stream_in)
    with open(os.path.join(stream_in, "a.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    streamed = os.path.join(tmp_dir, "streamed")
    ST.start_merge_stream(spark, stream_in, SC.RAW_SHOPIFY_ORDER, streamed, "orders", SC.ORDERS, N.normalize_shopify_orders,
                          os.path.join(tmp_dir, "ckpt")).awaitTermination(120)
    assert TB.read_table(spark, streamed, "orders", SC.ORDERS).count() == 2
    assert spark.read.option("recursiveFileLookup", True).json(os.path.join(streamed, "_rejected", "orders")).count() == 3


def test_stream_merge_equals_batch_merge(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "stream_in")
    os.makedirs(landing)
    for v in (1, 2):
        with open(os.path.join(landing, f"orders_{v}.json"), "w") as f:
            f.write("\n".join(json.dumps(d) for d in _orders_docs(v)) + "\n")
    tables = os.path.join(tmp_dir, "stream_tables")
    stamp = N.batch_stamp("2024-01-01 00:00:00")
    q = ST.start_merge_stream(spark, landing, SC.RAW_SHOPIFY_ORDER, tables, "orders", SC.ORDERS,
                              N.normalize_shopify_orders, os.path.join(tmp_dir, "ckpt"), key_mode="triple",
                              stamp=stamp, max_files_per_trigger=1)
    q.awaitTermination(120)
    assert TB.batches(spark, tables, "orders") == {1: "triple", 2: "triple"}
    streamed = TB.read_table(spark, tables, "orders", SC.ORDERS)
    raw = spark.read.text(landing).select(F.from_json("value", SC.RAW_SHOPIFY_ORDER).alias("payload"),
                                          F.col("_metadata.file_path").alias("raw_file"),
                                          F.sha2(F.to_json(F.parse_json("value")), 256).alias("raw_hash"))
    batch = M.merge_orders(spark.createDataFrame([], SC.ORDERS), N.normalize_shopify_orders(raw, stamp), "triple").table
    key = lambda df: sorted((r["order_id"], r["total_price"]) for r in df.collect())
    assert key(streamed) == key(batch)


def _order_rows(spark, ids, version, hour):
    rows = [("shopify", str(i), None, None, None, "USD", float(10 * i + version), None, None, None, None, "paid",
             None, 1, None, None, None, None, f"h{i}_{version}", dt.datetime(2024, 1, 1, hour), None) for i in ids]
    return spark.createDataFrame(rows, SC.ORDERS)


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_pair_merge_writes_what_the_batch_holds(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    keys, order = list(M.ORDER_KEYS), M.ORDER_ORDER
    first = TB.merge_into(spark, root, "orders", SC.ORDERS, _order_rows(spark, range(4000), 1, 1), "pair", keys, order)
    assert first == {"new": 4000, "updated": 0, "batch": 1}
    size = _bytes(root)
    second = TB.merge_into(spark, root, "orders", SC.ORDERS, _order_rows(spark, [3], 2, 2), "pair", keys, order)
    assert second == {"new": 0, "updated": 1, "batch": 2}
    assert _bytes(root) - size < size / 3                                  # the table's files stay as they are
    table = {r["order_id"]: r["total_price"] for r in TB.read_table(spark, root, "orders", SC.ORDERS).collect()}
    assert len(table) == 4000 and table["3"] == 32.0 and table["4"] == 41.0
    again = TB.merge_into(spark, root, "orders", SC.ORDERS, _order_rows(spark, [3], 2, 2), "pair", keys, order)
    assert again["updated"] == 1 and TB.read_table(spark, root, "orders", SC.ORDERS).count() == 4000
    assert TB.compact(spark, root, "orders", SC.ORDERS) == 4 and TB.batches(spark, root, "orders") == {4: "pair"}
    assert {r["order_id"]: r["total_price"] for r in TB.read_table(spark, root, "orders", SC.ORDERS).collect()} == table


def test_triple_appends_the_delta_and_modes_mix(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    keys, order = list(M.ORDER_KEYS), M.ORDER_ORDER
    into = lambda ids, v, mode: TB.merge_into(spark, root, "orders", SC.ORDERS, _order_rows(spark, ids, v, v), mode, keys, order)
    into(range(10), 1, "triple")
    assert into(range(10), 1, "triple") == {"new": 0, "updated": 0, "batch": None}   # nothing new: no batch (M7)
    assert into(range(5), 2, "triple")["new"] == 5
    assert TB.read_table(spark, root, "orders", SC.ORDERS).count() == 15
    assert into([3, 50], 3, "pair") == {"new": 1, "updated": 1, "batch": 3}          # hides both versions of order 3
    rows = TB.read_table(spark, root, "orders", SC.ORDERS).collect()
    assert sorted((r["order_id"], r["total_price"]) for r in rows if r["order_id"] in ("3", "50")) == [("3", 33.0), ("50", 503.0)]
    assert len(rows) == 15 - 2 + 2
    assert into([3], 4, "triple")["new"] == 1 and TB.read_table(spark, root, "orders", SC.ORDERS).count() == 16


def test_read_landed_documents_reference_layout(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data_raw")
    os.makedirs(os.path.join(root, "shopify", "products"))
    os.makedirs(os.path.join(root, "amazon", "items"))
    with open(os.path.join(root, "shopify", "products", "20240101T000000Z_ab12_daily-eu.json"), "w") as f:
        json.dump([{"id": 1, "title": "a", "variants": [{"price": "2.5"}]}, {"title": "b", "id": 2}], f, indent=2)
    with open(os.path.join(root, "amazon", "items", "20240101T000000Z_cd34.json"), "w") as f:
        json.dump({"ItemsResult": {"Items": [{"ASIN": "X1"}, {"ASIN": "X2"}]}}, f, indent=2)
    shop = L.read_landed_documents(spark, root, SC.RAW_SHOPIFY_PRODUCT, "products").collect()
    assert sorted(r["payload"]["id"] for r in shop) == ["1", "2"]
    assert {(r["provider"], r["run_id"], r["tag"]) for r in shop} == {("shopify", "ab12", "daily-eu")}
    assert len({r["raw_hash"] for r in shop}) == 1
    amz = L.read_landed_documents(spark, root, SC.RAW_AMAZON_RESPONSE, "items", ["amazon"])
    got = N.normalize_amazon_items(amz, N.batch_stamp("2024-01-01 00:00:00")).collect()
    assert sorted(r["source_id"] for r in got) == ["X1", "X2"]


def test_csv_roundtrip_and_json_documents(spark, tmp_dir):
    df = spark.createDataFrame([("a", "1,5", 'say "hi"'), ("b", None, "multi\nline")], "k string, v string, t string")
    out = os.path.join(tmp_dir, "csv")
    FS.write_csv(df, out)
    back = sorted(FS.read_csv_text(spark, out, multiline=True).collect(), key=lambda r: r["k"])
    assert [(r["k"], r["v"], r["t"]) for r in back] == [("a", "1,5", 'say "hi"'), ("b", None, "multi\nline")]
    docs = os.path.join(tmp_dir, "docs")
    os.makedirs(docs)
    with open(os.path.join(docs, "a.json"), "w") as f:
        json.dump([{"itemId": "1"}, {"itemId": "2"}], f, indent=2)
    with open(os.path.join(docs, "b.json"), "w") as f:
        json.dump({"itemId": "3"}, f, indent=2)
    got = L.read_json_documents(spark, docs, SC.RAW_EBAY_ITEM).collect()
    assert sorted(r["itemId"] for r in got) == ["1", "2", "3"] and got[0]["raw_file"].endswith(".json")


def _touch(landing, run, seconds):
    for base, _, names in os.walk(os.path.join(landing, "provider=shopify", "resource=orders", f"run_id={run}")):
        for n in names:
            os.utime(os.path.join(base, n), (seconds, seconds))
        os.utime(base, (0, 0))  # folder times say nothing


def test_runs_taken_together_keep_the_order_of_their_files(spark, tmp_dir):
    times = ({"a": 300, "b": 100, "c": 200}, {"a": 100, "b": 100, "c": 100}, {"a": 0, "b": 0, "c": 0}, {"a": 200, "b": 300, "c": 0})
    for i, when in enumerate(times):
        landing, tables, runs = (os.path.join(tmp_dir, f"{x}{i}") for x in ("raw", "tables", "runs"))
        for n, run in enumerate("bca"):
            _land(spark, landing, run, [n])
        for run, t in when.items():
            _touch(landing, run, t)
        etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
        last = max(when, key=lambda r: (when[r], r))  # equal times: by run id
        assert _price(spark, tables) == [float("bca".index(last))]


def test_many_files_go_through_in_groups(spark, tmp_dir, monkeypatch):
    landing, tables, runs = (os.path.join(tmp_dir, x) for x in ("raw", "tables", "runs"))
    folder = os.path.join(landing, "provider=shopify", "resource=orders", "run_id=0007")
    os.makedirs(folder)
    for i in range(2500):
        with open(os.path.join(folder, f"part-{i:05}.txt"), "w") as f:
            f.write(json.dumps({"id": i, "total_price": "1"}) + "\n" if i % 5 == 0 else "\n")
    plain, groups = L.claimed_lines, []

    def small(spark, root, taken):
        lines = plain(spark, root, taken, group=1000)
        groups.append(len(lines._jdf.queryExecution().optimizedPlan().toString()))
        return lines

    with monkeypatch.context() as m:
        m.setattr(L, "claimed_lines", small)
        got = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    assert (got["raw_files"], got["new_orders"]) == (2500, 500) and groups[0] < 2000
    again = etl.run_pipeline(spark, landing, tables, runs, key_mode="pair")
    assert (again["raw_files"], again["new_orders"]) == (0, 0)
