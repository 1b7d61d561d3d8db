"""Daily states against a full recomputation, after every batch and after failures."""

import datetime as dt
import os
import random

import pytest

from basketry.operators import merge as M
from basketry.sources import daily as DT
from basketry.sources import tables as TB
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = T.StructType().add("source", "string").add("order_id", "string").add("created_at", "timestamp_ntz").add("total_price", "double").add(
    "raw_hash", "string").add("ingested_at", "timestamp_ntz")
KEYS, T0 = M.ORDER_KEYS, dt.datetime(2024, 3, 1, 23)


def merge(spark, root, rows, hour):
    df = spark.createDataFrame([(s, i, at, p, f"{p}", T0 + dt.timedelta(hours=hour)) for s, i, at, p in rows], FIELDS)
    TB.merge_into(spark, root, "orders", FIELDS, df, "pair", KEYS, "ingested_at")


def update(spark, root):
    return DT.update(spark, root, "orders", "daily", FIELDS, KEYS, "created_at", "total_price")


def states(df):
    return sorted(((r.day, r.source, r.n_orders, r.n_values, float(r.total), sorted(r.bins.items())) for r in df.collect() if r.n_orders), key=str)


def recomputed(spark, root):
    return states(DT.states(TB.read_table(spark, root, "orders", FIELDS), "created_at", "total_price", ["source"]))


def kept(spark, root):
    return states(DT.read_states(spark, root, "daily", ["source"], FIELDS))


def some(rng, n):
    return [(rng.choice(["a", "b", None]), str(rng.randrange(60)), rng.choice([None, *(T0 + dt.timedelta(days=rng.randrange(6), minutes=rng.randrange(120)),) * 9]),
             rng.choice([None, 0.0, -12.345, round(rng.lognormvariate(4, 3), 2), 1e15])) for _ in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_recomputation(spark, tmp_dir, seed):
    rng = random.Random(seed)
    for hour in range(4):
        merge(spark, tmp_dir, some(rng, 80), hour)
        if hour != 1:  # two batches at once
            update(spark, tmp_dir)
            assert kept(spark, tmp_dir) == recomputed(spark, tmp_dir)
    assert update(spark, tmp_dir) == []
    TB.compact(spark, tmp_dir, "orders", FIELDS)
    update(spark, tmp_dir)
    assert kept(spark, tmp_dir) == recomputed(spark, tmp_dir)
    merge(spark, tmp_dir, some(rng, 30), 9)
    update(spark, tmp_dir)
    assert kept(spark, tmp_dir) == recomputed(spark, tmp_dir)


def test_changed_day_and_source_are_taken_away(spark, tmp_dir):
    merge(spark, tmp_dir, [("a", "1", T0, 10.0), ("a", "2", T0, 30.0)], 0)
    update(spark, tmp_dir)
    merge(spark, tmp_dir, [("a", "1", T0 + dt.timedelta(days=2), 11.0), ("a", "2", None, 30.0)], 1)
    update(spark, tmp_dir)
    got = [(r.day.day, r.n_orders, r.gmv, r.p50) for r in DT.read(spark, tmp_dir, "daily", FIELDS).collect()]
    assert got == [(3, 1, 11.0, pytest.approx(11.0, rel=0.005))]  # the middle of the bin from 11.00 to 11.10


def test_only_touched_days_are_written(spark, tmp_dir):
    merge(spark, tmp_dir, [("a", str(i), T0 + dt.timedelta(days=i % 300), float(i)) for i in range(3000)], 0)
    update(spark, tmp_dir)
    merge(spark, tmp_dir, [("a", "7", T0 + dt.timedelta(days=7), 1.5)], 1)
    assert update(spark, tmp_dir) == [2]
    base = os.path.join(tmp_dir, "daily", "mode=pair")
    rows = [spark.read.parquet(f"{base}/batch={n}").count() for n in (1, 2)]
    size = [sum(os.path.getsize(os.path.join(base, f"batch={n}", f)) for f in os.listdir(os.path.join(base, f"batch={n}"))) for n in (1, 2)]
    assert rows == [300, 1] and size[1] < size[0] / 5
    # the same versions again: no state changes
    merge(spark, tmp_dir, [("a", "7", T0 + dt.timedelta(days=7), 1.5)], 2)
    update(spark, tmp_dir)
    assert spark.read.parquet(f"{base}/batch=3").count() == 0 and kept(spark, tmp_dir) == recomputed(spark, tmp_dir)


def test_failed_update_is_made_up_for(spark, tmp_dir, monkeypatch):
    merge(spark, tmp_dir, [("a", "1", T0, 10.0)], 0)
    update(spark, tmp_dir)
    merge(spark, tmp_dir, [("a", "1", T0, 12.0)], 1)

    def lost(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DT, "combined", lost)
        with pytest.raises(RuntimeError):
            update(spark, tmp_dir)
    assert update(spark, tmp_dir) == [2] and update(spark, tmp_dir) == []
    assert kept(spark, tmp_dir) == recomputed(spark, tmp_dir)


def test_quantile_error(spark):
    rng = random.Random(3)
    values = sorted(round(rng.lognormvariate(5, 2.5), 2) for _ in range(5000))
    df = spark.createDataFrame([(T0, v) for v in values], "at timestamp_ntz, v double")
    s = DT.states(df, "at", "v", [])
    shares = {f"q{k}": k / 100 for k in (1, 10, 50, 90, 99, 100)}
    r = s.select(*(DT.quantile(F.col("bins"), F.col("n_values"), p).alias(k) for k, p in shares.items())).first()
    for k, p in shares.items():
        true = values[max(1, -(-int(p * 100) * 5000 // 100)) - 1]
        assert abs(r[k] - true) <= 0.005 * true + 1e-9


def test_empty(spark, tmp_dir):
    assert update(spark, tmp_dir) == [] and DT.read(spark, tmp_dir, "daily", FIELDS).count() == 0
