"""Date-partitioned tables and incremental pulls."""

import datetime as dt
import os
import random

import pytest

from basketry.sources import dated as DD
from basketry.sources import tables as TB
from basketry.sources import watermark as WM
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = T.StructType().add("id", "string").add("at", "timestamp_ntz").add("price", "double").add("stamp", "timestamp_ntz")
T0 = dt.datetime(2024, 1, 30, 22)
day = lambda n, h=0: T0 + dt.timedelta(days=n, hours=h)


def files(path):
    return {os.path.join(b, f): os.stat(os.path.join(b, f)).st_mtime_ns for b, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def put(spark, path, rows, unit="day"):
    return DD.upsert(spark, path, spark.createDataFrame(rows, ROWS), ROWS, ["id"], "at", "stamp", unit)


def table(spark, path, *span):
    return sorted(((r.id, r["at"], r.price) for r in DD.read(spark, path, ROWS, *span).collect()), key=str)


def test_only_touched_dates_are_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    put(spark, path, [(str(i), day(i % 10), float(i), T0) for i in range(100)])
    before = files(path)
    assert put(spark, path, [("3", day(3), 99.0, day(1))]) == [day(3).date()]
    after = files(path)
    same = {f: t for f, t in before.items() if f"part_date={day(3).date()}" not in f}
    assert len(same) < len(before) and all(after.get(f) == t for f, t in same.items())
    assert ("3", day(3), 99.0) in table(spark, path) and len(table(spark, path)) == 100


def test_moved_rows_and_emptied_dates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    put(spark, path, [("1", day(0), 1.0, T0), ("2", day(1), 2.0, T0), ("3", None, 3.0, T0)])
    put(spark, path, [("1", day(1), 1.5, day(1)), ("3", day(5), 3.5, day(1))])
    assert table(spark, path) == [("1", day(1), 1.5), ("2", day(1), 2.0), ("3", day(5), 3.5)]
    assert not any(d.endswith((str(day(0).date()), "PARTITION__")) for d in os.listdir(path))
    assert put(spark, path, [("1", day(9), 0.0, T0)]) == []  # an older version
    put(spark, path, [("2", None, 2.5, day(2))])
    assert table(spark, path, day(0).date(), day(30).date()) == [("1", day(1), 1.5), ("3", day(5), 3.5)] and len(table(spark, path)) == 3


@pytest.mark.parametrize("unit", ["day", "month"])
def test_against_a_dict(spark, tmp_dir, unit):
    rng, path, want = random.Random(7), os.path.join(tmp_dir, "t"), {}
    for n in range(4):
        rows = [(str(i), rng.choice([None, day(rng.randrange(40))]), rng.random(), day(n, i % 3)) for i in rng.sample(range(60), 25)]
        put(spark, path, rows, unit)
        put(spark, path, rows, unit)  # again: the same table
        want.update({r[0]: r[:3] for r in rows})
        assert table(spark, path) == sorted(want.values(), key=str)


def test_pruning_and_split_writers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.lit(T0).alias("at"), F.lit(1.0).alias("price"), F.lit(T0).alias("stamp"))
    DD.write(rows.withColumn(DD.PART, DD.part_of(F.col("at"))).unionByName(
        rows.limit(5).withColumn(DD.PART, F.lit(dt.date(2020, 1, 1)))), path, ["id"], writers=6)
    names = files(path)
    assert sum(f"part_date={T0.date()}" in f for f in names) >= 5 and sum("2020-01-01" in f for f in names) <= 2
    one = DD.read(spark, path, ROWS, dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    scan = next(x for x in one._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(part_date" in scan and "(part_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert one.count() == 5


# --- incremental pulls

SCHEMA = T.StructType().add("provider", "string").add("resource", "string").add("id", "string").add("price", "double").add("raw_hash", "string").add("updated_at", "timestamp_ntz")
BY = ["provider", "resource"]


def pull(spark, root, rows, **k):
    df = spark.createDataFrame([(p, "orders", i, price, str(price), at) for p, i, price, at in rows], SCHEMA)
    return WM.pull(spark, df, root, "t", SCHEMA, f"{root}/marks", BY, "updated_at", ["provider", "id"], "2 days", **k)


def held(spark, root):
    return sorted((r.provider, r.id, r.price) for r in TB.read_table(spark, root, "t", SCHEMA, ["provider", "id"]).collect())


def latest(rows):
    best = {}
    for p, i, price, at in rows:
        if (p, i) not in best or best[p, i][0] < at:
            best[p, i] = (at, price)
    return sorted((p, i, price) for (p, i), (_, price) in best.items())


@pytest.mark.parametrize("seed", [0, 1])
def test_overlapping_landings_give_one_full_load(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), str(rng.randrange(15)), float(n), day(0) + dt.timedelta(minutes=n * 97 % 14000)) for n in range(150)]
    shown = []
    for cut in range(0, 12, 3):
        late = lambda r: hash((r[2], seed)) % 4 == 0 and r[3] > day(cut) - dt.timedelta(days=1)  # noqa: E731, B023
        shown = [r for r in rows if r[3] <= day(cut) and not late(r)]
        pull(spark, tmp_dir, shown)
    pull(spark, tmp_dir, rows)
    assert held(spark, tmp_dir) == latest(rows)
    assert pull(spark, tmp_dir, rows)["new"] == 0 and held(spark, tmp_dir) == latest(rows)


def test_each_provider_has_its_mark_and_reads_only_above_it(spark, tmp_dir):
    a, b = ("a", "1", 1.0, day(0)), ("b", "1", 1.0, day(10))
    assert pull(spark, tmp_dir, [a, b]) == {"read": 2, "new": 2, "updated": 0}
    got = pull(spark, tmp_dir, [a, b, ("a", "2", 2.0, day(3)), ("b", "2", 2.0, day(3)), ("b", "3", 3.0, day(9)), ("b", "1", 0.5, day(9))])
    # b's row of day 3 is below its mark less two days: it came too late; the older version of b's order 1 changes nothing
    assert got == {"read": 5, "new": 2, "updated": 0}
    assert held(spark, tmp_dir) == [("a", "1", 1.0), ("a", "2", 2.0), ("b", "1", 1.0), ("b", "3", 3.0)]


def test_failure_between_write_and_mark(spark, tmp_dir, monkeypatch):
    pull(spark, tmp_dir, [("a", "1", 1.0, day(0))])
    rows = [("a", "1", 2.0, day(5)), ("a", "2", 3.0, day(6))]
    with monkeypatch.context() as m:
        m.setattr(WM.FS, "append_json_lines", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pull(spark, tmp_dir, rows)
    assert [r.mark for r in WM.marks(spark, f"{tmp_dir}/marks", BY).collect()] == [day(0)]
    got = pull(spark, tmp_dir, rows)
    assert (got["new"], got["updated"]) == (0, 0) and held(spark, tmp_dir) == [("a", "1", 2.0), ("a", "2", 3.0)]
    assert [r.mark for r in WM.marks(spark, f"{tmp_dir}/marks", BY).collect()] == [day(6)]


def test_clock_ahead_of_time(spark, tmp_dir):
    pull(spark, tmp_dir, [("a", "1", 1.0, day(0)), ("a", "9", 1.0, day(4000))], until=F.lit(day(1)))
    assert held(spark, tmp_dir) == [("a", "1", 1.0)]
    pull(spark, tmp_dir, [("a", "2", 1.0, day(1))], until=F.lit(day(2)))
    assert [i for _, i, _ in held(spark, tmp_dir)] == ["1", "2"]
