"""Validity intervals against a plain loop, in one go and batch by batch."""

import datetime as dt
import random

import pytest

from basketry.operators import history as H
from basketry.sources import history as HT
from pyspark.sql import functions as F

SCHEMA = "source string, id string, at timestamp_ntz, price double, status string, mark int"
KEYS, STATE = ["source", "id"], ["price", "status"]
T0 = dt.datetime(2024, 1, 1)


def slow(rows):
    by = {}
    for s, i, at, price, status, mark in rows:
        if at is not None:
            by.setdefault((s, i), {}).setdefault(at, []).append((mark, price, status))
    out = []
    for key, times in by.items():
        mine = []
        for at in sorted(times):
            _, price, status = max(times[at], key=lambda v: tuple((x is not None, x) for x in v))
            if not mine or mine[-1][1] != (price, status):
                mine.append((at, (price, status)))
        ends = [at for at, _ in mine[1:]] + [None]
        out += [(*key, *state, at, to) for (at, state), to in zip(mine, ends)]
    return sorted(out, key=str)


def some(rng, n, ids=6, times=12):
    return [(rng.choice(["a", "b", None]), str(rng.randrange(ids)) if rng.random() > .1 else None, T0 + dt.timedelta(hours=rng.randrange(times)),
             rng.choice([1.0, 2.0, None]), rng.choice(["F", "O", None]), rng.randrange(5)) for _ in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*KEYS, *STATE, "valid_from", "valid_to").collect()), key=str)


@pytest.mark.parametrize("seed, most, ranges", [(0, 100_000, 1024), (1, 3, 4), (2, 1, 64), (3, 5, 2)])
def test_against_loop(spark, seed, most, ranges):
    rng = random.Random(seed)
    rows = some(rng, 400)
    rows += [("hot", "1", T0 + dt.timedelta(minutes=i), float(rng.randrange(2)), "F", 0) for i in range(300)]
    rows += [("hot", "1", None, 1.0, "F", 0)] + rows[:20]
    got = H.intervals(spark.createDataFrame(rows, SCHEMA).repartition(6), KEYS, "at", STATE, ["mark"], most=most, ranges=ranges)
    assert rows_of(got) == slow(rows)


@pytest.mark.parametrize("dealt", [False, True])
def test_unsplit_against_loop_with_one_shuffle(spark, dealt):
    rng = random.Random(11)
    rows = some(rng, 400) + [("a", "1", None, 1.0, "F", 0)]
    df = spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(6)
    if dealt:
        df = df.withColumn(H.KEY, F.struct(*KEYS)).repartition(H.KEY)
    got = H.intervals(df, KEYS, "at", STATE, ["mark"], frequent=False)
    assert rows_of(got) == slow(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_any_frequent(spark):
    df = spark.createDataFrame([("hot", None, T0, 1.0, "F", i) for i in range(30)] + [("a", str(i), T0, 1.0, "F", 0) for i in range(200)], SCHEMA)
    assert H.any_frequent(df, KEYS, most=29) and H.any_frequent(df, KEYS, most=29, buckets=2)
    assert not H.any_frequent(df, KEYS, most=30) and not H.any_frequent(df, KEYS, most=30, buckets=2)


def test_frequent_key_is_split(spark):
    rows = [("hot", "1", T0 + dt.timedelta(minutes=i), float(i % 3), "F", 0) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("at", "valid_from").checkpoint()
    ranged = H.in_ranges(df, KEYS, "valid_from", most=500, ranges=16)
    sizes = [r["count"] for r in ranged.rows.groupBy(H.RANGE).count().collect()]
    assert ranged.split and len(sizes) == 16 and max(sizes) < 200


def test_empty(spark):
    assert H.intervals(spark.createDataFrame([], SCHEMA), KEYS, "at", STATE).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_batches_in_any_order(spark, tmp_dir, seed):
    rng = random.Random(seed)
    parts = [some(rng, 60, ids=8) for _ in range(4)]
    rng.shuffle(parts)
    done = []
    for part in [*parts, parts[0], []]:
        HT.append(spark, tmp_dir, "t", spark.createDataFrame(part, SCHEMA), KEYS, "at", STATE, ["mark"])
        done += part
        assert rows_of(HT.read(spark, tmp_dir, "t", KEYS)) == slow(done)
    HT.compact(spark, tmp_dir, "t", KEYS)
    assert len(HT.batches(spark, tmp_dir, "t")) == 1 and rows_of(HT.read(spark, tmp_dir, "t", KEYS)) == slow(done)
    late = [("a", "1", T0 - dt.timedelta(days=1), 9.0, "X", 0)]
    HT.append(spark, tmp_dir, "t", spark.createDataFrame(late, SCHEMA), KEYS, "at", STATE, ["mark"])
    assert rows_of(HT.read(spark, tmp_dir, "t", KEYS)) == slow(done + late)


def test_late_version_cuts_and_return_to_a_state(spark, tmp_dir):
    def put(*rows):
        return HT.append(spark, tmp_dir, "t", spark.createDataFrame([("a", "1", T0 + dt.timedelta(days=d), p, "F", 0) for d, p in rows], SCHEMA),
                         KEYS, "at", STATE)

    def spans():
        return sorted(((r.valid_from - T0).days, r.valid_to and (r.valid_to - T0).days, r.price) for r in HT.read(spark, tmp_dir, "t", KEYS).collect())

    assert put((0, 1.0), (5, 1.0), (9, 1.0)) == {"versions": 3, "keys": 1, "batch": 1}
    assert spans() == [(0, None, 1.0)]
    put((3, 2.0))  # late: the confirmation on day 5 brings the old state back
    assert spans() == [(0, 3, 1.0), (3, 5, 2.0), (5, None, 1.0)]
    assert put((3, 2.0), (0, 1.0)) == {"versions": 0, "keys": 0, "batch": None}
    put((3, 1.0), (5, 2.0))  # two versions of a time: the greater state counts
    assert spans() == [(0, 3, 1.0), (3, 9, 2.0), (9, None, 1.0)]
    assert [r.price for r in H.as_of(HT.read(spark, tmp_dir, "t", KEYS), T0 + dt.timedelta(days=4)).collect()] == [2.0]


def test_failed_batch_leaves_nothing(spark, tmp_dir, monkeypatch):
    first, second = [("a", "1", T0, 1.0, "F", 0)], [("a", "1", T0 + dt.timedelta(days=1), 2.0, "F", 0)]
    put = lambda rows: HT.append(spark, tmp_dir, "t", spark.createDataFrame(rows, SCHEMA), KEYS, "at", STATE)
    put(first)

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(H, "intervals", broken)
        with pytest.raises(RuntimeError):
            put(second)
    assert rows_of(HT.read(spark, tmp_dir, "t", KEYS)) == slow(first)
    put(second)
    assert rows_of(HT.read(spark, tmp_dir, "t", KEYS)) == slow(first + second)
