"""Volume alerts against a plain loop: gaps, ties, missing days."""

import datetime as dt
import random
import statistics

import pytest

from basketry.operators import runlog as RL

T0 = dt.date(2024, 2, 25)


def slow(rows, frame, least, high, low):
    day = {}
    for by, d, v in rows:
        if d is not None and v is not None:
            day[by, d] = day.get((by, d), 0) + v
    last, out = max(d for _, d in day), []
    for by in {b for b, _ in day}:
        mine = {d: v for (b, d), v in day.items() if b == by}
        for i in range((last - min(mine)).days + 1):
            d = min(mine) + dt.timedelta(i)
            before = [mine[d - dt.timedelta(k)] for k in range(1, frame + 1) if d - dt.timedelta(k) in mine]
            if d not in mine and not before:
                continue
            m, v = statistics.median(before) if before else None, mine.get(d)
            status = "missing" if v is None else "new" if len(before) < least else "spike" if v > high * m else "drop" if v < low * m else "ok"
            out.append((by, d, v, m, len(before), status))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, frame", [(0, 7), (1, 1), (2, 30)])
def test_against_loop(spark, seed, frame):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), T0 + dt.timedelta(rng.randrange(60)), rng.choice([0, 5, 5, 6, 40, None])) for _ in range(120)]
    rows += [("a", None, 3)]
    got = RL.volume_alerts(spark.createDataFrame(rows, "by string, day date, volume long"), ["by"], frame=frame)
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows, frame, 3, 2.0, 0.5)


def test_spike_drop_gap_and_tie(spark):
    volumes = [10, 10, 20, 20, 31, 30, 7, None, None, 16, 1]
    rows = [("p", T0 + dt.timedelta(i), v) for i, v in enumerate(volumes) if v is not None]
    got = {r.day: r for r in RL.volume_alerts(spark.createDataFrame(rows, "by string, day date, volume long"), ["by"]).collect()}
    status = [got[T0 + dt.timedelta(i)].status for i in range(len(volumes))]
    # the fifth day is above twice the median 15; the sixth is not above twice 20
    assert status == ["new", "new", "new", "ok", "spike", "ok", "drop", "missing", "missing", "ok", "drop"]
    assert got[T0 + dt.timedelta(9)].n_before == 5 and got[T0 + dt.timedelta(9)].median == 20.0
    assert RL.volume_alerts(spark.createDataFrame([], "by string, day date, volume long"), ["by"]).count() == 0


def test_no_series_in_one_task(spark):
    df = spark.createDataFrame([("p", T0 + dt.timedelta(i), 1) for i in range(50)], "by string, day date, volume long")
    plan = RL.volume_alerts(df, ["by"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
