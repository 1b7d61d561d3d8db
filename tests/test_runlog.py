"""Run-log rollup, melt and cumulative sums (older rows lack the updated_* counters)."""

import datetime as dt

from basketry import schemas as SC
from basketry.operators import runlog as RL


def _runs(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("r1", t(1), t(2), "success", 1, 10, 5, None, None, ["a"]),
            ("r3", t(5), t(6), "success", 1, 0, 2, 3, 1, ["a"]),
            ("r2", t(3), t(4), "success", 2, 20, 0, 7, None, ["a", "b"])]
    return spark.createDataFrame([(*r, None) for r in rows], SC.RUN_LOG)


def test_rollup(spark):
    r = RL.rollup(_runs(spark)).first()
    assert r["total_runs"] == 3
    assert (r["latest_new_products"], r["latest_updated_products"]) == (0, 3)
    assert (r["cum_new_products"], r["cum_updated_products"], r["cum_updated_orders"]) == (30, 10, 1)
    assert r["products_update_ratio"] == round(10 / 30, 2)
    assert r["orders_update_ratio"] == round(1 / 7, 2)


def test_melt_and_cumulative(spark):
    long = RL.melt(_runs(spark))
    assert long.count() == 12
    cum = {r["started_at"].hour: r for r in RL.cumulative(_runs(spark)).collect()}
    assert [cum[h]["cum_new_products"] for h in (1, 3, 5)] == [10, 30, 30]
    assert cum[1]["cum_updated_products"] is None and cum[5]["cum_updated_products"] == 10
