"""Property tests (hypothesis): quantiles and qcut buckets against pandas on
random data with ties and NULLs; bucket counts add up to the non-null rows;
pair merge counts add up to the distinct batch keys."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from basketry import schemas as SC
from basketry.functions.quantiles import quantiles
from basketry.operators import features as FE
from basketry.operators import merge as M

values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(vals=values, p=st.floats(0, 1))
def test_quantile_property(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    s = pd.Series(vals, dtype="float64")
    rows = quantiles(df, "v", {"q": p}).collect()
    if s.notna().sum() == 0:
        assert rows[0]["n"] == 0 and rows[0]["q"] is None
    else:
        assert abs(rows[0]["q"] - s.quantile(p)) <= 1e-9 * max(1.0, abs(s.quantile(p)))


@SETTINGS
@example(vals=[8.25, 3.25, 0.0, 3.25, 0.0, 8.75])
@given(vals=values)
def test_qcut_property(spark, vals):
    df = spark.createDataFrame([("s", str(i), v, None) for i, v in enumerate(vals)],
                               "source string, source_id string, price double, category string")
    got = {int(r["source_id"]): r["price_bucket"] for r in FE.enrich_products(df, "price").collect()}
    s = pd.Series(vals, dtype="float64")
    try:
        codes = pd.qcut(s, q=5, duplicates="drop").cat.codes
        expect = {i: (None if c < 0 else int(c)) for i, c in enumerate(codes)}
    except ValueError:          # a single distinct value: no bucket at all
        expect = {i: None for i in range(len(vals))}
    assert got == expect
    bucketed = sum(1 for b in got.values() if b is not None)
    assert bucketed in (0, int(s.notna().sum()))   # all non-null rows get a bucket, or none (one edge)


@SETTINGS
@given(existing=st.lists(st.sampled_from("abcdef"), max_size=6),
       batch=st.lists(st.tuples(st.sampled_from("abcdefgh"), st.integers(0, 3)), max_size=12))
def test_pair_merge_counts_property(spark, existing, batch):
    def row(k, t, h):
        return ("p", k, k, 1.0, None, None, None, None, dt.datetime(2024, 1, 1, t), h, None, None)
    ex = spark.createDataFrame([row(k, 0, "e") for k in existing], SC.PRODUCTS)
    bt = spark.createDataFrame([row(k, t, f"h{t}") for k, t in batch], SC.PRODUCTS)
    res = M.merge_products(ex, bt, "pair")
    c = res.counts.first()
    keys = {k for k, _ in batch}
    assert c["new"] + c["updated"] == len(keys)
    assert c["updated"] == len(keys & set(existing))
    table = res.table.collect()
    assert len(table) == len([k for k in existing if k not in keys]) + len(keys)
