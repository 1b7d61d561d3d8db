"""Validity intervals from versions (slowly changing dimension, type 2).

A version says that a key had a state at a time. Versions of one key that say the same one after another are one interval; an interval ends
where the next state begins, the last one is open. What a row's neighbours in time say is found without any window over a whole frequent key:
such a key's versions are dealt to ranges of time, and only the edges of those ranges are compared across them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .merge import null_safe_on

RANGE = "_range"
KEY = "_key"       # struct of the key columns


@dataclass
class Ranged:
    rows: DataFrame    # with RANGE: 0, or the range of time within a frequent key
    split: bool        # whether any key has more than one range


def in_ranges(rows: DataFrame, keys: Sequence[str], at: str, most: int = 100_000, ranges: int = 1024) -> Ranged:
    """Rows of keys with more than ``most`` rows are dealt to ``ranges`` ranges of ``at``, cut at the key's approximate quantiles.
    ``rows`` (a written table) has one row for each key and time."""
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).checkpoint()
    if hot.isEmpty():
        return Ranged(rows.withColumn(RANGE, F.lit(0)), False)
    cuts = [i / ranges for i in range(1, ranges)]
    frequent = rows.join(hot, null_safe_on(rows, hot, keys), "left_semi")
    bounds = frequent.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.percentile_approx(at, cuts, 10 * ranges).alias("_cuts"))
    same = [rows[k].eqNullSafe(bounds[f"_k_{k}"]) for k in keys]
    place = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(at))), F.lit(0))
    dealt = rows.join(bounds, same, "left").withColumn(RANGE, F.when(F.col("_cuts").isNull(), 0).otherwise(place))
    return Ranged(dealt.drop("_cuts", *(f"_k_{k}" for k in keys)).checkpoint(), True)


def beside(ranged: Ranged, keys: Sequence[str], at: str, value: Column, name: str, ahead: bool) -> DataFrame:
    """Adds ``name``: ``value`` (never null) of the key's next row in time if ``ahead``, else of the one before; null at the end."""
    rows = ranged.rows.withColumn("_value", value)
    time = Window.partitionBy(*keys, RANGE).orderBy(at)
    step = F.lead if ahead else F.lag
    out = rows.withColumn(name, step("_value").over(time))
    if ranged.split:
        edge = (F.min_by if ahead else F.max_by)("_value", at)
        edges = rows.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col(RANGE).alias("_k_range")).agg(edge.alias("_edge"))
        # at most one row for each of a key's ranges
        order = Window.partitionBy(*(f"_k_{k}" for k in keys)).orderBy("_k_range")
        edges = edges.withColumn("_edge", step("_edge").over(order)).where(F.col("_edge").isNotNull())
        same = [out[k].eqNullSafe(edges[f"_k_{k}"]) for k in keys]
        out = out.join(edges, [*same, out[RANGE] == edges["_k_range"]], "left").withColumn(name, F.coalesce(name, "_edge"))
        out = out.drop("_edge", "_k_range", *(f"_k_{k}" for k in keys))
    return out.drop("_value")


def any_frequent(versions: DataFrame, keys: Sequence[str], most: int = 100_000, buckets: int = 1 << 14) -> bool:
    """Whether any key has more than ``most`` versions: counted by buckets of keys, then by key in the buckets that are that large."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    large = [r[0] for r in versions.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("_b").collect()]
    if not large:
        return False
    return not versions.where(bucket.isin(large)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).isEmpty()


def _unsplit(versions: DataFrame, at: str, state: Sequence[str], tie: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``intervals`` of keys none of which is frequent: rows are dealt by KEY once, or not at all if they come so."""
    best = F.max_by(F.struct(*state), F.struct(*tie, *state))
    if KEY not in versions.columns:
        versions = versions.withColumn(KEY, F.struct(*keys)).repartition(KEY)
    one = versions.where(F.col(at).isNotNull()).groupBy(KEY, F.col(at).alias("valid_from")).agg(best.alias("_state"))
    time = Window.partitionBy(KEY).orderBy("valid_from")
    told = one.withColumn("_before", F.lag(F.struct(F.col("_state").alias("s"))).over(time))
    changed = told.where(F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(F.col("_state")))
    out = changed.withColumn("valid_to", F.lead("valid_from").over(time))
    return out.select(*(F.col(KEY)[k].alias(k) for k in keys), *(F.col("_state")[c].alias(c) for c in state), "valid_from", "valid_to")


def intervals(versions: DataFrame, keys: Sequence[str], at: str, state: Sequence[str], tie: Sequence[str] = (),
              most: int = 100_000, ranges: int = 1024, frequent: bool = True) -> DataFrame:
    """(keys, state, valid_from, valid_to): one row for each key and stretch of time with one state; ``valid_to`` is exclusive, null while open.

    Of several versions of a key with one time the greatest by ``tie``, then by state, counts. Null keys are a key, null state values are
    values; versions without a time have no place and are left out. ``versions`` may be in any order and hold repeats.
    ``frequent=False`` (see ``any_frequent``): no key has more than ``most`` of them, so there is nothing to split."""
    if not frequent:
        return _unsplit(versions, at, state, tie, keys)
    ensure_checkpoint_dir(versions.sparkSession)
    best = F.max_by(F.struct(*state), F.struct(*tie, *state))
    one = versions.where(F.col(at).isNotNull()).groupBy(*keys, F.col(at).alias("valid_from")).agg(best.alias("_state")).checkpoint()
    ranged = in_ranges(one, keys, "valid_from", most, ranges)
    told = beside(ranged, keys, "valid_from", F.struct(F.col("_state").alias("s")), "_before", ahead=False)
    changed = told.where(F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(F.col("_state"))).drop("_before").checkpoint()
    out = beside(Ranged(changed, ranged.split), keys, "valid_from", F.struct(F.col("valid_from").alias("t")), "_next", ahead=True)
    return out.select(*keys, *(F.col("_state")[c].alias(c) for c in state), "valid_from", F.col("_next.t").alias("valid_to"))


def as_of(history: DataFrame, time) -> DataFrame:
    """The state of every key at one time."""
    t = time if isinstance(time, Column) else F.lit(time)
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
