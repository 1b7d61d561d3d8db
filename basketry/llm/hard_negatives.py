"""Hard-negative mining: exact integer scores by residue-number-system matrix products, then a windowed selection.

Components become integers. For each of several small primes, both matrices are reduced to centred residues and multiplied in float32; the
primes are small enough for every partial sum to stay below 2**24, so each product is exact. Chinese remaindering (mixed radix digits) gives back the
signed scores: the number of primes follows from the largest component, so that their product exceeds twice any score.

Anchors go to the tasks in groups of a fixed size, one pass over the rows for each group, and the rows stay where they are: what is shuffled is each task's
few best rows of an anchor. A first pass finds the anchors' positives, a second the negatives within each positive's window of scores.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import finite_vector, materialize, narrow

DEPTH = 256  # components multiplied at once
CELLS = 1 << 21  # scores held at once


def primes_for(bound: int) -> list[int]:
    """The largest primes whose centred residues multiply exactly in float32 (``DEPTH`` products below 2**24), as many as signed scores up to ``bound`` need."""
    top = 2 * int((((1 << 24) - 1) / DEPTH) ** 0.5) + 1
    found: list[int] = []
    p = top
    while reduce(lambda a, b: a * b, found, 1) <= 2 * bound:
        if all(p % q for q in range(2, int(p ** 0.5) + 1)):
            found.append(p)
        p -= 1
    return found


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Centred residues, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products (int64) from the residues of both sides, one matrix for each prime."""
    digits: list[np.ndarray] = []
    total, radix = np.zeros((len(a[0]), len(b[0])), dtype=np.int64), 1
    for i, p in enumerate(primes):
        r = np.zeros(total.shape, dtype=np.int64)
        for at in range(0, a[i].shape[1], DEPTH):
            r += (a[i][:, at:at + DEPTH] @ b[i][:, at:at + DEPTH].T).astype(np.int64)
        # the i-th mixed radix digit: (r - d0 - d1 p0 - d2 p0 p1 - ...) / (p0 p1 ...), modulo p
        known, weight = np.zeros_like(r), 1
        for q, d in zip(primes, digits):
            known += d * (weight % p)
            weight *= q
        d = (r - known) * pow(weight, -1, p) % p
        # a digit above half counts from above: the sum of such digits is the residue nearest to zero
        d = np.where(d > p // 2, d - p, d)
        digits.append(d)
        total += d * radix
        radix *= p
    return total


def kept(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` best of each anchor: higher scores first, ties by smaller id."""
    order = np.lexsort((ident, -score, anchor))
    a = anchor[order]
    first = np.searchsorted(a, a, side="left")
    return order[np.arange(len(a)) - first < most]


class Best:
    """The ``most`` best rows of each of ``n`` slots so far."""

    def __init__(self, n: int, most: int):
        self.most, self.slot, self.score, self.ident = most, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least, self.full = np.zeros(n, np.int64), np.zeros(n, bool)

    def wanted(self, score: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Scores (slots, rows) that may still enter."""
        return ~self.full[slots][:, None] | (score >= self.least[slots][:, None])

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        slot, score, ident = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.ident, ident])
        at = kept(slot, score, ident, self.most)
        self.slot, self.score, self.ident = slot[at], score[at], ident[at]
        count = np.bincount(self.slot, minlength=len(self.full))
        self.full = count >= self.most
        last = np.cumsum(count) - 1
        self.least[self.full] = self.score[last[self.full]]


class Anchors:
    """A group of anchors of one vector length: ids, labels, residues for each prime."""

    def __init__(self, rows: list, primes: list[int], scale: int):
        self.ident = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        x = np.floor(np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), -1) * scale).astype(np.int64)
        self.residues = [residues(x, p) for p in primes]
        self.key = np.array([r["anchor"] for r in rows], dtype=np.int64)


def blocks(batches, groups: dict[int, Anchors], primes: list[int], scale: int):
    """(vector length, anchors' range, scores, labels and ids of the rows) for each block of rows against each block of anchors of the same length."""
    for batch in batches:
        size = np.asarray(pc.list_value_length(batch.column("v")))
        for dim in np.unique(size):
            if int(dim) not in groups:
                continue
            g, at = groups[int(dim)], np.flatnonzero(size == dim)
            mine = batch.take(pa.array(at))
            label, ident = (mine.column(c).to_numpy(zero_copy_only=False) for c in ("label", "vec_id"))
            x = np.floor(mine.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1) * scale).astype(np.int64)
            step = max(1, CELLS // max(1, len(g.ident)))
            for row in range(0, len(at), max(step, 256)):
                some = slice(row, row + max(step, 256))
                b = [residues(x[some], p) for p in primes]
                for first in range(0, len(g.ident), CELLS // 256):
                    part = np.arange(first, min(first + CELLS // 256, len(g.ident)))
                    yield int(dim), part, scores([r[part] for r in g.residues], b, primes), label[some], ident[some]


def positives_in(batches, groups: dict[int, Anchors], primes: list[int], scale: int, most: int):
    best = {dim: Best(len(g.ident), most) for dim, g in groups.items()}
    for dim, part, s, label, ident in blocks(batches, groups, primes, scale):
        g = groups[dim]
        ok = (g.label[part][:, None] == label) & (g.ident[part][:, None] != ident) & best[dim].wanted(s, part)
        r, c = np.nonzero(ok)
        if len(r):
            best[dim].add(part[r], s[r, c], ident[c])
    for dim, b in best.items():
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(groups[dim].key[b.slot]), "positive_id": pa.array(b.ident), "positive_score": pa.array(b.score)})


def negatives_in(batches, groups: dict[int, Anchors], windows: dict[int, list], primes: list[int], scale: int, most: int, low: int, high: int):
    """``windows``: for each vector length, (anchors' slots, positive scores, rows of the result) of the first, second, ... positives."""
    best = {dim: [Best(len(slots), most) for slots, _, _ in w] for dim, w in windows.items()}
    for dim, part, s, label, ident in blocks(batches, groups, primes, scale):
        g = groups[dim]
        other = g.label[part][:, None] != label
        for (slots, score, _), b in zip(windows[dim], best[dim]):
            # the anchors of this block that have such a positive
            lo, hi = np.searchsorted(slots, [part[0], part[-1] + 1])
            if lo == hi:
                continue
            mine, at = s[slots[lo:hi] - part[0]], np.arange(lo, hi)
            t = score[lo:hi][:, None]
            ok = other[slots[lo:hi] - part[0]] & (low * t <= 100 * mine) & (100 * mine <= high * t) & b.wanted(mine, at)
            r, c = np.nonzero(ok)
            if len(r):
                b.add(at[r], mine[r, c], ident[c])
    for dim, found in best.items():
        for (_, _, rows), b in zip(windows[dim], found):
            yield pa.RecordBatch.from_pydict({"positive": pa.array(rows[b.slot]), "negative_id": pa.array(b.ident), "negative_score": pa.array(b.score)})


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", every: int = 50, positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, group: int = 16384) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor (id divisible by ``every``) and each of its ``positives``
    best other rows of the same label, the ``negatives`` best rows of another label whose score is ``low`` to ``high`` percent of the positive's.

    Scores are inner products of floor(scale * component); higher ones come first, ties by smaller id. Labels are whole numbers. Rows with a null id or label, a null vector, or a null or
    non-finite component take no part. Vectors of different lengths don't meet. Rows with the anchor's own id are never its positives; repeated rows are rows of
    their own among positives and negatives, repeated anchors count once. A row with a component so large that a hundredfold score could leave a long
    takes no part (beyond about 65,000 at 64 components). Too few rows give fewer results, an empty table none; other columns are ignored.

    ``group`` anchors at a time are in the driver and in every task.
    """
    rows = narrow(vectors, vec_id=id_col, v=vec_col, label=label_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite_vector(F.col("v")))
    largest = F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0))
    # size * component**2 * 100 fits in a long
    rows = rows.where((largest * scale + 1) * F.sqrt(F.size("v").cast("double")) < float(1 << 27))
    bound = rows.agg(F.max(F.size("v") * F.pow(F.ceil(largest * scale) + 1, 2))).first()[0]
    primes = primes_for(int(bound or 0) + 1)
    asked = materialize(rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct())
    groups = -(-asked.count() // group)
    asked = materialize(asked.withColumn("_group", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(max(groups, 1) * 2))))
    folder = f"{ensure_checkpoint_dir(vectors.sparkSession)}/negatives-{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for at in range(groups * 2):
        mined(rows, asked.where(F.col("_group") == at), primes, positives, negatives, low, high, scale).write.mode("append").parquet(folder)
    return vectors.sparkSession.read.schema(schema).parquet(folder) if groups else vectors.sparkSession.createDataFrame([], schema)


def mined(rows: DataFrame, asked: DataFrame, primes: list[int], positives: int, negatives: int, low: int, high: int, scale: int) -> DataFrame:
    """The result for one group of anchors."""
    spark = rows.sparkSession
    by_dim: dict[int, list] = {}
    ids: list[int] = []
    for r in asked.select("vec_id", "label", "v").orderBy("vec_id", "label", "v").collect():
        by_dim.setdefault(len(r["v"]), []).append({"anchor": len(ids), **r.asDict()})
        ids.append(r["vec_id"])
    groups = spark.sparkContext.broadcast({dim: Anchors(v, primes, scale) for dim, v in by_dim.items()})
    slot = {int(k): (dim, i) for dim, g in groups.value.items() for i, k in enumerate(g.key)}

    best = rows.mapInArrow(lambda it: positives_in(it, groups.value, primes, scale, positives), "anchor long, positive_id long, positive_score long")
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id"))
    best = best.withColumn("nth", nth).where(F.col("nth") <= positives)
    found = sorted(best.collect(), key=lambda r: (r["anchor"], r["nth"]))  # at most ``positives`` rows for each of the group's anchors
    windows: dict[int, list] = {}
    for dim in by_dim:
        for n in range(1, positives + 1):
            of = [(slot[r["anchor"]][1], r["positive_score"], i) for i, r in enumerate(found) if r["nth"] == n and slot[r["anchor"]][0] == dim]
            windows.setdefault(dim, []).append(tuple(np.array(c, dtype=np.int64) for c in (zip(*sorted(of)) if of else ([], [], []))))
    there = spark.sparkContext.broadcast(windows)
    hard = rows.mapInArrow(lambda it: negatives_in(it, groups.value, there.value, primes, scale, negatives, low, high),
                           "positive long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("positive").orderBy(F.desc("negative_score"), "negative_id"))
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    of = spark.createDataFrame([(i, ids[r["anchor"]], r["positive_id"], r["positive_score"]) for i, r in enumerate(found)],
                               "positive long, anchor_id long, positive_id long, positive_score long")
    return hard.join(F.broadcast(of), "positive").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
