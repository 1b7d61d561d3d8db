"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed single words, word pairs and pairs with one word skipped of a whole text. Per-coordinate
rates fit rare and common features alike, and the L1 term leaves few weights, which travel to every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import class_share, crc_class, map_texts, narrow, raw_texts, slices, within

BITS = 20
# A-Z to lower case; other ASCII that isn't a letter ends a word; bytes above ASCII belong to words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every gram of every text, repeats included."""
    hashes, counts = [], []
    for raw in texts:
        words = raw.translate(LETTERS).split()
        counts.append(len(words))
        hashes.append(np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words)))
    u = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    u = (u + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    rows, feats = [row], [u]
    for gap, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        if len(u) > gap:
            same = row[:-gap] == row[gap:]
            rows.append(row[:-gap][same])
            feats.append(((u[:-gap] >> np.uint64(7)) ^ (u[gap:] * np.uint64(factor)))[same] * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate(rows), (np.concatenate(feats) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_grams(texts: list[bytes]) -> list[np.ndarray]:
    row, feat = grams(texts)
    pairs = np.unique((row << BITS) | feat)
    cuts = np.searchsorted(pairs >> BITS, np.arange(1, len(texts)))
    return np.split(pairs & ((1 << BITS) - 1), cuts)


def ftrl(rows: list[tuple[np.ndarray, int]], alpha: float, beta: float, l1: float, l2: float, epochs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, intercept). The intercept has a rate of its own and no penalty.

    A feature gathers at most one unit of gradient for each document and epoch before it gets a weight, so those that
    cannot reach ``l1`` are left out from the start; the result is the same.
    """
    often = np.zeros(1 << BITS, dtype=np.int64)
    for feats, _ in rows:
        often[feats] += 1
    rows = [(feats[often[feats] * epochs > l1], y) for feats, y in rows]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, bias_n = 0.0, 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for feats, y in rows:
            zi, ni = z[feats], n[feats]
            w = weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            root = np.sqrt(ni + g * g)
            z[feats] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[feats] = ni + g * g
            bias_n += g * g
            bias -= alpha * g / (beta + np.sqrt(bias_n))
    w = weights(z, n)
    keep = np.flatnonzero(w)
    return keep, w[keep], float(bias)


def score(texts: list[bytes], dense: np.ndarray, bias: float) -> np.ndarray:
    row, feat = grams(texts)
    hit = dense[feat] != 0
    pairs = np.unique((row[hit] << BITS) | feat[hit])
    total = np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=len(texts)) + bias
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def labelled(docs: DataFrame, labels: DataFrame, label: str, mod: int, out: int, bound: int, cost: Column, limit: int, seed: int) -> DataFrame:
    """(doc_id, y, text) of about ``bound`` labelled documents at most, none of them of the held-out class, whose ``cost`` sums to ``limit`` at most.

    A doc_id with several labels has the largest, one with several texts the first in order; null ids and labels don't count.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (crc_class("doc_id", mod) != out))
    sample = class_share(known.groupBy("doc_id").agg(F.max("y").alias("y")), ["doc_id"], "y", bound, seed)
    # at most about ``bound`` (id, label) pairs, whatever the size of the tables; rows of a repeated id are met before the shuffle
    one = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    return within(one, ["doc_id"], cost, limit, seed)


def train(sample: DataFrame, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Features are made where the texts are; one task then learns from the bounded sample, in the order of a hash of the ids.

    ``l1`` is a rate: chance sums of gradients grow with the root of the number of rows, and so does the term against them.
    """

    def fn(batch, texts):
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "feats": pa.array([f.astype(np.int32) for f in distinct_grams(texts)], type=pa.list_(pa.int32()))}

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["doc_id"].to_numpy()
        order = np.lexsort((ids, ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        rows = [(frame["feats"].iloc[i], int(frame["y"].iloc[i])) for i in order]
        feats, w, bias = ftrl(rows, alpha, beta, l1 * len(rows) ** 0.5, l2, epochs)
        return pd.DataFrame({"feat": [-1, *feats.tolist()], "w": [bias, *w.tolist()]})

    made = map_texts(sample, "text", "doc_id long, y int, feats array<int>", fn).withColumn("all", F.lit(0))
    got = made.groupBy("all").applyInPandas(fit, "feat int, w double").collect()  # 2**BITS rows at most
    table = sorted((r["feat"], r["w"]) for r in got)
    if not table:
        return np.empty(0, np.int64), np.empty(0), -35.0
    return np.array([f for f, _ in table[1:]], dtype=np.int64), np.array([w for _, w in table[1:]]), table[0][1]


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = 0.7, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``.

    Learns from at most about ``bound`` (12,000) labelled documents of ``limit`` bytes (64 MB) together, outside the held-out third; options as for ``scorer_of``. Null and empty texts have the
    score of the intercept alone; without any usable label every score is next to 0. Repeated rows are scored alike, a null
    doc_id stays null (its id counts as empty text for held_out), an empty table gives an empty result, other columns are ignored.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    scorer = scorer_of(texts, narrow(labels, doc_id=id_col, y=label_col), **options)

    def fn(batch, raw):
        p = scorer(raw)
        return {"doc_id": batch.column("doc_id"), "score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))}

    return map_texts(texts, "text", "doc_id long, score double, predicted int", fn).select(
        "doc_id", (crc_class("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def scorer_of(texts: DataFrame, labels: DataFrame, bound: int = 12_000, limit: int = 64 << 20, alpha: float = 4.0, beta: float = 1.0, l1: float = 0.12,
              l2: float = 0.1, epochs: int = 8, seed: int = 6) -> Callable[[list[bytes]], np.ndarray]:
    """A function from raw texts to scores, learned from (doc_id, text) and (doc_id, y)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    feats, w, bias = train(labelled(texts, labels, "y", 3, 1, bound, size, limit, seed), alpha, beta, l1, l2, epochs)

    def run(raw: list[bytes]) -> np.ndarray:
        dense = np.zeros(1 << BITS)
        dense[feats] = w
        return score(raw, dense, bias)

    return run


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, unchanged.

    Null and empty texts have the score of the intercept alone, very long ones are scored whole, repeated rows stay or go together, null ids make no
    difference, an empty table gives an empty result. Other columns may have any name and type.
    """
    scorer = scorer_of(narrow(docs, doc_id=id_col, text=text_col), narrow(labels, doc_id=id_col, y=label_col), **options)

    def run(batches):
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(scorer(raw_texts(batch.column(text_col))) < threshold))

    return docs.mapInArrow(run, docs.schema)
