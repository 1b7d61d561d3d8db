"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (n = 1 to 3, blended) that both contain, over the root of the product of both texts' own
numbers. A Nystrom map over landmark texts and one-versus-rest ridge regression on it are learned from a bounded
sample. As the kernel is linear in the presence vectors, map and regression fold into one matrix of n-grams by languages, and a batch of
texts is scored by one product with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import class_share, crc_class, map_texts, narrow, within
from .toxicity import LETTERS

BITS = 16
SPECTRUM = 3
CHUNK = 256  # texts in a presence matrix


def presence(texts: list[bytes]) -> np.ndarray:
    """(texts, 2**BITS) of 0 and 1: which hashed n-grams each text contains. ASCII is lower-cased, all but letters is a space."""
    flat = np.frombuffer(b"".join(t.translate(LETTERS) for t in texts), dtype=np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in texts])
    out = np.zeros((len(texts), 1 << BITS), dtype=np.uint8)
    cells = out.reshape(-1)
    gram = np.zeros_like(flat)
    for n in range(1, SPECTRUM + 1):
        keep = len(flat) - n + 1
        if keep <= 0:
            break
        gram = (gram[:keep] << np.uint32(8)) | flat[n - 1:]
        hashed = (gram * np.uint32(0x9E3779B1) + np.uint32(0x85EBCA6B * n & 0xFFFFFFFF)) >> np.uint32(32 - BITS)
        inside = row[:keep] == row[n - 1:]
        cells[(row[:keep][inside] << BITS) | hashed[inside]] = 1
    return out


def chunks(texts: list[bytes]):
    for at in range(0, len(texts), CHUNK):
        yield presence(texts[at:at + CHUNK])


def has_letter(raw: bytes) -> bool:
    return raw.translate(LETTERS).strip() != b"" and (raw.isascii() or any(c.isalpha() for c in raw.decode()))


class Model:
    """Languages, the n-grams that any landmark contains, and their weights (n-grams, languages)."""

    def __init__(self, langs: list[str], grams: np.ndarray, weights: np.ndarray):
        self.langs, self.grams, self.weights = langs, grams, weights.astype(np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        parts = []
        for x in chunks(texts):
            own = np.sqrt(np.maximum(x.sum(1, dtype=np.int64), 1))
            parts.append(x[:, self.grams].astype(np.float32) @ self.weights / own[:, None])
        return np.concatenate(parts)


def fit(feats: list[np.ndarray], langs: list[str], landmarks: int, ridge: float) -> Model:
    """Rows come in a seeded order; landmarks are the first rows of each language in turn."""
    names = sorted(set(langs))
    y = np.array([names.index(v) for v in langs])
    nth = np.empty(len(y), dtype=np.int64)
    for k in range(len(names)):
        nth[y == k] = np.arange((y == k).sum())
    chosen = np.lexsort((y, nth))[:landmarks]
    grams = np.unique(np.concatenate([feats[i] for i in chosen])) if len(chosen) else np.empty(0, np.int64)

    def dense(rows) -> np.ndarray:
        out = np.zeros((len(rows), len(grams)), dtype=np.float32)
        for i, r in enumerate(rows):
            at = np.searchsorted(grams, feats[r])
            at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == feats[r])] if len(grams) else at[:0]
            out[i, at] = 1 / np.sqrt(max(1, len(feats[r])))
        return out

    marks = dense(chosen)
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * max(value.max(initial=0.0), 1e-12)
    root = vector[:, keep] / np.sqrt(value[keep])  # the Nystrom map from kernel values
    zz, zy = np.zeros((keep.sum(), keep.sum())), np.zeros((keep.sum(), len(names)))
    for at in range(0, len(feats), CHUNK):
        rows = range(at, min(at + CHUNK, len(feats)))
        z = (dense(rows) @ marks.T).astype(np.float64) @ root
        zz += z.T @ z
        zy += z.T @ np.eye(len(names))[y[list(rows)]]
    w = np.linalg.solve(zz + ridge * np.eye(len(zz)), zy) if len(zz) else zy
    return Model(names, grams, marks.T.astype(np.float64) @ (root @ w))


def train(known: DataFrame, bound: int, limit: int, landmarks: int, ridge: float, seed: int) -> Model:
    """``known``: (doc_id, text, lang). Presence sets are made where the texts are; one task learns from the bounded sample."""
    drawn = class_share(known, ["doc_id", "text"], "lang", bound, seed).select("doc_id", "lang", "text").distinct()
    sample = within(drawn, ["doc_id", "lang", "text"], F.octet_length("text"), limit, seed)

    def fn(batch, texts):
        feats = [np.flatnonzero(r).astype(np.int32) for x in chunks(texts) for r in x]
        return {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "feats": pa.array(feats, type=pa.list_(pa.int32()))}

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["doc_id"].fillna(-1).to_numpy().astype(np.int64)
        key = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort(([len(f) for f in frame["feats"]], frame["lang"].to_numpy().astype(str), key))
        m = fit([frame["feats"].iloc[i].astype(np.int64) for i in order], [frame["lang"].iloc[i] for i in order], landmarks, ridge)
        return pd.DataFrame({"lang": m.langs, "grams": [m.grams] * len(m.langs), "weights": list(m.weights.T.astype(float))})

    made = map_texts(sample, "text", "doc_id long, lang string, feats array<int>", fn).withColumn("all", F.lit(0))
    # a row for each language, 2**BITS n-grams at most
    rows = sorted(made.groupBy("all").applyInPandas(learn, "lang string, grams array<long>, weights array<double>").collect(), key=lambda r: r["lang"])
    if not rows:
        return Model([], np.empty(0, np.int64), np.empty((0, 0)))
    return Model([r["lang"] for r in rows], np.array(rows[0]["grams"], dtype=np.int64), np.array([r["weights"] for r in rows]).T)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bound: int = 4000, limit: int = 32 << 20,
             landmarks: int = 200, ridge: float = 0.1, seed: int = 9) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row per row of ``docs``.

    Learns from about ``bound`` documents of ``limit`` bytes together at most, with a language and outside the held-out quarter; equal rows count once, and
    every language gets its part of the bound. A null text, or one without a letter, is
    ``und`` with score 0, and so is every text if nothing could be learned. Score: the regression's value for the language, cut to 0..1; ties go
    to the first language in order. Repeated rows are scored alike, a null doc_id stays null (empty text for held_out), an empty table gives an empty
    result, other columns are ignored.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    model = train(texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_class("doc_id", 4) != 2)), bound, limit, landmarks, ridge, seed)

    def fn(batch, raw):
        if not model.langs or not raw:
            best, value = [None] * len(raw), np.zeros(len(raw))
        else:
            f = model.score(raw)
            best, value = [model.langs[i] for i in f.argmax(1)], np.clip(f.max(1), 0, 1).astype(float)
        letters = [b is not None and has_letter(t) for b, t in zip(best, raw, strict=True)]
        return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array([b if ok else "und" for b, ok in zip(best, letters, strict=True)]),
                "score": pa.array(np.where(letters, value, 0.0))}

    return map_texts(texts.select("doc_id", "text"), "text", "doc_id long, lang_pred string, score double", fn).select(
        "doc_id", (crc_class("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
