"""Document quality: a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of its own and of the lines beside it; transitions tie neighbours together. The
forward-backward marginals of the lines, weighted by their lengths, make the document's score, set on the labels' scale by
a logistic curve in its log-odds.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_class, map_texts, narrow
from .toxicity import labelled

# Classes of bytes: upper case, digits, white space, marks of prose, other symbols; the rest (lower case, bytes above ASCII) is 0.
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[65:91], CLASS[48:58] = 1, 2
CLASS[[9, 11, 12, 13, 32]] = 3
CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 4
CLASS[[b for b in range(128) if CLASS[b] == 0 and not 97 <= b <= 122]] = 5
RATIOS = np.array([0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6])
SIZES = np.array([1, 10, 30, 80, 200, 500, 2000])
WORDS = np.array([2, 3.5, 5, 6.5, 8, 11])
REPEATS = np.array([0.1, 0.3, 0.5, 0.7, 0.9])
OWN = 5 * 8 + 8 + 7 + 6 + 3  # one-hot features of a line


def lines_of(raw: bytes) -> list[bytes]:
    """The lines that aren't blank; a text without any is one empty line."""
    return [x for x in raw.split(b"\n") if x.strip()] or [b""]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line features, 0 or 1; lengths in bytes; lines of each text)."""
    lines, counts, seen, fresh = [], [], [], []
    for raw in texts:
        own = lines_of(raw)
        times = Counter(own)
        seen.extend(times[x] > 1 for x in own)
        lines.extend(own)
        counts.append(len(own))
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    n_words = np.empty(len(lines))
    for i, x in enumerate(lines):
        words = x.split()
        n_words[i] = len(words)
        fresh.append(len(set(words)) / len(words) if words else 1.0)
    kinds = CLASS[np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    out = np.zeros((len(lines), OWN), dtype=np.uint8)
    row, at = np.arange(len(lines)), 0
    for k in range(1, 6):
        n = np.add.reduceat(kinds == k, starts, dtype=np.int64) - (k == 5)  # the line end itself counts as a symbol
        out[row, at + np.digitize(n / np.maximum(sizes, 1), RATIOS)] = 1
        at += 8
    for values, edges in ((sizes, SIZES), (sizes / np.maximum(n_words, 1), WORDS), (np.array(fresh), REPEATS)):
        out[row, at + np.digitize(values, edges)] = 1
        at += len(edges) + 1
    out[:, at] = seen
    out[:, at + 1] = [x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines]
    out[:, at + 2] = sizes == 0
    return out, sizes, np.array(counts, dtype=np.int64)


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it in the same text, and whether there are such lines."""
    n = len(own)
    ends = np.cumsum(counts)
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    first[ends - counts], last[ends - 1] = True, True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    return np.hstack([own, before, after, np.stack([first, last], axis=1).astype(np.uint8)])


class Chains:
    """Forward-backward over many chains at once: step t works on all chains longer than t."""

    def __init__(self, counts: np.ndarray):
        self.order = np.argsort(-counts, kind="stable")
        self.starts = (np.cumsum(counts) - counts)[self.order]
        longer = np.sort(counts)
        self.active = [len(counts) - int(np.searchsorted(longer, t, side="right")) for t in range(int(counts.max(initial=0)))]
        self.ends = (np.cumsum(counts) - 1)[self.order]

    def run(self, good: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """``good``: score of label 1 (label 0 has 0); ``trans``: 2 x 2. Marginal of label 1, sums of pair marginals, sum of log Z."""
        unary = np.stack([np.zeros_like(good), good], axis=1)
        alpha, beta = np.empty_like(unary), np.zeros_like(unary)
        for t, n in enumerate(self.active):
            at = self.starts[:n] + t
            if t:
                a = alpha[at - 1]
                alpha[at] = unary[at] + np.logaddexp(a[:, :1] + trans[0], a[:, 1:] + trans[1])
            else:
                alpha[at] = unary[at]
        pairs = np.zeros((2, 2))
        log_z = np.empty(len(good))
        z = np.logaddexp(alpha[self.ends, 0], alpha[self.ends, 1])
        for t in range(len(self.active) - 1, 0, -1):
            n = self.active[t]
            at = self.starts[:n] + t
            later = unary[at] + beta[at]
            beta[at - 1] = np.logaddexp(trans[:, 0] + later[:, :1], trans[:, 1] + later[:, 1:])
            joint = alpha[at - 1][:, :, None] + trans + later[:, None, :] - z[:n, None, None]
            pairs += np.exp(joint).sum(0)
        for t, n in enumerate(self.active):
            log_z[self.starts[:n] + t] = z[:n]
        return np.exp(alpha[:, 1] + beta[:, 1] - log_z), pairs, float(z.sum())


def fit(x: np.ndarray, sizes: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int, rate: float, l2: float) -> np.ndarray:
    """Parameters: line weights, four transitions, slope and intercept of the logistic curve. Every line carries its document's label."""
    chains = Chains(counts)
    line_y = np.repeat(y, counts).astype(float)
    p = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (counts[y == k] - 1).sum()
    dense = x.astype(np.float32)
    for i in range(1, steps + 1):
        marg, pairs, _ = chains.run((dense @ p[:-4].astype(np.float32)).astype(float), p[-4:].reshape(2, 2))
        g = np.concatenate([dense.T @ (marg - line_y).astype(np.float32), (pairs - seen).ravel()]) / len(line_y) + l2 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-9)
    marg, _, _ = chains.run((dense @ p[:-4].astype(np.float32)).astype(float), p[-4:].reshape(2, 2))
    odds = document_odds(marg, sizes, counts)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on the log-odds
        q = 1 / (1 + np.exp(-np.clip(a * odds + b, -35, 35)))
        g = np.array([((q - y) * odds).sum() + 1e-2 * (a - 1), (q - y).sum() + 1e-2 * b])
        w = q * (1 - q)
        h = np.array([[(w * odds * odds).sum() + 1e-2, (w * odds).sum()], [(w * odds).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = max(a - step[0], 1e-3), b - step[1]
    return np.concatenate([p, [a, b]])


def document_odds(marg: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-odds of the length-weighted mean of the marginals (an empty line weighs as one byte)."""
    weight = np.maximum(sizes, 1)
    starts = np.cumsum(counts) - counts
    mean = np.add.reduceat(marg * weight, starts) / np.add.reduceat(weight, starts)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def score(texts: list[bytes], p: np.ndarray) -> np.ndarray:
    if not texts:
        return np.empty(0)
    own, sizes, counts = line_features(texts)
    good = with_neighbours(own, counts).astype(np.float32) @ p[:-6].astype(np.float32)
    marg, _, _ = Chains(counts).run(good.astype(float), p[-6:-2].reshape(2, 2))
    return 1 / (1 + np.exp(-np.clip(p[-2] * document_odds(marg, sizes, counts) + p[-1], -35, 35)))


def train(sample: DataFrame, steps: int, rate: float, l2: float) -> np.ndarray | None:
    """Line features are made where the texts are; one task then learns from the bounded sample, in the order of a hash of the ids."""

    def fn(batch, texts):
        own, sizes, counts = line_features(texts)
        packed = np.packbits(own, axis=1)
        cuts = np.cumsum(counts)[:-1]
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "own": pa.array([x.tobytes() for x in np.split(packed, cuts)], type=pa.binary()),
                "sizes": pa.array([x.astype(np.int64).tobytes() for x in np.split(sizes, cuts)], type=pa.binary())}

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["doc_id"].to_numpy()
        frame = frame.iloc[np.lexsort(([zlib.crc32(b) for b in frame["own"]], ids, ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))]
        sizes = [np.frombuffer(b, dtype=np.int64) for b in frame["sizes"]]
        counts = np.array([len(s) for s in sizes])
        packed = np.frombuffer(b"".join(frame["own"]), dtype=np.uint8).reshape(counts.sum(), -1)
        own = np.unpackbits(packed, axis=1, count=OWN)
        return pd.DataFrame({"p": [fit(with_neighbours(own, counts), np.concatenate(sizes), counts, frame["y"].to_numpy(), steps, rate, l2).tolist()]})

    made = map_texts(sample, "text", "doc_id long, y int, own binary, sizes binary", fn).withColumn("all", F.lit(0))
    got = made.groupBy("all").applyInPandas(learn, "p array<double>").collect()
    return np.array(got[0]["p"]) if got else None


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = 0.5, bound: int = 3000, limit: int = 60_000, steps: int = 150, rate: float = 0.1, l2: float = 1e-4, seed: int = 7) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``.

    Learns from at most about ``bound`` labelled documents of ``limit`` lines together, outside the held-out third; documents are never cut, one of more lines is
    scored but not learned from. A null or blank text is one empty line.
    Without any usable label every score is 1/2. Repeated rows are scored alike, a null doc_id stays null (empty text for held_out), an
    empty table gives an empty result, other columns are ignored.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    p = train(labelled(texts, narrow(labels, doc_id=id_col, y=label_col), "y", 3, 1, bound, lines, limit, seed), steps, rate, l2)

    def fn(batch, raw):
        s = np.full(len(raw), 0.5) if p is None else score(raw, p)
        return {"doc_id": batch.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}

    return map_texts(texts, "text", "doc_id long, score double, predicted int", fn).select(
        "doc_id", (crc_class("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
