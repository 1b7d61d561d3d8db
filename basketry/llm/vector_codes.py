"""Vector code compression: a codebook for each part of the vectors, entries found by equal-average search.

Components become integers, vectors are cut into equal parts, and each part position has its own codebook. The nearest entry of a part is
searched in order of component sums: entries lie sorted by their sum, the search starts at the part's own sum and goes outward, the nearer side
first. For a part of d components (sum of x - sum of c)^2 <= d |x - c|^2, so it ends once the squared gap of the sums over d strictly exceeds
the best distance; an entry that ties is never left out. All arithmetic is on integers, exact at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite_vector, lookup, materialize, narrow

LONGEST = (1 << 63) - 1


def integers(flat: np.ndarray, scale: int, d: int) -> np.ndarray:
    """floor(scale * x): int64 where the squared gap between sums of ``d`` such numbers fits, else Python integers."""
    with np.errstate(over="ignore"):
        v = np.floor(flat.astype(np.float64) * scale)
    if not v.size or np.abs(v).max() < (1 << 30) // d:
        return v.astype(np.int64)
    # a double whose product overflows is a whole number
    exact = [int(x) if np.isfinite(x) else int(float(y)) * scale for x, y in zip(v.ravel(), flat.ravel())]
    return np.array(exact, dtype=object).reshape(v.shape)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) for each row of ``x``; ties to the lower entry."""
    if x.dtype != book.dtype:
        x, book = x.astype(object), book.astype(object)
    n, d = x.shape
    entries = len(book)
    order = np.array(sorted(range(entries), key=lambda e: (book[e].sum(), e)), dtype=np.int64)
    by_sum, sums, own = book[order], book[order].sum(1), x.sum(1)
    up = np.searchsorted(sums, own)
    down = up - 1
    best, entry = np.zeros(n, dtype=x.dtype), np.full(n, -1, dtype=np.int64)
    live = np.arange(n)
    while len(live):
        lo, hi, t = down[live], up[live], own[live]
        gap_lo, gap_hi = t - sums[np.maximum(lo, 0)], sums[np.minimum(hi, entries - 1)] - t
        lower = (lo >= 0) & ((hi >= entries) | (gap_lo <= gap_hi).astype(bool))
        at, gap = np.where(lower, lo, hi), np.where(lower, gap_lo, gap_hi)
        on = (at < entries) & ((entry[live] < 0) | (gap * gap <= best[live] * d).astype(bool))
        live, at, lower = live[on], at[on], lower[on]
        distance = ((x[live] - by_sum[at]) ** 2).sum(1)
        found = order[at]
        better = (entry[live] < 0) | (distance < best[live]).astype(bool) | ((distance == best[live]).astype(bool) & (found < entry[live]))
        best[live[better]], entry[live[better]] = distance[better], found[better]
        down[live[lower]] -= 1
        up[live[~lower]] += 1
    return entry, best


def flat_vectors(column: pa.Array) -> np.ndarray:
    """The vectors of a batch, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def assigned(batches, books: list[np.ndarray], scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(batch, entries, squared distances, parts) of each batch; entries and distances are (rows, parts)."""
    for batch in batches:
        if batch.num_rows:
            x = flat_vectors(batch.column("v"))
            x = integers(x, scale, x.shape[1] // len(books))
            parts = np.split(x, len(books), axis=1)
            found = [nearest(p, b) for p, b in zip(parts, books)]
            yield batch, np.stack([e for e, _ in found], 1), np.stack([d for _, d in found], 1), parts


def refined(rows: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """Each used entry replaced by the floored mean of its parts. Sums leave a task once, one row for each entry it has used."""
    entries = len(books[0])

    def partial(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        count: dict[tuple[int, int], int] = {}
        for _, entry, _, parts in assigned(batches, books, scale):
            for p, x in enumerate(parts):
                by_entry = np.argsort(entry[:, p], kind="stable")
                used, first = np.unique(entry[by_entry, p], return_index=True)
                sums = np.add.reduceat(x[by_entry], first, axis=0)
                sizes = np.diff([*first, len(x)])
                for e, s, n in zip(used.tolist(), sums.astype(object), sizes.tolist()):
                    total[p, e] = total.get((p, e), 0) + s
                    count[p, e] = count.get((p, e), 0) + n
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([p for p, _ in total], pa.int32()), "entry": pa.array([e for _, e in total], pa.int32()),
            "total": pa.array([",".join(map(str, s)) for s in total.values()], pa.string()), "n": pa.array(list(count.values()), pa.int64())})

    def mean(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["n"].sum())
        sums = [sum(int(x) for x in column) for column in zip(*(t.split(",") for t in frame["total"]))]
        return pd.DataFrame({"part": [key[0]], "entry": [key[1]], "mean": [",".join(str(s // n) for s in sums)]})

    sums = rows.select("v").mapInArrow(partial, "part int, entry int, total string, n long")
    means = sums.groupBy("part", "entry").applyInPandas(mean, "part int, entry int, mean string")
    out = [b.astype(object) for b in books]
    for r in means.collect():  # at most parts x entries rows
        out[r["part"]][r["entry"]] = [int(x) for x in r["mean"].split(",")]
    return [narrowed(b) for b in out]


def narrowed(book: np.ndarray) -> np.ndarray:
    """int64 where ``integers`` would have it."""
    return book.astype(np.int64) if all(abs(x) < (1 << 30) // book.shape[1] for x in book.ravel()) else book


def train(rows: DataFrame, dim: int, parts: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """One codebook (entries, dim / parts) for each part of the rows' vectors ``v``: the rows of the smallest ids, refined ``rounds`` times."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = integers(np.array([r["v"] for r in first], dtype=np.float64).reshape(len(first), dim), scale, dim // parts)
    books = [narrowed(b) for b in np.split(start.astype(object), parts, axis=1)]
    for _ in range(rounds):
        books = refined(rows, books, scale)
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64,
             rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): one row per row with a usable vector.

    ``code`` has two hex digits for each part, ``error`` is the sum of the parts' squared distances, ``label_error`` the sum of errors over
    equal labels (null labels are alike); sums beyond a long stay at the largest long. ``codebooks_sha256`` is over all components of the final
    entries, in order of part, entry and position, joined by commas.

    Null vectors and vectors with null or non-finite components are dropped. All vectors have the length of the usable vector of smallest id (null
    ids last); vectors of another length, or all if it isn't a positive multiple of ``parts``, are returned with null code and error. Repeated rows and ids are rows
    of their own; of equal ids the lesser vector counts as smaller. Fewer than ``entries`` rows give fewer entries, an empty table an empty
    result. Other columns are ignored. Codebooks (parts x entries integers, whatever the number of rows) are all that the driver holds.
    """
    if entries > 256:
        raise ValueError("a part's code has two hex digits: 256 entries at most")
    rows = narrow(vectors, vec_id=id_col, v=vec_col, label=label_col).withColumn("v", F.col("v").cast("array<double>")).where(finite_vector(F.col("v")))
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).limit(1).collect()
    dim = least[0]["n"] if least else 0
    fits = (F.size("v") == dim) & F.lit(dim > 0 and dim % parts == 0)
    fitting = rows.where(fits)
    digest, books = None, []
    if dim and dim % parts == 0:
        books = train(fitting, dim, parts, entries, rounds, scale)
        digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()

    def encode(batches):
        for batch, entry, distance, _ in assigned(batches, books, scale):
            total = [min(int(s), LONGEST) for s in distance.astype(object).sum(1)]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "label": batch.column("label"),
                                              "code": [row.tobytes().hex() for row in entry.astype(np.uint8)], "error": pa.array(total, pa.int64())})

    label = fitting.schema["label"].dataType.simpleString()
    ident = fitting.schema["vec_id"].dataType.simpleString()
    coded = fitting.mapInArrow(encode, f"vec_id {ident}, label {label}, code string, error long") if books else fitting.select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rest = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = materialize(coded.unionByName(rest))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.when(total > LONGEST, LONGEST).otherwise(total).cast("long").alias("label_error"))
    return lookup(coded, materialize(totals), {"label": "_label"}).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
