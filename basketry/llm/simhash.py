"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank and cut into blocks. Inside a block, runs of neighbouring codes
are folded bottom-up into nodes that hold the bits on which all their codes agree (a masked pattern);
a child keeps only the bits that its ancestors don't fix. A search goes down with the differences
added up so far, and leaves a whole group as soon as they exceed the radius. The same tree over the blocks' own patterns
tells which blocks a code must visit.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, materialize, narrow
from .graph import components

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
ROUTED = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("own_part", pa.int64()), ("home", pa.bool_()), ("codes", pa.binary())])
FANOUT = 8


def fingerprint(raw: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of one UTF-8 text: A-Z lower-cased, ASCII white space between words, shingles with repeats."""
    w = raw.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), seed)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    h = np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(seed))), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(h)).astype(np.uint8), bitorder="little").view("<u8")[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def gray_rank_column(name: str) -> Column:
    """The same position as a signed long that sorts alike."""
    r = F.col(name)
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


class GrayTree:
    """Levels of (pattern, own mask), root first; the last level holds the leaves as given."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray, fanout: int = FANOUT):
        self.fanout = fanout
        levels = [(patterns, masks)]
        while len(levels[-1][0]) > fanout:
            p, m = levels[-1]
            cuts = np.arange(0, len(p), fanout)
            low, high = np.bitwise_and.reduceat(p, cuts), np.bitwise_or.reduceat(p, cuts)
            agreed = np.bitwise_and.reduceat(m, cuts) & ~(low ^ high)
            levels.append((low & agreed, agreed))
        self.levels = []
        for i, (p, m) in enumerate(levels):
            above = levels[i + 1][1][np.arange(len(p)) // fanout] if i + 1 < len(levels) else np.uint64(0)
            self.levels.append((p, m & ~above))
        self.levels.reverse()

    def search(self, codes: np.ndarray, radius: int, step: int = 4096):
        """Yields (index of code, index of leaf) arrays with at most ``radius`` differences."""
        for at in range(0, len(codes), step):
            part = codes[at:at + step]
            n = len(self.levels[0][0])
            q, node = np.repeat(np.arange(len(part)), n), np.tile(np.arange(n), len(part))
            acc = np.zeros(len(q), dtype=np.uint8)
            for depth, (pattern, own) in enumerate(self.levels):
                if depth:
                    q, acc = np.repeat(q, self.fanout), np.repeat(acc, self.fanout)
                    node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                    real = node < len(pattern)
                    q, node, acc = q[real], node[real], acc[real]
                acc = acc + np.bitwise_count((part[q] ^ pattern[node]) & own[node])
                near = acc <= radius
                q, node, acc = q[near], node[near], acc[near]
            yield q + at, node


class Blocks:
    """Ranges of Gray ranks, with the pattern of leading bits that each range fixes."""

    def __init__(self, bounds: list[int], group: int):
        self.group = group
        self.bounds = np.array(bounds, dtype=np.uint64)  # first rank of each block but the first
        low = np.concatenate([np.zeros(1, np.uint64), self.bounds])
        high = np.concatenate([self.bounds - np.uint64(1), [ONES]])
        fixed = [64 - int(a ^ b).bit_length() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        self.mask = np.array([(~0 << (64 - k)) & int(ONES) for k in fixed], dtype=np.uint64)
        self.pattern = (low ^ (low >> np.uint64(1))) & self.mask
        self.tree = GrayTree(self.pattern, self.mask)

    def of(self, codes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, gray_rank(codes), side="right")

    def route(self, codes: np.ndarray, radius: int):
        """(block, part, home, codes): where codes are kept, and where they ask. Of two blocks only the one with the larger number visits."""
        home = self.of(codes)
        for b in np.unique(home):
            common = self.mask & self.mask[b]
            able = np.flatnonzero(np.bitwise_count((self.pattern ^ self.pattern[b]) & common) <= radius)
            mine = codes[home == b]
            for part in np.unique(able[able >= b] // self.group):
                yield b, part, True, mine
        for q, b in self.tree.search(codes, radius, len(codes)):
            ask = b < home[q]
            q, b = q[ask], b[ask]
            part = home[q] // self.group
            order = np.lexsort((part, b))
            cuts = np.flatnonzero((np.diff(b[order]) != 0) | (np.diff(part[order]) != 0)) + 1
            for run in np.split(order, cuts):
                if len(run):
                    yield b[run[0]], part[run[0]], False, codes[q[run]]


def roundest(low: int, high: int) -> int:
    """The number in (low, high] with the most trailing zeros."""
    if low >= high:
        return high
    return high & ~((1 << ((low ^ high).bit_length() - 1)) - 1)


def local_links(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Star links (code, smallest code of its local component) among one block's codes and its visitors."""
    own, guests = (np.frombuffer(b"".join(frame["codes"][frame["home"] == home]), dtype="<u8") for home in (True, False))
    own = own[np.argsort(gray_rank(own), kind="stable")]
    asking = np.concatenate([own, guests]) if frame["part"].iloc[0] == frame["own_part"].iloc[0] else guests
    if not len(own) or not len(asking):
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    tree = GrayTree(own, np.full(len(own), ONES))
    nodes = np.unique(np.concatenate([own, guests]).view(np.int64))
    label = np.arange(len(nodes))
    for q, leaf in tree.search(asking, radius):
        a, b = np.searchsorted(nodes, asking[q].view(np.int64)), np.searchsorted(nodes, own[leaf].view(np.int64))
        real = a != b
        a, b = a[real], b[real]
        while len(a):  # hook the larger root under the smaller, then shorten all paths
            ra, rb = label[a], label[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(short := label[label], label):
                label = short
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[tied], "b": nodes[label[tied]]})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, row: Column | None = None) -> DataFrame:
    """(doc_id, row, fp long): one row per row of ``docs``. ``row``: a long that tells rows with the same id apart."""

    def fn(batch, texts):
        fp = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64)
        return {"doc_id": batch.column("doc_id"), "row": batch.column("row"), "fp": pa.array(fp)}

    named = docs.withColumn("_row", F.lit(0).cast("long") if row is None else row)
    return map_texts(narrow(named, doc_id=id_col, row="_row", text=text_col), "text", "doc_id long, row long, fp long", fn)


def link_codes(codes: DataFrame, radius: int = 2, block_codes: int = 16384, group: int = 4) -> DataFrame:
    """Star links (a, b) that tie all codes of ``codes`` (fp long, distinct) within ``radius`` bits, directly or through others."""
    codes = codes.withColumn("rank", gray_rank_column("fp"))
    n = codes.count()
    blocks = max(1, -(-n // block_codes))
    bounds: list[int] = []
    if blocks > 1:
        # quarter-block quantiles of the Gray ranks (4 * blocks numbers reach the driver); each cut
        # is then moved to the roundest rank near it, so that a block fixes as many leading bits as it can
        at = [i / (4 * blocks) for i in range(1, 4 * blocks)]
        got = codes.agg(F.percentile_approx("rank", at, max(10_000, 40 * blocks)).alias("q")).first()["q"]
        q = [(v + (1 << 63)) for v in got]
        bounds = sorted({roundest(q[4 * i - 2], q[4 * i]) for i in range(1, blocks)} - {0})
    grid = Blocks(bounds, group)

    def route(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            rows = [(int(b), int(part), int(b) // group, home, own.astype("<u8").tobytes()) for b, part, home, own in grid.route(fps, radius)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), ROUTED.types, strict=True)], schema=ROUTED)

    # sorted by Gray rank, the codes of a batch share blocks, and travel as few packed lists
    routed = codes.repartitionByRange("rank").sortWithinPartitions("rank").select("fp").mapInArrow(
        route, "block long, part long, own_part long, home boolean, codes binary")
    return routed.groupBy("block", "part").applyInPandas(lambda f: local_links(f, radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    radius: int = 2, block_codes: int = 16384) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest doc_id
    reachable. Texts without words (null, empty, white space) have fingerprint zero and link like any other. Rows
    with the same doc_id are kept and get the result of their own text; a null doc_id stays null and never is a component_id
    (a component of null ids alone has null). An empty table gives an empty result; other columns are ignored.

    Equal fingerprints are folded before the search, blocks and their visitors are bounded by
    ``block_codes``, and only star links leave a block, so no group of copies is ever paired out.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, words))
    return classes(marked, radius, block_codes).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def classes(marked: DataFrame, radius: int, block_codes: int) -> DataFrame:
    """Adds ``first`` (null_id, doc_id, row) to (doc_id, row, fp): the smallest row of the component, null ids last."""
    own = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row")
    codes = materialize(marked.groupBy("fp").agg(F.min(own).alias("first")))
    nodes = components(link_codes(codes.select("fp"), radius, block_codes))
    tied = materialize(codes.join(nodes.withColumnRenamed("node", "fp"), "fp"))
    smallest = materialize(tied.groupBy("root").agg(F.min("first").alias("of_class")))
    linked = materialize(tied.select("fp", "root").join(smallest, "root").select("fp", "of_class"))
    of_code = materialize(codes.join(linked, "fp", "left").select("fp", F.coalesce("of_class", "first").alias("first")))
    return marked.join(of_code, "fp")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
                    block_codes: int = 16384) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest doc_id (null ids last), of rows with that id the one with the smallest row hash.

    Rows that are alike in every column count as one. Null, empty and white-space texts are one component; very long texts are hashed whole; an
    empty table gives an empty result. Columns may have any name and type: the row travels as one value.
    """
    # maps and variants have no hash of their own
    hashed = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if any(k in f.dataType.simpleString() for k in ("map<", "variant")) else F.col(f"`{f.name}`")
              for f in docs.schema.fields]
    rows = docs.select(F.xxhash64(*hashed).alias("row_hash"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    marked = materialize(fingerprints(rows, "doc_id", "text", words, F.col("row_hash")))
    first = classes(marked, radius, block_codes).where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row")))
    key = lambda c: F.coalesce(c, F.lit(-1))
    kept = first.select(key(F.col("doc_id")).alias("key"), F.col("row").alias("row_hash")).distinct()
    found = rows.select(key(F.col("doc_id")).alias("key"), "row_hash", "row").join(kept, ["key", "row_hash"])
    nth = F.row_number().over(Window.partitionBy("key", "row_hash").orderBy(F.lit(0)))
    return found.withColumn("nth", nth).where("nth = 1").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
