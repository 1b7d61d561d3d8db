"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

Equal roots mean equal texts. Equal sections are settled by their digests alone; only the leaves of sections that differ are
compared for the likeness of two fingerprints. Edits are located from the root down, through the branches that differ.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import narrow, raw_texts, slices

# A leaf is a sentence with what closes it; without a closing mark it ends with the first word after 160 bytes. A leaf that holds a line
# end closes its paragraph. Leaves laid end to end are the text.
LEAF = re.compile(rb"[^.!?\n]{1,160}[^.!?\s]*[.!?\s]*|[.!?\s]+")
# A section ends at an empty line, or after a paragraph whose digest says so (one in eight), wherever it stands.
SECTION = 8


def digest(parts: bytes) -> bytes:
    return hashlib.blake2b(parts, digest_size=16).digest()


@dataclass
class Node:
    """A section, a paragraph or (without parts) a leaf."""
    digest: bytes
    size: int  # bytes of text
    parts: Sequence[Node] = ()


@dataclass
class Tree:
    root: bytes
    sections: list[Node]

    def fingerprint(self) -> str:
        """Root; then for each section the first half of its digest and its paragraphs' leaves, a quarter of each digest."""
        return self.root.hex() + ":" + ";".join(
            s.digest[:8].hex() + "=" + ",".join("".join(leaf.digest[:4].hex() for leaf in p.parts) for p in s.parts) for s in self.sections)


def above(parts: list[Node]) -> Node:
    return Node(digest(b"".join(p.digest for p in parts)), sum(p.size for p in parts), parts)


def tree(raw: bytes) -> Tree:
    sections, paragraphs, leaves = [], [], []

    def close(force: bool) -> None:
        nonlocal paragraphs, leaves
        if leaves:
            paragraphs.append(above(leaves))
            force = force or paragraphs[-1].digest[0] % SECTION == 0
            leaves = []
        if force and paragraphs:
            sections.append(above(paragraphs))
            paragraphs = []

    for leaf in LEAF.findall(raw):
        leaves.append(Node(digest(leaf), len(leaf)))
        if b"\n" in leaf:
            close(leaf.count(b"\n") > 1)
    close(True)
    return Tree(digest(b"".join(s.digest for s in sections)), sections)


def parse(fingerprint: str) -> tuple[str, list[tuple[str, list[str]]]]:
    """(root, [(section, leaves)])."""
    root, _, rest = fingerprint.partition(":")
    out = []
    for part in filter(None, rest.split(";")):
        name, _, leaves = part.partition("=")
        flat = leaves.replace(",", "")
        out.append((name, [flat[i:i + 8] for i in range(0, len(flat), 8)]))
    return root, out


def likeness(a: str, b: str) -> float:
    """Share of leaves in common (twice the common ones over all), from two fingerprints: 1 for equal roots."""
    (root_a, sections_a), (root_b, sections_b) = parse(a), parse(b)
    return _likeness(root_a, sections_a, root_b, sections_b)


def _likeness(root_a, sections_a, root_b, sections_b) -> float:
    if root_a == root_b:
        return 1.0
    n = sum(len(x) for _, x in sections_a) + sum(len(x) for _, x in sections_b)
    shared = Counter(d for d, _ in sections_a) & Counter(d for d, _ in sections_b)
    common, rest = 0, []
    for sections in (sections_a, sections_b):
        left, open_ = shared.copy(), Counter()
        for d, leaves in sections:
            if left[d] > 0:  # an equal branch: nothing below it is looked at
                left[d] -= 1
                common += len(leaves)
            else:
                open_.update(leaves)
        rest.append(open_)
    return (common + 2 * sum((rest[0] & rest[1]).values())) / n if n else 0.0


def tree_likeness(a: Tree, b: Tree) -> float:
    """The same from two trees."""
    flat = lambda t: [(s.digest[:8], [leaf.digest[:4] for p in s.parts for leaf in p.parts]) for s in t.sections]
    return _likeness(a.root, flat(a), b.root, flat(b))


def anchors(a: Sequence[Node], b: Sequence[Node]) -> list[tuple[int, int]]:
    """Pairs of equal nodes in the order of both lists: the common ends, and between them the longest rising line of nodes that occur once in each."""
    short, head, tail = min(len(a), len(b)), 0, 0
    while head < short and a[head].digest == b[head].digest:
        head += 1
    while tail < short - head and a[-1 - tail].digest == b[-1 - tail].digest:
        tail += 1
    once_a, once_b = (Counter(n.digest for n in x[head:len(x) - tail]) for x in (a, b))
    place = {b[j].digest: j for j in range(head, len(b) - tail)}
    lowest, rows, back = [], [], {}  # the least last place of a rising line of each length, its row, and the row before each row
    for i in range(head, len(a) - tail):
        if once_a[a[i].digest] == 1 == once_b[a[i].digest]:
            at = bisect_left(lowest, place[a[i].digest])
            lowest[at:at + 1], rows[at:at + 1] = [place[a[i].digest]], [i]
            back[i] = rows[at - 1] if at else None
    middle, i = [], rows[-1] if rows else None
    while i is not None:
        middle.append((i, place[a[i].digest]))
        i = back[i]
    return [(i, i) for i in range(head)] + middle[::-1] + [(len(a) - n, len(b) - n) for n in range(tail, 0, -1)]


def differing(a: Sequence[Node], b: Sequence[Node], at: int = 0, to: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """Byte spans (start, end in a, start, end in b) of the leaves that differ, in order. Between equal branches the parts of those that
    differ are compared, down to the leaves; equal branches are not opened."""
    i = j = 0
    for x, y in [*anchors(a, b), (len(a), len(b))]:
        left, right = a[i:x], b[j:y]
        end, until = at + sum(n.size for n in left), to + sum(n.size for n in right)
        if any(n.parts for n in (*left, *right)):
            yield from differing([p for n in left for p in n.parts], [p for n in right for p in n.parts], at, to)
        elif left or right:
            yield at, end, to, until
        if x < len(a):
            end, until = end + a[x].size, until + b[y].size
        at, to, i, j = end, until, x + 1, y + 1


def edits(a: Tree, b: Tree) -> list[tuple[int, int, int, int]]:
    """Where a's text must be replaced by which bytes of b's to become b's; spans that touch are one, equal texts have none."""
    out = []
    for span in differing(a.sections, b.sections) if a.root != b.root else ():
        if out and out[-1][1] == span[0] and out[-1][3] == span[2]:
            span = (out[-1][0], span[1], out.pop()[2], span[3])
        out.append(span)
    return out


def edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_a_ring(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(bucket, guest, doc_id, text): rows dealt to ranges of ids, in order of descending id within each bucket, null ids last.

    After the last row of a bucket comes, as a guest, the first row of the next bucket (of the first bucket after the last): a row's
    follower always stands below it. Only these first rows travel twice.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumns({"_down": F.bitwise_not("doc_id"), "_null": F.col("doc_id").isNull(), "_mark": F.xxhash64("text")})
    # ranges with about the same number of rows; a null id counts as the lowest
    rows = rows.withColumn("_at", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e19)))
    # several ranges a task, so that tasks come out alike although ranges are dealt to them by hash
    ranges = 8 * parts if parts > 1 else 1
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("_at", shares, max(10_000, 10 * ranges)).alias("q")).first()["q"] if shares else None
    cuts = sorted({c for c in found or []})
    if cuts:
        rows = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_at", outputCol="_bucket", handleInvalid="keep").transform(rows)
        rows = rows.withColumn("bucket", -F.col("_bucket").cast("int"))
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    key = F.struct("_null", "_down", "_mark")
    ring = Window.orderBy("bucket")
    # one row for each bucket
    first = rows.groupBy("bucket").agg(F.min(key).alias("_first")).withColumn(
        "_host", F.coalesce(F.lag("bucket").over(ring), F.max("bucket").over(Window.partitionBy(F.lit(0)))))
    dealt = rows.join(F.broadcast(first), "bucket")
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("_to", F.explode(F.when(key == F.col("_first"), F.array(own, guest)).otherwise(F.array(own))))
    order = ["_null", "_down", "_mark"]
    return dealt.select("_to.bucket", "_to.guest", "doc_id", "text", *order).repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "guest", *order).select("bucket", "guest", "doc_id", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edits): one row per row of ``docs``.

    edits: ``start:end>start:end`` for each place where the edited text differs, comma-joined; bytes of the text, then of the edited text.

    The order of documents is descending doc_id, null ids last, rows with one id by a hash of the text; the last row is followed by
    the first, a single row by itself. A null text is empty: its tree has no leaves, it equals other empty texts (likeness 1) and no others (0).
    Repeated rows follow one another. An empty table gives an empty result; other columns are ignored.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edits string"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]

    def result(doc_id, text: str, own: Tree, after_text: str, after: Tree) -> tuple:
        raw = edit(text, after_text).encode()
        edited = tree(raw)
        return (doc_id, len(text), hashlib.sha256(raw).hexdigest(), own.fingerprint(), edited.fingerprint(),
                tree_likeness(own, edited), tree_likeness(own, after), ",".join(f"{i}:{j}>{x}:{y}" for i, j, x, y in edits(own, edited)))

    def rows_of(batch) -> Iterator[tuple]:
        return zip(batch.column("bucket").to_pylist(), batch.column("guest").to_pylist(), batch.column("doc_id").to_pylist(),
                   raw_texts(batch.column("text")), strict=True)

    def run(batches):
        before = None  # the row that waits for its follower
        for batch in slices(batches, "text"):
            out = []
            for bucket, guest, doc_id, raw in rows_of(batch):
                if before and before[0] == bucket or not guest:
                    text, own = raw.decode(), tree(raw)
                    if before and before[0] == bucket:
                        out.append(result(*before[1:], text, own))
                    before = None if guest else (bucket, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return in_a_ring(docs, id_col, text_col, parts).mapInArrow(run, schema)
