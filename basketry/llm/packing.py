"""Packing token sequences: shortest-pack-first over the length histogram.

Only lengths are planned. Every document is tokenized and cut once; the histogram of piece lengths (at most ``capacity``
numbers) is packed on the driver, longest lengths first, by updating counts of packing patterns; the patterns are
then joined back to the pieces by each piece's rank among those of its length.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_texts, materialize, narrow, running

# Texts split at single spaces are looked up whole; both caches start anew at this many entries.
CACHE = 600_000
CLOSING = frozenset(".,;:!?")


class Cache(dict):
    """Results of ``make``; starts anew at CACHE entries."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if len(self) >= CACHE:
            self.clear()
        if len(key) < 200:
            self[key] = got
        return got


class TokenBytes:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Equal words are tokenized once per worker: a text without repeated spaces falls apart at its spaces into parts
    whose ids simply follow one another; any other text is split by the pattern as a whole. ``document`` gives the tokenizer's
    ids of a whole text, ``encode`` those of a text that stands between added tokens.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # the byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.alphabet = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.words = Cache(self.word)
        self.parts = Cache(self.part)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i.to_bytes(4, "little") for i, t in added.items()}
        # tokens that look at what stands around them are left to the tokenizer
        self.plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())
        self.marker = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def word(self, word: str) -> bytes:
        """Ids of what the pattern matches as one."""
        mapped = word.encode().decode("latin-1").translate(self.alphabet)
        return struct.pack(f"<{len(ids)}I", *ids) if len(ids := [t.id for t in self.tokenizer.model.tokenize(mapped)]) != 1 else ids[0].to_bytes(4, "little")

    def part(self, part: str) -> bytes:
        """Ids of a space and what stands between it and the next; letters, with or without a mark after them, need no pattern."""
        if part.isalpha():
            return self.word(" " + part)
        if part[-1:] in CLOSING and part[:-1].isalpha():
            return self.parts[part[:-1]] + self.words[part[-1]]
        return self.split(" " + part)

    def split(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        if "  " in text:
            return self.split(text)
        first, space, rest = text.partition(" ")
        out = self.split(first)
        return out + b"".join(map(self.parts.__getitem__, rest.split(" "))) if space else out

    def document(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.added)):
            return self.encode(text)
        if not self.plain:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(self.added[part] if i % 2 else self.encode(part) for i, part in enumerate(self.marker.split(text)))


_LOADED: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    if path not in _LOADED:
        _LOADED[path] = TokenBytes(path)
    return _LOADED[path]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
           tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and ``end_id``, cut after every ``capacity`` ids."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def fn(batch, texts):
        coder = token_bytes(public_tokenizers.path(tokenizer))
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            ids = memoryview(coder.document(raw.decode()) + end)
            n = len(ids) // 4
            for start in range(0, n, capacity):
                part = ids[4 * start:4 * (start + capacity)]
                for name, v in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                    out[name].append(v)
        return {k: pa.array(v, type=pa.int64()) for k, v in out.items()}

    return map_texts(narrow(docs, doc_id=id_col, text=text_col), "text",
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", fn)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) patterns that use each length exactly as often as the histogram holds it.

    Longest lengths first; each goes to the patterns with the most space left, as many copies at once as keep those ahead of the
    next emptiest. What fits nowhere opens new packs, filled with as many copies as they hold.
    """
    open_: dict[int, list] = {}  # space left -> [(count, (lengths so far as a linked list))]
    spaces: list[int] = []  # negative spaces, a heap without repeats
    done: list[tuple[int, tuple]] = []

    def put(space: int, count: int, chain: tuple) -> None:
        if space == 0:
            done.append((count, chain))
        else:
            if space not in open_:
                open_[space] = []
                heapq.heappush(spaces, -space)
            open_[space].append((count, chain))

    def add(chain: tuple, length: int, copies: int) -> tuple:
        for _ in range(copies):
            chain = (length, chain)
        return chain

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            space = -spaces[0] if spaces else 0
            if space >= length:
                count, chain = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    heapq.heappop(spaces)
                following = -spaces[0] if spaces else 0
                copies = max(1, min((space - following) // length, n // count, space // length))
                used = min(count, n)
                if used < count:
                    put(space, count - used, chain)
                put(space - copies * length, used, add(chain, length, copies))
                n -= used * copies
            else:
                copies = min(capacity // length, n)
                count = n // copies
                put(capacity - copies * length, count, add((), length, copies))
                n -= count * copies
    done += [x for group in open_.values() for x in group]
    out = []
    for count, chain in done:
        lengths = []
        while chain:
            length, chain = chain
            lengths.append(length)
        out.append((count, lengths[::-1]))
    return out


class Slots:
    """For each length, ranges of ranks with the first sequence and the offset they go to."""

    def __init__(self, patterns: Iterable[tuple[int, list[int]]]):
        used: dict[int, int] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for count, lengths in patterns:
            offset = 0
            for length in lengths:
                rank = used.get(length, 0)
                rows.setdefault(length, []).append((rank, first, offset))
                used[length] = rank + count
                offset += length
            first += count
        self.of = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for k in np.unique(length):
            at = np.flatnonzero(length == k)
            ranks, firsts, offsets = self.of[int(k)]
            slot = np.searchsorted(ranks, rank[at], side="right") - 1
            sequence[at], offset[at] = firsts[slot] + rank[at] - ranks[slot], offsets[slot]
        return sequence, offset


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         tokenizer: str = "byte_bpe_50k.json", seed: int = 10) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the end id alone. Rows are packed one by one: repeated rows and ids
    each get places of their own, a null doc_id stays null, ties in the rank go by doc_id, start and crc, and rows alike in all of
    these are interchangeable. An empty table gives no pieces; other columns are ignored.

    The driver gets at most ``capacity`` counts; the patterns it sends back depend on the lengths, not on the number of rows.
    """
    cut = materialize(pieces(docs, id_col, text_col, capacity, tokenizer).withColumn(
        "_key", F.xxhash64(F.col("doc_id"), F.col("start"), F.col("ids_crc32"), F.lit(seed))))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = Slots(shortest_pack_first(histogram, capacity))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = running(cut, ["length"], "_key", ["doc_id", "start", "ids_crc32", "doc_tokens"], rank="_rank").select(*names, "_rank")

    def place(batches):
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
