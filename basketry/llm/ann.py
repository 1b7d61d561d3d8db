"""Approximate nearest neighbours by largest inner product: a hierarchical navigable small-world graph for each shard.

A shard's nodes are numbered from the highest level down, so that every layer holds the first so many of them, and its
links are one flat array of neighbour numbers (-1: none). Vectors get one more component that makes their norms equal; with a zero
there for queries, the largest inner product is the smallest distance. Insertion and search work on many vectors at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, narrow

BATCH = 512
EXPAND = 4  # nodes that a search step opens for each query


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, largest first."""
    k = min(k, scores.shape[1])
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k < scores.shape[1] else np.broadcast_to(np.arange(k), scores.shape)
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(scores, top, 1), axis=1, kind="stable"), 1)


def search_layer(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, inner products), ``ef`` for each query, largest first; missing ones are -1 and -inf. ``entry``: (queries, k) nodes."""
    rows = len(queries)
    ids, sc = np.full((rows, ef), -1, dtype=np.int32), np.full((rows, ef), -np.inf, dtype=np.float32)
    opened = np.zeros((rows, ef), dtype=bool)
    seen = np.zeros((rows, len(links)), dtype=np.int16)  # 1 + the column that first brought the node
    live, fresh = np.arange(rows), entry.astype(np.int32)
    while len(live):
        columns = np.arange(1, fresh.shape[1] + 1, dtype=np.int16)
        at = live[:, None]
        new = (fresh >= 0) & (seen[at, np.maximum(fresh, 0)] == 0)
        r, c = np.nonzero(new)
        seen[live[r], fresh[r, c]] = columns[c]
        new[r, c] = seen[live[r], fresh[r, c]] == columns[c]  # of equal nodes in a row one counts
        r, c = np.nonzero(new)
        value = np.full(fresh.shape, -np.inf, dtype=np.float32)
        value[r, c] = np.einsum("nd,nd->n", queries[live[r]], x[fresh[r, c]])
        all_ids, all_sc = np.hstack([ids[live], fresh]), np.hstack([sc[live], value])
        all_opened = np.hstack([opened[live], np.zeros_like(new)])
        keep = np.argpartition(-all_sc, ef - 1, axis=1)[:, :ef]
        ids[live], sc[live], opened[live] = (np.take_along_axis(a, keep, 1) for a in (all_ids, all_sc, all_opened))
        waiting = np.where(opened[live], -np.inf, sc[live])
        pick = np.argpartition(-waiting, min(EXPAND, ef) - 1, axis=1)[:, :EXPAND]
        value = np.take_along_axis(waiting, pick, 1)
        some = np.isfinite(value).any(1)
        live, pick, value = live[some], pick[some], value[some]
        opened[live[:, None], pick] = True
        nodes = np.where(np.isfinite(value), ids[live[:, None], pick], -1)
        fresh = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1).reshape(len(live), nodes.shape[1] * links.shape[1])
    order = np.argsort(-sc, axis=1, kind="stable")
    ids, sc = np.take_along_axis(ids, order, 1), np.take_along_axis(sc, order, 1)
    return np.where(np.isfinite(sc), ids, -1), sc


def select(x: np.ndarray, own: np.ndarray, cand: np.ndarray, sc: np.ndarray, m: int) -> np.ndarray:
    """At most m of each row's candidates (largest first, -1: none): those nearer to the node than to any already taken, then
    the nearest of the others."""
    out = np.full((len(cand), m), -1, dtype=np.int32)
    for at in range(0, len(cand), BATCH):
        c, s = cand[at:at + BATCH], sc[at:at + BATCH]
        real = (c >= 0) & (c != own[at:at + BATCH, None])
        v = x[np.maximum(c, 0)]
        between = v @ v.transpose(0, 2, 1)
        taken, n = np.zeros_like(real), np.zeros(len(c), dtype=np.int64)
        for i in range(c.shape[1]):
            ok = real[:, i] & (n < m) & ~((between[:, i, :] > s[:, i, None]) & taken).any(1)
            taken[:, i] = ok
            n += ok
        rank = np.where(taken, 0, np.where(real, 1, 2)) * (c.shape[1] + 1) + np.arange(c.shape[1])
        order = np.argsort(rank, axis=1, kind="stable")[:, :m]
        got = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(c, order, 1), -1)
        out[at:at + BATCH, :got.shape[1]] = got
    return out


def link_back(x: np.ndarray, links: np.ndarray, first: int, last: int) -> None:
    """The nodes that first..last-1 link to get links to them; a list that overflows is selected anew."""
    m = links.shape[1]
    source = np.repeat(np.arange(first, last, dtype=np.int32), m)
    target = links[first:last].ravel()
    source, target = source[target >= 0], target[target >= 0]
    if not len(target):
        return
    near = np.einsum("nd,nd->n", x[source], x[target])
    order = np.lexsort((-near, target))
    source, target, near = source[order], target[order], near[order]
    nodes, start, count = np.unique(target, return_index=True, return_counts=True)
    nth = np.arange(len(target)) - np.repeat(start, count)
    keep = nth < m  # a node's nearest newcomers
    come = np.full((len(nodes), m), -1, dtype=np.int32)
    come[np.repeat(np.arange(len(nodes)), count)[keep], nth[keep]] = source[keep]
    for at in range(0, len(nodes), BATCH):
        node = nodes[at:at + BATCH]
        cand = np.hstack([links[node], come[at:at + BATCH]])
        for i in range(m, 2 * m):  # a node may be in both
            cand[(cand[:, :m] == cand[:, i, None]).any(1), i] = -1
        s = np.where(cand >= 0, np.einsum("bd,bkd->bk", x[node], x[np.maximum(cand, 0)]), -np.inf).astype(np.float32)
        order = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, order, 1), np.take_along_axis(s, order, 1)
        full = (cand >= 0).sum(1) > m
        links[node] = cand[:, :m]
        if full.any():
            links[node[full]] = select(x, node[full], cand[full], s[full], m)


@dataclass
class Index:
    ids: np.ndarray  # node -> the caller's number
    x: np.ndarray  # vectors with the norm component
    layers: list[np.ndarray]  # layers[l]: (nodes of level l or higher, links)

    def descend(self, queries: np.ndarray, to: int, ef: int = 24) -> np.ndarray:
        """Entry nodes for layer ``to``, from the layers above it."""
        entry = np.tile(np.arange(min(8, len(self.x)), dtype=np.int32), (len(queries), 1))
        for layer in range(len(self.layers) - 1, to, -1):
            entry, _ = search_layer(self.x, self.layers[layer], queries, entry, ef)
        return entry

    def search(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        q = np.hstack([queries.astype(np.float32), np.zeros((len(queries), 1), np.float32)])
        got = [search_layer(self.x, self.layers[0], part, self.descend(part, 0), ef) for part in (q[at:at + BATCH] for at in range(0, len(q), BATCH))]
        return np.concatenate([a for a, _ in got]), np.concatenate([b for _, b in got])


def build(ids: np.ndarray, vectors: np.ndarray, m: int = 16, ef: int = 96, seed: int = 1) -> Index:
    """Levels are drawn by a seeded generator; each layer is filled in batches, from the top down."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / np.log(m)).astype(int), max(0, int(np.log(max(n, 1)) / np.log(m)) - 1))
    order = np.argsort(-level, kind="stable")
    level, ids = level[order], ids[order]
    x = vectors[order].astype(np.float32)
    square = np.einsum("nd,nd->n", x, x, dtype=np.float64)
    x = np.hstack([x, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0))[:, None].astype(np.float32)])
    index = Index(ids, x, [np.empty((0, 0), np.int32)] * (int(level.max(initial=0)) + 1))
    for layer in range(len(index.layers) - 1, -1, -1):
        size = int((level >= layer).sum())
        above = len(index.layers[layer + 1]) if layer + 1 < len(index.layers) else size
        links = np.full((size, m if layer else 2 * m), -1, dtype=np.int32)
        index.layers[layer] = links
        done = 0
        while done < size:
            until = min(size, done + min(BATCH, max(64, done)))
            q = x[done:until]
            beside = q @ q.T  # the batch's own nodes are candidates too
            np.fill_diagonal(beside, -np.inf)
            own = best(beside, min(m, len(q)))
            cand, sc = (own + done).astype(np.int32), np.take_along_axis(beside, own, 1)
            if done:
                entry = index.descend(q, layer) if done >= above else np.tile(np.arange(min(8, done), dtype=np.int32), (len(q), 1))
                found, near = search_layer(x, links[:done], q, entry, ef)
                cand, sc = np.hstack([cand, found]), np.hstack([sc, near])
            top = best(sc, ef)
            cand, sc = np.take_along_axis(cand, top, 1), np.take_along_axis(sc, top, 1)
            links[done:until] = -1
            chosen = select(x, np.arange(done, until, dtype=np.int32), np.where(np.isfinite(sc), cand, -1), sc, m)
            links[done:until, :chosen.shape[1]] = chosen
            link_back(x, links, done, until)
            done = until
    return index


PACKED = "dim int, shard int, n long, ids binary, first binary, members binary, x binary, exact binary, sizes binary, links binary"


def pack_index(dim: int, shard: int, index: Index, vectors: np.ndarray, members: list[np.ndarray]) -> pd.DataFrame:
    """One row for a shard; ``vectors`` are the original ones in double precision, by the numbers in ``index.ids``."""
    counts = np.array([len(members[i]) for i in index.ids], dtype=np.int64)
    return pd.DataFrame({
        "dim": [dim], "shard": [shard], "n": [len(index.x)], "ids": [index.ids.astype(np.int64).tobytes()],
        "first": [np.concatenate([[0], np.cumsum(counts)]).astype(np.int64).tobytes()],
        "members": [np.concatenate([members[i] for i in index.ids]).astype(np.int64).tobytes()],
        "x": [index.x.tobytes()], "exact": [vectors[index.ids].astype(np.float64).tobytes()], "sizes": [np.array([p for a in index.layers for p in a.shape], dtype=np.int64).tobytes()],
        "links": [b"".join(a.tobytes() for a in index.layers)]})


def unpack_index(row) -> tuple[Index, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, original vectors, each node's first member, members)."""
    sizes = np.frombuffer(row["sizes"], dtype=np.int64).reshape(-1, 2)
    flat, at, layers = np.frombuffer(row["links"], dtype=np.int32), 0, []
    for n, m in sizes:
        layers.append(flat[at:at + n * m].reshape(n, m))
        at += n * m
    x = np.frombuffer(row["x"], dtype=np.float32).reshape(int(row["n"]), -1)
    exact = np.frombuffer(row["exact"], dtype=np.float64).reshape(int(row["n"]), -1)
    return Index(np.frombuffer(row["ids"], dtype=np.int64), x, layers), exact, np.frombuffer(row["first"], dtype=np.int64), np.frombuffer(row["members"], dtype=np.int64)


def answers(shard: tuple[Index, np.ndarray, np.ndarray, np.ndarray], own: np.ndarray, q: np.ndarray, k: int, ef: int) -> Iterator[pa.RecordBatch]:
    """(query_id, vec_id, score): each query's ``k`` nearest found in an unpacked shard, but the query itself."""
    graph, exact, first, members = shard
    for at in range(0, len(q), BATCH):
        got, _ = graph.search(q[at:at + BATCH], ef)
        for lo in range(0, len(got), 64):  # the graph ranks in single precision; all that it found is scored in double
            r, c = np.nonzero(got[lo:lo + 64] >= 0)
            node = got[lo:lo + 64][r, c]
            score = np.einsum("nd,nd->n", q[at + lo + r], exact[node])
            size = first[node + 1] - first[node]
            member = members[np.repeat(first[node] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            row, score = at + lo + np.repeat(r, size), np.repeat(score, size)
            other = own[row] != member
            row, member, score = row[other], member[other], score[other]
            order = np.lexsort((member, -score, row))
            row = row[order]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            order, row = order[nth < k], row[nth < k]
            yield pa.RecordBatch.from_pydict({"query_id": own[row], "vec_id": member[order], "score": score[order]})


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) without null ids and without vectors that are null, empty, zero or hold null or non-finite components."""
    v = F.transform(f"`{vec_col}`", lambda c: c.cast("double"))
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return out.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda c: c != 0))


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = 20,
               shard_rows: int = 8192, query_block: int = 131_072, ef: int = 320, m: int = 16, build_ef: int = 96, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each vector whose id is divisible by ``every``.

    Nearest is the largest inner product, computed in double precision on the original vectors; ties go to the smaller id. All rows but those
    with the query's own id are candidates, vectors of another length apart. Null ids and unusable vectors (null, empty, zero, null or non-finite components) take no part. Repeated
    rows count once; of several vectors with one id a pair's best score counts. Fewer candidates give fewer rows, an empty table none; other columns are ignored.

    Equal vectors are one node, with their k + 1 smallest ids: no other of them can be among the k nearest of any query.
    """
    rows = materialize(usable(narrow(vectors, vec_id=id_col, embedding=vec_col), "vec_id", "embedding").distinct())
    # the window's limit is applied before the shuffle too, so a vector with many copies sends k + 1 rows from each task at most
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = materialize(rows.withColumn("_nth", nth).where(F.col("_nth") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("members")))
    n = nodes.count()
    shards = max(1, -(-n // shard_rows))
    dealt = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "v", "members")

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[np.argsort([a[0] for a in frame["members"]], kind="stable")]
        x = np.stack(frame["v"].to_numpy()).astype(np.float64)
        return pack_index(int(frame["dim"].iloc[0]), int(frame["shard"].iloc[0]), build(np.arange(len(x)), x, m, build_ef, seed), x, [np.asarray(a) for a in frame["members"]])

    index = materialize(dealt.groupBy("dim", "shard").applyInPandas(make, PACKED))
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // query_block))
    # every block of queries meets every shard: the shard's row comes first, then the block's queries stream past it
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(False))
    asked = asked.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "v").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("query", F.lit(True))
    key = ["dim", "shard", "block"]
    line = index.unionByName(asked, allowMissingColumns=True).repartition(*key).sortWithinPartitions(*key, "query")

    def find(batches):
        held, state = None, None
        for batch in batches:
            query = batch.column("query").to_pylist()
            keys = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
            at = 0
            while at < len(query):
                to = at + 1
                if not query[at]:
                    held, state = keys[at], unpack_index({c: batch.column(c)[at].as_py() for c in ("n", "ids", "first", "members", "x", "exact", "sizes", "links")})
                else:
                    while to < len(query) and query[to] and keys[to] == keys[at]:
                        to += 1
                    if keys[at] == held:  # a shard may hold no vector of that length
                        part = batch.slice(at, to - at)
                        yield from answers(state, part.column("vec_id").to_numpy(), part.column("v").flatten().to_numpy().reshape(to - at, -1), k, ef)
                at = to

    found = line.mapInArrow(find, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
