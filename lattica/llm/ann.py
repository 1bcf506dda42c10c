"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, shard results merged.

Rows are dealt to shards by a hash of their id, so that copies of one vector spread evenly; inside a shard a graph node is a
distinct vector and holds the sorted ids that have it. A graph is stored as flat arrays in one row per shard: vectors, ids,
levels, and neighbours of fixed width (-1 ends a list). Queries come in blocks, and each block is searched in every shard;
the candidates that the graph finds are measured again in double precision on the original vectors, and the k nearest of all
shards stay. Building and searching are deterministic (levels and order come from the ids).

Defined results: a vector that is null, empty or zero, or that holds a null or non-finite component, takes no part, nor does a
row without an id; only vectors of one length are compared; repeated rows count once, and an id with several vectors counts
with the nearest; ties go to the smaller id; an empty table gives an empty result. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.llm.common import checkpoint, small_batches
from lattica.llm.textkernel import mix

#: Neighbours per node above the bottom layer (twice as many there), and candidates kept while building and searching.
M, EF_BUILD, EF_SEARCH = 16, 56, 120
#: Least number of shards, and rows that a shard is meant to hold at most.
SHARDS, SHARD_ROWS = 12, 5_000
QUERY_BLOCK = 10_000

INDEX = "dim int, shard int, kind string, vectors binary, id_ends binary, ids binary, levels binary, base binary, upper binary"


class Graph:
    """vectors: (n, d), distinct. levels: top layer of each node. base: (n, 2M) neighbours; upper: (sum of levels, M), the
    rows of a node's layers 1, 2, ... one after another."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, base: np.ndarray | None = None, upper: np.ndarray | None = None):
        largest = float(np.abs(vectors).max()) if vectors.size else 1.0
        self.largest = np.float64(largest)
        self.v = vectors.astype(np.float64) / self.largest  # double precision, so that one huge vector leaves the others their squares
        self.norm = np.einsum("ij,ij->i", self.v, self.v)
        self.levels = levels
        self.first = np.cumsum(levels) - levels
        n = len(vectors)
        self.base = np.full((n, 2 * M), -1, np.int32) if base is None else base
        self.upper = np.full((int(levels.sum()), M), -1, np.int32) if upper is None else upper
        self.entry = int(np.argmax(levels)) if n else -1
        if base is None:
            self._build()

    def _row(self, node: int, layer: int) -> np.ndarray:
        return self.base[node] if layer == 0 else self.upper[self.first[node] + layer - 1]

    def _near(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.norm[nodes] - 2 * (self.v[nodes] @ q)

    def search_layer(self, q: np.ndarray, entries: list[tuple[float, int]], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ef nearest found, nearest first; distances are squared, less the query's norm."""
        seen = np.zeros(len(self.v), bool)
        seen[[x for _, x in entries]] = True
        ahead, kept = [], []
        for d, x in entries:
            heappush(ahead, (d, x))
            heappush(kept, (-d, x))
        while ahead:
            d, x = heappop(ahead)
            if len(kept) >= ef and d > -kept[0][0]:
                break
            nodes = self._row(x, layer)
            nodes = nodes[nodes >= 0]
            nodes = nodes[~seen[nodes]]
            if not len(nodes):
                continue
            seen[nodes] = True
            for d, y in zip(self._near(q, nodes).tolist(), nodes.tolist(), strict=True):
                if len(kept) < ef:
                    heappush(ahead, (d, y))
                    heappush(kept, (-d, y))
                elif d < -kept[0][0]:
                    heappush(ahead, (d, y))
                    heappop(kept)
                    heappush(kept, (-d, y))
        return sorted((-d, x) for d, x in kept)

    def _select(self, q: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in different directions: nearest first, each nearer to q than to those chosen; then the nearest of
        the rest."""
        d = self._near(q, nodes)
        order = np.argsort(d, kind="stable")
        nodes, d = nodes[order], d[order]
        between = self.norm[nodes][:, None] - 2 * (self.v[nodes] @ self.v[nodes].T)
        free, chosen = np.ones(len(nodes), bool), []
        for i in range(len(nodes)):
            if free[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                # squared distances to node i against those to q, both less the candidate-independent norm
                free &= between[:, i] + self.norm[nodes[i]] > d + float(q @ q)
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(nodes)), chosen)[: most - len(chosen)]
            chosen = [*chosen, *rest.tolist()]
        return nodes[chosen]

    def _build(self) -> None:
        entry, top = -1, -1
        for x in range(len(self.v)):
            level, q = int(self.levels[x]), self.v[x]
            if entry >= 0:
                found = [(float(self._near(q, np.array([entry]))[0]), entry)]
                for layer in range(top, level, -1):
                    found = self.search_layer(q, found[:1], 1, layer)
                for layer in range(min(level, top), -1, -1):
                    found = self.search_layer(q, found, EF_BUILD, layer)
                    near = self._select(q, np.array([y for _, y in found], np.int64), M)
                    self._row(x, layer)[: len(near)] = near
                    for y in near.tolist():
                        row = self._row(y, layer)
                        free = np.flatnonzero(row < 0)
                        if len(free):
                            row[free[0]] = x
                        else:  # full: leave room, so that this is seldom done
                            keep = self._select(self.v[y], np.append(row, x).astype(np.int64), max(M // 2, len(row) * 3 // 4))
                            row[:] = -1
                            row[: len(keep)] = keep
            if level > top:
                entry, top = x, level
        self.entry = entry

    def search(self, query: np.ndarray, ef: int) -> np.ndarray:
        if self.entry < 0:
            return np.zeros(0, np.int64)
        q = query.astype(np.float64) / self.largest
        found = [(float(self._near(q, np.array([self.entry]))[0]), self.entry)]
        for layer in range(int(self.levels[self.entry]), 0, -1):
            found = self.search_layer(q, found[:1], 1, layer)
        return np.array([x for _, x in self.search_layer(q, found, ef, 0)], np.int64)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _build_shard(rows: pa.Table) -> pa.Table:
    dim, shard = rows.column("dim")[0].as_py(), rows.column("shard")[0].as_py()
    vectors, ids = _matrix(rows.column("vector"), dim) + 0.0, rows.column("id").to_numpy()  # + 0.0: -0.0 is 0.0
    order = np.argsort(ids, kind="stable")
    vectors, ids = np.ascontiguousarray(vectors[order]), ids[order]
    known: dict[bytes, list[int]] = {}
    for raw, x in zip(map(bytes, vectors.view(np.uint8).reshape(len(ids), -1)), ids.tolist(), strict=True):
        held = known.setdefault(raw, [])
        if not held or held[-1] != x:
            held.append(x)
    distinct = np.frombuffer(b"".join(known), vectors.dtype).reshape(-1, dim)
    first = np.array([x[0] for x in known.values()], np.int64)
    u = ((mix(first.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    levels = np.floor(-np.log(u) / np.log(M)).astype(np.int32)
    graph = Graph(distinct, levels)
    ends = np.cumsum([len(x) for x in known.values()]).astype(np.int64)
    flat = np.array([y for x in known.values() for y in x], np.int64)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "kind": [str(distinct.dtype)],
        **{k: pa.array([x.tobytes()], pa.binary()) for k, x in (("vectors", distinct), ("id_ends", ends), ("ids", flat), ("levels", levels), ("base", graph.base), ("upper", graph.upper))},
    })


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shard of a partition, one graph per vector length."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    dims = rows.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield from _build_shard(rows.filter(pa.array(dims == dim))).to_batches()


def _search_shard(key: tuple, index: pa.Table, queries: pa.Table, k: int, ef: int) -> pa.Table:
    out: tuple[list, list, list] = ([], [], [])
    if index.num_rows and queries.num_rows:
        dim = queries.column("length")[0].as_py()
        part = lambda name, kind: np.frombuffer(index.column(name)[0].as_buffer(), kind)
        vectors = part("vectors", index.column("kind")[0].as_py()).reshape(-1, dim)
        ends, ids = part("id_ends", np.int64), part("ids", np.int64)
        graph = Graph(vectors, part("levels", np.int32), part("base", np.int32).reshape(-1, 2 * M), part("upper", np.int32).reshape(-1, M))
        for q, x in zip(_matrix(queries.column("vector"), dim), queries.column("id").to_pylist(), strict=True):
            found = graph.search(q, max(ef, 2 * k))
            score = np.sqrt(((vectors[found].astype(np.float64) - q.astype(np.float64)) ** 2).sum(axis=1))
            hits = []
            for node, s in sorted(zip(found.tolist(), score.tolist(), strict=True), key=lambda t: t[1]):
                if len(hits) >= k and s > hits[k - 1][0]:
                    break
                own = ids[(ends[node - 1] if node else 0) : ends[node]]
                hits += [(s, y) for y in own[: k + 1].tolist() if y != x]  # a node's further ids can't be among the k nearest
                hits.sort()
            for s, y in hits[:k]:
                out[0].append(x)
                out[1].append(y)
                out[2].append(s)
    return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})


def usable(vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(good(x), F.lit(False))) & F.exists(vector, lambda x: x != 0)


def _rows(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    return rows.where(F.col("id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False))).withColumn("dim", F.size("vector"))


def build_index(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and vector length, with the columns of INDEX; every usable row is in it."""
    small_batches(table.sparkSession)
    rows = _rows(table, id_col, vector_col)
    n = max(shards, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return checkpoint(rows.repartitionById(n, F.col("shard")).mapInArrow(_build_shards, INDEX))  # a task per shard


def search(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, ef: int = EF_SEARCH, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every usable query row, its own id left out. A task searches one
    shard for one block of queries: it holds shard_rows vectors and about `block` queries, whatever the tables' sizes, and is
    read once each by the tasks of its row and column; only k rows a query leave it."""
    rows = _rows(queries, id_col, vector_col).distinct()
    blocks = max(1, -(-rows.count() // block))
    shards = index.agg(F.max("shard")).first()[0]
    if shards is None:
        return rows.where("false").select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    asked = rows.select("id", "vector", F.col("dim").alias("length"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("ask"), F.explode(F.sequence(F.lit(0), F.lit(shards))).alias("part"))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = held.groupBy("dim", "shard", "block").cogroup(asked.groupBy("length", "part", "ask")).applyInArrow(
        lambda key, a, b: _search_shard(key, a, b, k, ef), "query_id long, vec_id long, score double"
    )
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
