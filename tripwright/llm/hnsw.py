"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard of vectors.

Vectors are dealt to shards by a hash of their id; a shard holds about ``SHARD_ROWS`` of them and is one task. In a
shard equal vectors are one node with the ``k + 1`` least ids (no query can use more), so that a vector that a third
of all rows hold doesn't fill the graph. The graph lies in flat arrays: a table of neighbours for level 0 and one for
each level above, -1 where a place is free. All queries go through every shard and the shards' nearest are merged.

Nodes are inserted in small rounds: the nodes of a round search the graph of the rounds before, many at once in array
operations, and are also compared with each other. Neighbours are chosen by the heuristic that skips a candidate
which is nearer to a chosen neighbour than to the node. Scores are exact distances in double precision of the original
vectors.

Defined cases: rows whose vector is null, empty, zero or has a null or non-finite component take no part, and neither
do rows with a null id; vectors of another length than the query's are no candidates; rows with one id and one vector
count once; ties go to the smaller id; with fewer candidates than ``k`` all are returned; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import bounded_batches, written

NEAREST = 10
SHARD_ROWS = 8_192
LINKS = 16
BUILD_WIDTH = 56
SEARCH_WIDTH = 128
SEED = 11
#: Components of a shard are brought below two to this power.
LARGEST_EXPONENT = 480


@dataclass
class Graph:
    """Level 0 first; ``rows[l]`` has the neighbours on level l, ``place[l]`` the row of a node there or -1."""

    vectors: np.ndarray
    rows: list[np.ndarray]
    place: list[np.ndarray]
    entry: int

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of nodes."""
        diff = self.vectors[nodes] - queries[:, None, :]
        return np.einsum("ijk,ijk->ij", diff, diff)

    def search(self, queries: np.ndarray, start: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found from the starts, for all queries at once: (nodes, distances), nearest first."""
        n = len(queries)
        nodes = np.full((n, width), -1, np.int64)
        dist = np.full((n, width), np.inf)
        open_ = np.zeros((n, width), bool)
        nodes[:, : start.shape[1]] = start
        dist[:, : start.shape[1]] = self.distances(queries, np.maximum(start, 0))
        dist[:, : start.shape[1]][start < 0] = np.inf
        order = np.argsort(dist, 1, kind="stable")
        nodes, dist = np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)
        open_ = np.isfinite(dist)
        seen = np.zeros((n, len(self.vectors)), bool)
        at, col = np.nonzero(nodes >= 0)
        seen[at, nodes[at, col]] = True
        table, place = self.rows[level], self.place[level]
        active = np.arange(n)
        while len(active):
            # each query expands its nearest node that is still open
            which = np.argmax(open_[active], 1)
            open_[active, which] = False
            near = table[place[nodes[active, which]]]
            fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            seen[active[r], near[r, c]] = True
            d = np.where(fresh, self.distances(queries[active], np.maximum(near, 0)), np.inf)
            both = np.concatenate([dist[active], d], 1)
            best = np.argsort(both, 1, kind="stable")[:, :width]
            dist[active] = np.take_along_axis(both, best, 1)
            nodes[active] = np.take_along_axis(np.concatenate([nodes[active], near], 1), best, 1)
            open_[active] = np.take_along_axis(np.concatenate([open_[active], np.isfinite(d)], 1), best, 1)
            active = active[open_[active].any(1)]
        return np.where(np.isfinite(dist), nodes, -1), dist

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """The start of each query on a level, found greedily from the top."""
        start = np.full((len(queries), 1), self.entry, np.int64)
        for level in range(len(self.rows) - 1, to, -1):
            start = self.search(queries, start, level, 1)[0]
        return start


def chosen(vectors: np.ndarray, node: int, near: np.ndarray, dist: np.ndarray, links: int) -> np.ndarray:
    """Neighbours of a node among candidates, nearest first, that are no nearer to a chosen one; then the rest."""
    between = vectors[near]
    norms = np.einsum("ij,ij->i", between, between)
    squares = (norms[:, None] + norms - 2 * between @ between.T).tolist()
    away = dist.tolist()
    kept: list[int] = []
    rest: list[int] = []
    for k in range(len(near)):
        if len(kept) == links:
            break
        to = squares[k]
        (kept if all(away[k] < to[o] for o in kept) else rest).append(k)
    kept += rest[: links - len(kept)]
    return near[kept]


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = SEED) -> Graph:
    """Graph over different vectors."""
    n = len(vectors)
    levels = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(links)).astype(int), 8)
    top = int(levels.max()) if n else 0
    place = [np.where(levels >= level, np.cumsum(levels >= level) - 1, -1) for level in range(top + 1)]
    caps = [2 * links] + [links] * top
    rows = [np.full((int((levels >= level).sum()), caps[level]), -1, np.int64) for level in range(top + 1)]
    graph = Graph(vectors, rows, place, int(np.argmax(levels)) if n else -1)
    order = np.concatenate([[graph.entry], np.delete(np.arange(n), graph.entry)]) if n else np.zeros(0, np.int64)
    inserted = 1

    def connect(level: int, node: int, near: np.ndarray, dist: np.ndarray) -> None:
        picked = chosen(vectors, node, near, dist, links)
        rows[level][place[level][node], : len(picked)] = picked
        for other in picked.tolist():
            row = rows[level][place[level][other]]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
                continue
            every = np.append(row, node)
            d = ((vectors[every] - vectors[other]) ** 2).sum(1)
            by = np.argsort(d, kind="stable")
            kept = chosen(vectors, other, every[by], d[by], caps[level])
            row[:] = -1
            row[: len(kept)] = kept

    while inserted < n:
        some = order[inserted : inserted + max(1, min(64, inserted // 8))]
        for level in range(top, -1, -1):
            mine = some[levels[some] >= level]
            if not len(mine):
                continue
            near, dist = graph.search(vectors[mine], graph.descend(vectors[mine], level), level, width)
            # the round's own nodes stand in no table yet
            own = ((vectors[mine][:, None, :] - vectors[mine][None]) ** 2).sum(2)
            for k, node in enumerate(mine.tolist()):
                have = near[k] >= 0
                before = np.arange(k)
                all_near = np.concatenate([near[k][have], mine[before]])
                all_dist = np.concatenate([dist[k][have], own[k, before]])
                by = np.argsort(all_dist, kind="stable")[:width]
                connect(level, node, all_near[by], all_dist[by])
        inserted += len(some)
    return graph


def nearest(graph: Graph, queries: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> Iterator[np.ndarray]:
    """Nodes of each query, nearest first."""
    if not len(graph.vectors):
        return
    for at in range(0, len(queries), 64):
        some = queries[at : at + 64]
        found, _ = graph.search(some, graph.descend(some, 0), 0, max(width, k))
        yield from (row[row >= 0] for row in found)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    values = F.col(vector_col).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(values, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & values.isNotNull() & ~bad & some)
    return rows.select(F.col(id_col).cast("long").alias("id"), values.alias("vector"))


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, links: int, width: int) -> list[tuple[int, int, float]]:
    """(query, id, distance) of the nearest in one shard."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    different, node = np.unique(vectors, axis=0, return_inverse=True)
    node = node.ravel()
    by = np.argsort(node, kind="stable")  # ids ascend inside a node
    begin = np.searchsorted(node[by], np.arange(len(different) + 1))
    members = [np.unique(ids[by[a : b]])[: k + 1] for a, b in zip(begin, begin[1:], strict=False)]
    # by a power of two, so that squares neither overflow nor vanish and scores keep every bit
    scale = int(np.frexp(max(np.abs(different).max(initial=0.0), np.abs(queries).max(initial=0.0)))[1]) - LARGEST_EXPONENT
    different, queries = np.ldexp(different, -scale), np.ldexp(queries, -scale)
    graph = build(different, links)
    out = []
    for q, nodes in enumerate(nearest(graph, queries, k, width)):
        exact = np.ldexp(np.sqrt(((different[nodes] - queries[q]) ** 2).sum(1)), scale)
        found = [(d, i) for d, x in zip(exact.tolist(), nodes.tolist(), strict=True) for i in members[x].tolist() if i != query_ids[q]]
        out += [(int(query_ids[q]), i, d) for d, i in sorted(found)[:k]]
    return out


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    shard_rows: int = SHARD_ROWS,
    links: int = LINKS,
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row, other than itself."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"])
    shards = max(1, -(-rows.count() // shard_rows))
    own = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "vector")
    every = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "id", "vector")

    def in_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        mine, theirs = by_length(left), by_length(right)
        for size in mine.keys() & theirs.keys():
            found += search_shard(*mine[size], *theirs[size], k, links, width)
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.float64())})

    found = own.groupBy("shard").cogroup(every.groupBy("shard")).applyInArrow(in_shard, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) for each length of vector."""
    ids = table.column("id").to_numpy()
    column = table.column("vector").combine_chunks()
    column = column if isinstance(column, pa.ListArray | pa.LargeListArray) else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    lengths = np.asarray(column.value_lengths()) if len(column) else np.zeros(0, np.int64)
    out = {}
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        out[size] = (ids[at], flat.reshape(len(at), size))
    return out
