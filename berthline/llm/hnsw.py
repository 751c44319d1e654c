"""Approximate nearest neighbours: one navigable small-world graph a shard.

Vectors are dealt to shards by hash; each shard's hierarchical graph (Malkov and
Yashunin, 2016) is built in one task and stored as flat neighbour arrays in the
shared folder.  Every query searches every shard of its dimension and the
shards' best are merged.  Equal vectors are one node with a list of its rows,
so copies neither cut the graph apart nor crowd each other out.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_path, workers_import_package, written
from .token_store import _get, _put

_BLOCK = 512                # queries or new nodes that walk a graph together


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 8192      # rows of a shard, about
    links: int = 16             # neighbours a node chooses; twice as many on the lowest layer
    build_width: int = 64       # candidates kept while building
    search_width: int = 128     # candidates kept while searching


# ---------------------------------------------------------------- graph
def _walk(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int,
          n: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walk of all rows of `q` at once over nodes 0..n-1 of a layer; entry:
    (queries, e) nodes, -1 for none.  -> (ids, scores), best first, -1 and -inf where fewer."""
    rows = np.arange(len(q))
    seen = np.zeros((len(q), n + 1), bool)              # the last column takes the -1s
    ids = np.full((len(q), width + entry.shape[1]), -1, np.int32)
    ids[:, :entry.shape[1]] = entry
    # an entry named twice counts once
    for j in range(entry.shape[1]):
        again = seen[rows, entry[:, j]] | (entry[:, j] < 0)
        ids[again, j] = -1
        seen[rows, entry[:, j]] = True
    score = np.where(ids >= 0, np.einsum("qd,qmd->qm", q, x[ids]), -np.inf).astype(np.float32)
    order = np.argsort(-score, axis=1, kind="stable")[:, :width]
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    done = ids < 0
    active = rows
    while len(active):
        open_score = np.where(done[active], -np.inf, score[active])
        at = open_score.argmax(axis=1)
        go = open_score[np.arange(len(active)), at] > -np.inf
        active, at = active[go], at[go]
        if not len(active):
            break
        done[active, at] = True
        near = links[ids[active, at]]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        near = np.where(fresh, near, -1)
        got = np.where(fresh, np.einsum("qd,qmd->qm", q[active], x[near]), -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_score = np.concatenate([score[active], got], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        order = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        score[active] = np.take_along_axis(all_score, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return ids, score


def _choose(x: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` diverse neighbours of each row's candidates (best first, -1 for none): one is
    taken if it is nearer to the row than to all taken before; places left over
    go to the best of the others."""
    n, c = ids.shape
    between = np.einsum("nid,njd->nij", x[ids], x[ids], optimize=True)
    taken = np.zeros((n, c), bool)
    for j in range(c):
        closest = np.where(taken, between[:, j, :], -np.inf).max(axis=1)
        taken[:, j] = (ids[:, j] >= 0) & (score[:, j] > closest) & (taken.sum(axis=1) < most)
    # taken first, then the others, each best first
    rank = np.where(ids < 0, 2, np.where(taken, 0, 1)) * c + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _ranked(x: np.ndarray, own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of nodes `own`, without repeats and the nodes themselves, best first."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids[ids == own[:, None]] = -1
    score = np.where(ids >= 0, np.einsum("nd,nmd->nm", x[own], x[ids]), -np.inf)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)


def _layer(x: np.ndarray, n: int, most: int, width: int, enter) -> np.ndarray:
    """Neighbour array (n, most) over nodes 0..n-1, added in order, some at a time."""
    links = np.full((n, most), -1, np.int32)
    a = 0
    while a < n:
        b = min(n, a + max(64, min(_BLOCK, a)))
        own = np.arange(a, b)
        # the new ones among themselves, and what a walk over the older ones finds
        inner = x[a:b] @ x[a:b].T
        np.fill_diagonal(inner, -np.inf)
        some = min(width, b - a)
        ids = np.argsort(-inner, axis=1, kind="stable")[:, :some].astype(np.int32) + a
        if a:
            ids = np.concatenate([ids, _walk(x, links, x[a:b], enter(own, a), width, n)[0]], axis=1)
        ids, score = _ranked(x, own, ids)
        ids, score = ids[:, :width], score[:, :width]
        chosen = _choose(x, ids, score, max(1, most // 2))      # the other places are for links back
        links[a:b, :chosen.shape[1]] = chosen
        # links back: each chosen neighbour gets the new node among its candidates
        source = np.repeat(own, links.shape[1])
        target = links[a:b].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        back = np.full((len(nodes), count.max(initial=1)), -1, np.int32)    # a layer may hold a single node
        back[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        for i in range(0, len(nodes), _BLOCK):
            part = nodes[i:i + _BLOCK]
            ids, score = _ranked(x, part, np.concatenate([links[part], back[i:i + _BLOCK]], axis=1))
            keep = min(max(1, int((ids >= 0).sum(axis=1).max())), width)
            links[part] = _choose(x, ids[:, :keep], score[:, :keep], most)
        a = b
    return links


class Graph:
    """The layers over distinct vectors, nodes in the order of their top layer."""

    def __init__(self, vectors: np.ndarray, members: np.ndarray, starts: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.members, self.starts, self.layers = vectors, members, starts, layers
        self.space = np.ascontiguousarray(vectors, np.float32)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, conf: Settings) -> Graph:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order] + 0.0)   # no negative zeros
        _, first, node = np.unique(vectors.view(f"V{8 * vectors.shape[1]}").ravel(), return_index=True,
                                   return_inverse=True)
        # levels from a hash of the smallest id: the same graph whatever the order of rows
        h = (ids[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        u = ((h >> np.uint64(11)).astype(float) + 1) / (1 << 53)
        level = np.floor(-np.log(u) / np.log(conf.links)).astype(int)
        place = np.lexsort((first, -level))             # nodes: highest first
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        node = rank[node]
        by_node = np.argsort(node, kind="stable")       # members of a node by id
        starts = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(place)))])
        graph = cls(vectors[first[place]], ids[by_node], starts, [])
        # inner products rank like distances once all vectors have one length
        norm2 = (graph.vectors ** 2).sum(axis=1)
        x = np.column_stack([graph.vectors, np.sqrt(np.maximum(norm2.max() - norm2, 0.0))]).astype(np.float32)
        for top in range(level.max(), -1, -1):
            n = int((level >= top).sum())
            above = list(graph.layers)

            def enter(own: np.ndarray, older: int) -> np.ndarray:
                at = np.zeros((len(own), 1), np.int32)
                for links in above:
                    at = _walk(x, links, x[own], at, 8, len(links))[0]
                return np.where(at < older, at, -1)
            links = _layer(x, n, conf.links * (2 if top == 0 else 1), conf.build_width, _never_lost(enter))
            graph.layers.append(links)
        return graph

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Nodes of each query, best first, -1 where fewer."""
        out = np.full((len(queries), width), -1, np.int32)
        for a in range(0, len(queries), _BLOCK):
            q = np.ascontiguousarray(queries[a:a + _BLOCK], np.float32)
            at = np.zeros((len(q), 1), np.int32)
            for links in self.layers[:-1]:
                at = _walk(self.space, links, q, at, 8, len(links))[0]
            out[a:a + _BLOCK] = _walk(self.space, self.layers[-1], q, at, width, len(self.layers[-1]))[0]
        return out

    def best(self, query: np.ndarray, own: int, nodes: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k best rows of the nodes found, without row `own`: (id, score)."""
        nodes = nodes[nodes >= 0]
        score = (self.vectors[nodes] * query).sum(axis=1)
        found = []
        for i in np.argsort(-score, kind="stable"):
            if len(found) >= k and score[i] < found[k - 1][1]:
                break
            a, b = self.starts[nodes[i]], self.starts[nodes[i] + 1]
            found += [(int(m), float(score[i])) for m in self.members[a:min(b, a + k + 1)] if m != own]
        return sorted(found, key=lambda f: (-f[1], f[0]))[:k]

    def to_bytes(self) -> list[bytes]:
        arrays = [self.vectors, self.members, self.starts, *self.layers]
        head = json.dumps([[a.dtype.str, a.shape] for a in arrays]).encode()
        return [len(head).to_bytes(4, "little"), head, *(np.ascontiguousarray(a).tobytes() for a in arrays)]

    @classmethod
    def from_bytes(cls, raw: bytes) -> Graph:
        size = int.from_bytes(raw[:4], "little")
        at, arrays = 4 + size, []
        for dtype, shape in json.loads(raw[4:at]):
            count = int(np.prod(shape))
            arrays.append(np.frombuffer(raw, dtype, count, at).reshape(shape))
            at += count * np.dtype(dtype).itemsize
        return cls(*arrays[:3], arrays[3:])


def _never_lost(enter):
    """Entry nodes for new ones; node 0, the first added, where none of those found is older."""
    def safe(own: np.ndarray, older: int) -> np.ndarray:
        at = enter(own, older)
        lost = (at < 0).all(axis=1)
        at[lost, 0] = 0
        return at
    return safe


# ---------------------------------------------------------------- Spark side
def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    limit = F.lit(float("inf"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(
        F.coalesce(fine, F.lit(False))).withColumn("dim", F.size("v"))


def _shard_count(dims: Column, counts: dict[int, int], rows: int) -> Column:
    n = F.lit(1)
    for dim, count in counts.items():
        n = F.when(dims == dim, F.lit(-(-count // rows))).otherwise(n)
    return n


def build(rows: DataFrame, folder: str, conf: Settings, counts: dict[int, int]) -> DataFrame:
    """Write one graph a shard; -> (dim, shard, n_rows, n_nodes).  A shard holds
    `shard_rows` rows of one dimension, about, whatever its vectors are."""
    n = _shard_count(F.col("dim"), counts, conf.shard_rows)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), n).cast("int"))
    plain = Settings(**asdict(conf))

    def make(group: pd.DataFrame) -> pd.DataFrame:
        dim, shard = int(group["dim"].iloc[0]), int(group["shard"].iloc[0])
        graph = Graph.build(group["vec_id"].to_numpy(np.int64), np.vstack(group["v"].to_numpy()).astype(float), plain)
        _put(folder, _name(dim, shard), graph.to_bytes())
        return pd.DataFrame({"dim": [dim], "shard": [shard], "n_rows": [len(group)], "n_nodes": [len(graph.vectors)]})
    return written(dealt.groupBy("dim", "shard").applyInPandas(
        make, "dim int, shard int, n_rows long, n_nodes long"), "hnsw-shards")


def _name(dim: int, shard: int) -> str:
    return f"graph-{dim}-{shard:05d}"


def search(queries: DataFrame, shards: DataFrame, folder: str, k: int, conf: Settings) -> DataFrame:
    """`queries(vec_id, v, dim)` against all shards of their dimension; -> the k best rows
    of each shard and query: (query_id, vec_id, score)."""
    tasks = queries.join(shards.select("dim", "shard"), "dim").select("vec_id", "v", "dim", "shard")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(16))
    tasks = tasks.repartition("dim", "shard", block).sortWithinPartitions("dim", "shard")
    width = max(conf.search_width, k + 1)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, graph = None, None
        for batch in batches:
            dims, places = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            ids, v = batch.column("vec_id").to_numpy(), batch.column("v")
            out = []
            # rows are sorted: each (dimension, shard) is one run
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(places) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if a == b:
                    continue
                key = (int(dims[a]), int(places[a]))
                if key != held:
                    held, graph = key, Graph.from_bytes(_get(folder, _name(*key)))
                q = np.array(v.slice(a, b - a).to_pylist(), float)
                for i, nodes in enumerate(graph.search(q, width)):
                    own = int(ids[a + i])
                    out += [(own, m, s) for m, s in graph.best(q[i], own, nodes, k)]
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                pa.array([o[2] for o in out], pa.float64())], ["query_id", "vec_id", "score"])
    return tasks.mapInArrow(find, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column | None = None, k: int = 20, conf: Settings = Settings(),
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows found for each query row, by largest inner product: query_id, rank
    (from 1), vec_id, score (on the vectors given, in double precision); ties go to
    the smaller id.

    `is_query` is a condition on vec_id (default: all rows).  Null ids, and vectors that
    are null, empty, zero or hold nulls or non-finite numbers take no part.
    Vectors of another dimension are not compared.  A query's own id is no
    candidate; a repeated query id is one query, of its smallest vector.  Other
    columns are not read.  An empty table gives an empty table."""
    workers_import_package(vectors.sparkSession)
    folder = shared_path(vectors.sparkSession, "hnsw")
    rows = written(usable(vectors, id_col, vector_col), "hnsw-vectors")
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    shards = build(rows, folder, conf, counts)
    queries = rows if is_query is None else rows.where(is_query)
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    found = search(queries, shards, folder, k, conf)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
