"""Exact top-k search by inner product in M-trees.

Vectors get one more component so that all have the norm of the longest one; then the distance to a query falls as the inner
product grows, and the triangle inequality holds. The rows are dealt to trees by their nearest routing object. A tree has
paged nodes with a covering radius, and each entry keeps its distance to the node's routing object. Search is best-first:
a node is left out if its ball is farther than the k-th best so far, an entry's distance is not computed if the difference of
the stored and the query's distance to the routing object says enough. Scores are exact integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

SCALE = 256
PAGE, FANOUT = 256, 16
#: Bounds of what the driver takes and broadcasts: seed vectors of each dimension, of which the first are routing objects.
SEEDS, PIVOTS = 1024, 16
TREE_ROWS = 32_768
QUERIES_PER_BLOCK = 100_000
EXACT = 2.0 ** 52

#: No two vectors of smaller squared norm have an inner product beyond 64 bits.
LARGEST = 2.0 ** 62


def _ints(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, vec, norm2): the scaled integer vector as bytes and its squared norm; unusable vectors are left out.

    So are those whose squared norm reaches `LARGEST`: below it no inner product exceeds 64 bits, beyond it a score may not be a long.
    """
    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, dims, out, norms = [], [], [], []
            for i, value in enumerate(batch.column("v").to_pylist()):
                if value is None or not len(value) or any(x is None for x in value):
                    continue
                x = np.asarray(value, np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    scaled = np.floor(SCALE * x)
                    if not (scaled ** 2).sum() < LARGEST:
                        continue
                whole = scaled.astype(np.int64)
                at.append(i)
                dims.append(len(whole))
                out.append(whole.tobytes())
                norms.append(float((whole.astype(np.float64) ** 2).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at, pa.int64())), pa.array(dims, pa.int32()), pa.array(out, pa.binary()), pa.array(norms, pa.float64())],
                ["vec_id", "dim", "vec", "norm2"])

    rows = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.mapInArrow(scale, "vec_id long, dim int, vec binary, norm2 double")


def _matrix(column: pa.ChunkedArray | pa.Array | list) -> np.ndarray:
    rows = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where every sum is below 2^52, else in 64-bit integers."""
    if rows.size and float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1] < EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return rows @ query


def lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that brings each squared norm to `top`."""
    x = rows.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))])


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = rows - point
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Node(NamedTuple):
    """A page. `rows` are its entries if it is a leaf; `centres`, `radii` and `nodes` describe its children otherwise.

    `to_parent` has the distance of each entry or child to this page's routing object.
    """

    rows: np.ndarray | None
    to_parent: np.ndarray
    centres: np.ndarray | None
    radii: np.ndarray | None
    nodes: list | None


class MTree:
    def __init__(self, ids: np.ndarray, rows: np.ndarray, top: float):
        self.ids, self.rows, self.top = ids, rows, top
        self.exact = float(np.abs(rows).max(initial=0)) if len(rows) else 0.0
        self.points = lifted(rows, top)
        self.floats = self.points[:, :-1]
        self.slack = 1e-9 * max(1.0, top) ** 0.5 + 1e-6
        self.centre = self.points[0]
        self.root = self._node(np.arange(len(ids)), self.centre)

    def _node(self, at: np.ndarray, centre: np.ndarray) -> Node:
        own = distances(self.points[at], centre)
        if len(at) <= PAGE:
            return Node(at, own, None, None, None)
        pivots = [at[int(np.argmax(own))]]
        nearest = distances(self.points[at], self.points[pivots[0]])
        side = np.zeros(len(at), np.int64)
        while len(pivots) < FANOUT and nearest.max() > 0:
            pivots.append(at[int(np.argmax(nearest))])
            d = distances(self.points[at], self.points[pivots[-1]])
            side[d < nearest] = len(pivots) - 1
            nearest = np.minimum(nearest, d)
        if len(pivots) == 1:  # one point many times
            parts = [at[k:k + PAGE] for k in range(0, len(at), PAGE)]
            pivots = [p[0] for p in parts]
        else:
            parts = [at[side == k] for k in range(len(pivots))]
        centres = self.points[pivots]
        return Node(None, distances(centres, centre), centres,
                    np.array([distances(self.points[p], c).max() for p, c in zip(parts, centres, strict=True)]),
                    [self._node(p, c) for p, c in zip(parts, centres, strict=True)])

    def search(self, query: np.ndarray, count: int, least: int | None = None) -> list[tuple[int, int]]:
        """(score, id) of the best `count` rows, larger scores and then smaller ids first; rows below `least` may be left out."""
        point = np.append(query.astype(np.float64), 0.0)
        norm2 = float((point * point).sum())
        safe = self.exact * float(np.abs(query).max(initial=0)) * max(1, len(query)) < EXACT
        best: list[tuple[int, int]] = []  # a heap with the worst on top: (score, -id)

        def reach() -> float:
            floor = best[0][0] if len(best) == count else least
            if floor is None:
                return np.inf
            if least is not None:
                floor = max(floor, least)
            return np.sqrt(max(0.0, norm2 + self.top - 2.0 * floor)) + self.slack

        bound = reach()
        first = float(distances(self.centre[None], point)[0])
        queue: list[tuple[float, int, float, Node]] = [(0.0, 0, first, self.root)]
        made = 1
        while queue:
            low, _, away, node = heapq.heappop(queue)
            if low > bound:
                break
            if node.rows is not None:
                near = node.rows[np.abs(away - node.to_parent) <= bound]
                if not len(near):
                    continue
                scores = (self.floats[near] @ point[:-1]).astype(np.int64) if safe else self.rows[near] @ query
                if len(best) == count:
                    able = scores >= best[0][0]
                    near, scores = near[able], scores[able]
                if len(near) > count:
                    able = scores >= np.partition(scores, len(near) - count)[len(near) - count]
                    near, scores = near[able], scores[able]
                for s, i in zip(scores.tolist(), self.ids[near].tolist(), strict=True):
                    if len(best) < count:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                bound = reach()
                continue
            able = np.flatnonzero(np.abs(away - node.to_parent) - node.radii <= bound)
            if not len(able):
                continue
            d = distances(node.centres[able], point)
            for k, own in zip(able.tolist(), d.tolist(), strict=True):
                if (gap := max(0.0, own - float(node.radii[k]))) <= bound:
                    heapq.heappush(queue, (gap, made, own, node.nodes[k]))
                    made += 1
        return [(s, -i) for s, i in sorted(best, key=lambda x: (-x[0], -x[1]))]


class Routing(NamedTuple):
    """By dimension: seed vectors, their ids, and the squared norm that all are lifted to."""

    seeds: dict[int, np.ndarray]
    ids: dict[int, np.ndarray]
    top: dict[int, float]


def _routing(rows: DataFrame) -> Routing:
    """Seeds are the first vectors of each dimension in hash order; at most `SEEDS` for each dimension."""
    tops = {r["dim"]: r["top"] for r in rows.groupBy("dim").agg(F.max("norm2").alias("top")).collect()}
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec"), "vec_id"))
    chosen = rows.withColumn("rank", rank).where(F.col("rank") <= SEEDS).orderBy("dim", "rank").select("dim", "vec_id", "vec").toArrow()
    dims = chosen.column("dim").to_numpy()
    seeds, ids = {}, {}
    for dim in tops:
        own = chosen.filter(pa.array(dims == dim))
        seeds[dim], ids[dim] = _matrix(own.column("vec")), own.column("vec_id").to_numpy()
    return Routing(seeds, ids, tops)


def _with_cells(rows: DataFrame, sent) -> DataFrame:
    """Adds the nearest routing object and the distance to it."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            vectors = batch.column("vec").to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = lifted(_matrix([vectors[i] for i in at]), sent.value.top[dim])
                pivots = lifted(sent.value.seeds[dim][:PIVOTS], sent.value.top[dim])
                d = np.column_stack([distances(own, p) for p in pivots])
                cell[at], away[at] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])

    return rows.mapInArrow(cells, "vec_id long, dim int, vec binary, norm2 double, cell int, away double")


def _routed_queries(queries: DataFrame, sent, trees: DataFrame, count: int) -> DataFrame:
    """(dim, cell, salt, block, query, least) for each query and each tree whose ball may hold one of its best rows.

    `least` is the score of the count-th best seed, which no row below can beat.
    """
    balls = {(r["dim"], r["cell"]): (r["radius"], r["salts"]) for r in trees.collect()}  # at most PIVOTS for each dimension

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routing = sent.value
        for batch in batches:
            out: list[tuple] = []
            at = []
            for i, (dim, vec) in enumerate(zip(batch.column("dim").to_pylist(), batch.column("vec").to_pylist(), strict=True)):
                query = np.frombuffer(vec, np.int64)
                seeds = products(routing.seeds[dim], query)
                least = int(np.sort(seeds)[-count]) if len(seeds) >= count else None
                point = np.append(query.astype(np.float64), 0.0)
                top = routing.top[dim]
                d = distances(lifted(routing.seeds[dim][:PIVOTS], top), point)
                bound = np.inf if least is None else np.sqrt(max(0.0, float((point * point).sum()) + top - 2.0 * least))
                for cell, own in enumerate(d.tolist()):
                    radius, salts = balls.get((dim, cell), (0.0, 0))
                    if own - radius <= bound + 1e-6 + 1e-9 * top ** 0.5:
                        out += [(cell, s, least) for s in range(salts)]
                        at += [i] * salts
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64())))],
                [*rows.schema.names, "cell", "salt", "least"])

    return queries.mapInArrow(route, "vec_id long, dim int, vec binary, block int, cell int, salt int, least long")


def top_k(vectors: DataFrame, queries: DataFrame, count: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the `count` rows of largest inner product for each query, ties to smaller ids.

    Both tables have vec_id and embedding. Rows with the query's own id are no candidates, nor are rows without an id. Vectors that are null, empty,
    or hold null or non-finite components take no part; vectors of other dimensions than the query's are no candidates.
    Of equal vectors only the count + 1 smallest ids can be among a query's best, so a vector that a third of the
    rows share costs nothing; equal queries are searched once.
    """
    base = stored(_ints(vectors), "vectors")
    asked = stored(_ints(queries).select("vec_id", "dim", "vec").distinct(), "queries")
    copies = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    rows = stored(base.distinct().withColumn("copy", copies).where(F.col("copy") <= count + 1).drop("copy"), "kept")
    sent = vectors.sparkSession.sparkContext.broadcast(_routing(rows))
    placed = stored(_with_cells(rows, sent), "cells")
    trees = placed.groupBy("dim", "cell").agg(F.max("away").alias("radius"), F.ceil(F.count("*") / TREE_ROWS).cast("int").alias("salts"))
    single = asked.groupBy("dim", "vec").agg(F.min("vec_id").alias("vec_id"))
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    single = stored(single.select("vec_id", "dim", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")), "single")
    routed = _routed_queries(single, sent, trees, count + 1)
    dealt = placed.join(F.broadcast(trees.select("dim", "cell", "salts")), ["dim", "cell"]).select(
        "vec_id", "dim", "vec", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cell",
        F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt"), F.lit(None).cast("long").alias("least"), F.lit(0).alias("side"))
    key = ["dim", "cell", "salt", "block"]
    both = dealt.unionByName(routed.withColumn("side", F.lit(1))).repartition(*key).sortWithinPartitions(*key, "side", "vec_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tree's rows come first, then the queries for it, a batch at a time."""
        now, tree = None, None
        ids: list[int] = []
        parts: list[bytes] = []
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            columns = [batch.column(c).to_pylist() for c in (*key, "side", "vec_id", "vec", "least")]
            for *own, side, number, vec, least in zip(*columns, strict=True):
                if own != now:
                    now, tree, ids, parts = own, None, [], []
                if side == 0:
                    ids.append(number)
                    parts.append(vec)
                    continue
                if tree is None and ids:
                    tree = MTree(np.array(ids), _matrix(parts), sent.value.top[own[0]])
                    parts = []
                if tree is not None:
                    found += [(number, i, s) for s, i in tree.search(np.frombuffer(vec, np.int64), count + 1, least)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["single", "vec_id", "score"])

    order = Window.partitionBy("single").orderBy(F.desc("score"), "vec_id")
    best = both.mapInArrow(search, "single long, vec_id long, score long").withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= count + 1)
    named = asked.join(single.select(F.col("vec_id").alias("single"), "dim", "vec"), ["dim", "vec"]).select(
        F.col("vec_id").alias("query_id"), "single")
    per_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return named.join(best, "single").where(F.col("query_id") != F.col("vec_id")).withColumn(
        "rank", F.row_number().over(per_query)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")


def search_sql(every: int = 50, count: int = 5) -> str:
    """DuckDB SQL that compares every query with every row."""
    return f"""
with v as (select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {every} = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= {count}"""
