"""Exact top-k by inner product with a KD-tree in every shard.

A coarse tree over a bounded sample deals the vectors to cells by median splits, so that shards have tight boxes; large cells are
dealt to several shards. The tree of a shard splits at the median of the widest dimension; nodes keep tight boxes, from which the
highest possible score of a query follows. A block of queries walks a tree together, best box first, while a box can still reach
the k-th score of one of its queries. Each query first meets the shard whose box promises most; the k-th score found there
decides which other shards it meets at all.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import written

SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 512, 256
# The coarse tree is made from at most about so many numbers, and has at most so many cells for each length of vectors.
SAMPLE_VALUES, CELLS = 1 << 20, 1024
# Boxes of shards that a block of queries is compared with at once.
BOXES = 512
# Sums of products up to here are exact as floating point numbers.
_EXACT = 2**52
_NONE = -(2**63)
_PAIR = "dim int, shard long, block int, queries binary"


class Tree(NamedTuple):
    ids: np.ndarray
    rows: np.ndarray  # numbers of the rows, which a vector has alone
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray  # the right child is the next one; -1 in leaves


def build_tree(ids: np.ndarray, rows: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    order = np.arange(len(ids))
    spans, left = [(0, len(ids))], [-1]
    at = 0
    while at < len(spans):
        a, b = spans[at]
        part = order[a:b]
        wide = np.ptp(points[part], axis=0) if b > a and points.shape[1] else np.zeros(1)
        if b - a > leaf and wide.max() > 0:
            middle = (b - a) // 2
            order[a:b] = part[np.argpartition(points[part, int(wide.argmax())], middle)]
            left[at] = len(spans)
            spans += [(a, a + middle), (a + middle, b)]
            left += [-1, -1]
        at += 1
    low = np.array([points[order[a:b]].min(axis=0) for a, b in spans])
    high = np.array([points[order[a:b]].max(axis=0) for a, b in spans])
    first, last = np.array(spans).T
    return Tree(ids[order], rows[order], points[order], low, high, first, last, np.array(left))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if most < _EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The highest score of each query in each box: its best corner has the high side where the query is positive, else the low."""
    return _dot(np.maximum(queries, 0), high.T) + _dot(np.minimum(queries, 0), low.T)


class Best:
    """The k best candidates of each query of a block, ties to the smaller id."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.score = np.full((len(floor), k), _NONE, np.int64)
        self.id = np.zeros((len(floor), k), np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Candidates of some queries: a row of `scores` for each, a column for each id."""
        least = self.floor[queries]
        if scores.shape[1] > self.k:
            # A query's own row is among them at most once.
            least = np.maximum(least, np.partition(scores, -self.k - 1, axis=1)[:, -self.k - 1])
        row, column = np.nonzero(allowed & (scores >= least[:, None]))
        if not len(row):
            return
        touched = np.unique(row)
        q = np.concatenate([row, np.repeat(touched, self.k)])
        score = np.concatenate([scores[row, column], self.score[queries[touched]].ravel()])
        vec = np.concatenate([ids[column], self.id[queries[touched]].ravel()])
        order = np.lexsort((vec, -np.maximum(score, _NONE + 1), q))
        q, score, vec = q[order], score[order], vec[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        top = nth < self.k
        at = queries[touched]
        self.score[at], self.id[at] = score[top].reshape(-1, self.k), vec[top].reshape(-1, self.k)
        self.floor[at] = np.maximum(self.floor[at], self.score[at, -1])


def search(tree: Tree, rows: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vector id, score) of the k best of each query, and none below its floor; how many leaves were read.

    `rows` are the numbers of the queries' own rows, which are no candidates.
    """
    best, leaves = Best(k, floor), 0
    everyone = np.arange(len(rows))
    root = bounds(queries, tree.low[:1], tree.high[:1])[:, 0]
    heap = [(-int(root.max(initial=_NONE + 1)), 0, everyone, root)]
    while heap:
        _, node, some, bound = heapq.heappop(heap)
        alive = bound >= best.floor[some]
        some = some[alive]
        if not len(some):
            continue
        child = int(tree.left[node])
        if child < 0:
            leaves += 1
            part = slice(tree.first[node], tree.last[node])
            scores = _dot(queries[some], tree.points[part].T)
            best.add(some, scores, tree.ids[part], tree.rows[part][None, :] != rows[some][:, None])
            continue
        both = bounds(queries[some], tree.low[child : child + 2], tree.high[child : child + 2])
        for side in (0, 1):
            heapq.heappush(heap, (-int(both[:, side].max()), child + side, some, both[:, side]))
    query, place = np.nonzero(best.score > _NONE)
    return query, best.id[query, place], best.score[query, place], leaves


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as f:
        return {name: f[name] for name in f.files}


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False) if column.num_chunks else np.zeros(0, np.int64)
    return np.ascontiguousarray(flat.reshape(rows, -1))


def _slim(points: np.ndarray) -> np.ndarray:
    small = len(points) and np.abs(points).max(initial=0) < 2**31
    return points.astype(np.int32) if small else points


def _tree(table: pa.Table) -> pa.Table:
    points = _matrix(table.column("v"), table.num_rows)
    tree = build_tree(table.column("vec_id").to_numpy(), table.column("row").to_numpy(), points)
    slim = tree._replace(points=_slim(tree.points))
    return pa.table({
        "dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "tree": pa.array([_packed(slim._asdict())], pa.binary()),
        "low": pa.array([tree.low[0].tolist()], pa.list_(pa.int64())), "high": pa.array([tree.high[0].tolist()], pa.list_(pa.int64())),
    })


def _boxes(table: pa.Table) -> pa.Table:
    """The boxes of some shards in one row."""
    content = {"shard": table.column("shard").to_numpy()} | {c: _matrix(table.column(c), table.num_rows) for c in ("low", "high")}
    return pa.table({"dim": table.column("dim")[:1], "some": table.column("some")[:1], "boxes": pa.array([_packed(content)], pa.binary())})


def _block(table: pa.Table) -> pa.Table:
    content = {c: table.column(c).to_numpy() for c in ("row", "vec_id", "floor", "seen")} | {"v": _matrix(table.column("v"), table.num_rows)}
    return pa.table({"dim": table.column("dim")[:1], "block": table.column("block")[:1], "queries": pa.array([_packed(content)], pa.binary())})


def _promises(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shard whose box promises a query most, among some boxes."""
    for batch in batches:
        for queries, boxes in zip(batch.column("queries"), batch.column("boxes")):
            q, b = _unpacked(queries.as_py()), _unpacked(boxes.as_py())
            reach = bounds(q["v"], b["low"], b["high"])
            most = reach.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q["row"]), pa.array(reach[np.arange(len(most)), most]), pa.array(b["shard"][most])], names=["row", "bound", "shard"]
            )


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard of some boxes that a query of the block can find something in, with those queries."""
    for batch in batches:
        for dim, block, queries, boxes in zip(batch.column("dim"), batch.column("block"), batch.column("queries"), batch.column("boxes")):
            q, b = _unpacked(queries.as_py()), _unpacked(boxes.as_py())
            meet = (bounds(q["v"], b["low"], b["high"]) >= q["floor"][:, None]) & (q["seen"][:, None] != b["shard"][None, :])
            for at in np.flatnonzero(meet.any(axis=0)):
                part = _packed({name: values[meet[:, at]] for name, values in q.items()})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim.as_py()], pa.int32()), pa.array([int(b["shard"][at])], pa.int64()), pa.array([block.as_py()], pa.int32()), pa.array([part], pa.binary())],
                    names=["dim", "shard", "block", "queries"],
                )


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, queries in zip(batch.column("tree"), batch.column("queries")):
                q, t = _unpacked(queries.as_py()), Tree(**_unpacked(tree.as_py()))
                t = t._replace(points=t.points.astype(np.int64))
                query, vec_id, score, _ = search(t, q["row"], q["v"], k, q["floor"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q["row"][query]), pa.array(q["vec_id"][query]), pa.array(vec_id), pa.array(score)], names=["row", "query_id", "vec_id", "score"]
                )

    return run


class Cut(NamedTuple):
    dimension: int
    at: int  # up to here to the left
    left: "Cut | int"
    right: "Cut | int"


def coarse_tree(points: np.ndarray, cells: int) -> Cut | int:
    """Median splits of a sample along its widest dimension, into at most so many cells; a cell is a number."""
    numbers = iter(range(cells))

    def split(part: np.ndarray, room: int) -> Cut | int:
        wide = np.ptp(part, axis=0) if len(part) and part.shape[1] else np.zeros(1)
        if room < 2 or wide.max() == 0:
            return next(numbers)
        d = int(wide.argmax())
        values = np.sort(part[:, d])
        at = values[(len(values) - 1) // 2]
        if at == values[-1]:
            at = values[values < at][-1]
        left = part[:, d] <= at
        return Cut(d, int(at), split(part[left], room // 2), split(part[~left], room - room // 2))

    return split(points, cells)


def cells_of(points: np.ndarray, tree: Cut | int) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(np.arange(len(points)), tree)]
    while todo:
        rows, node = todo.pop()
        if isinstance(node, Cut):
            left = points[rows, node.dimension] <= node.at
            todo += [(rows[left], node.left), (rows[~left], node.right)]
        else:
            out[rows] = node
    return out


def _sharded(rows: DataFrame, dims: dict[int, int]) -> DataFrame:
    """`rows` with `shard`: the cell, and where a cell has more rows than a shard takes, a part of it by hash."""
    trees = {}
    for dim, count in dims.items():
        cells = min(CELLS, count // SHARD_ROWS)
        if cells > 1 and dim:
            # About this many of the rows, dealt by the hash of their number.
            wanted = max(cells, SAMPLE_VALUES // dim)
            some = rows.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("row"), F.lit(max(1, count // wanted))) == 0)).select("v").collect()
            trees[dim] = coarse_tree(np.array([r["v"] for r in some], np.int64).reshape(len(some), dim), cells)
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, cell = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for d, tree in shared.value.items():
                at = np.flatnonzero(dim == d)
                cell[at] = cells_of(batch.column("v").take(pa.array(at)).flatten().to_numpy().reshape(len(at), d), tree)
            yield batch.append_column("cell", pa.array(cell))

    dealt_rows = written(rows.mapInArrow(dealt, "vec_id long, v array<long>, dim int, row long, cell long"), "cells")
    parts = dealt_rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64(F.col("row"), F.lit(1)), F.col("parts"))
    # A cell's number, then that of the part.
    return dealt_rows.join(parts, ["dim", "cell"]).withColumn("shard", F.col("cell") + CELLS * part).drop("cell", "parts")


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v, dim): v = floor(scale * x), for vectors without NULL or non-finite components. Rows with the same vec_id stay
    rows of their own. Rows without vec_id take no part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(scale * c.cast("double")).cast("long"))
    rows = vectors.where(x.isNotNull() & F.col("vec_id").isNotNull()).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumn("dim", F.size("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row with the other rows of `vectors`.

    `vectors` is (vec_id, v, dim). Every row is a candidate for every query but itself, so a query meets other rows with its own
    vec_id, and a vec_id on several query rows has the ranks from 1 for each of them. Only vectors of the query's length are
    compared. Ties go to the smaller vec_id; with fewer than k candidates all are returned. An empty table gives an empty one.
    """
    # Written, so that a row keeps its number.
    rows = written(vectors.select("vec_id", "v", "dim", F.monotonically_increasing_id().alias("row")), "vectors")
    dims = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    trees = written(
        _sharded(rows, dims).groupBy("dim", "shard")
        .applyInArrow(_tree, "dim int, shard long, tree binary, low array<long>, high array<long>"), "trees",
    )
    boxes = trees.select("dim", "shard", "low", "high", F.floor(F.row_number().over(Window.partitionBy("dim").orderBy("shard")) / BOXES).cast("int").alias("some"))
    boxes = written(boxes.groupBy("dim", "some").applyInArrow(_boxes, "dim int, some int, boxes binary"), "boxes")
    blocks = max(1, math.ceil(rows.where(is_query).count() / BLOCK_ROWS))
    queries = rows.where(is_query).withColumn("block", F.pmod(F.xxhash64(F.col("row"), F.lit(2)), F.lit(blocks)).cast("int"))

    def facing(some: DataFrame) -> DataFrame:
        """Each block of queries beside each row of boxes, spread over all tasks."""
        packed = some.groupBy("dim", "block").applyInArrow(_block, "dim int, block int, queries binary")
        return packed.join(boxes, "dim").repartition(F.col("block"), F.col("some"))

    def found(pairs: DataFrame, label: str) -> DataFrame:
        met = pairs.join(trees.select("dim", "shard", "tree"), ["dim", "shard"]).repartition(F.col("shard"), F.col("block"))
        return written(met.select("tree", "queries").mapInArrow(_searched(k), "row long, query_id long, vec_id long, score long"), label)

    none = F.lit(_NONE + 1)
    reach = facing(queries.withColumn("floor", none).withColumn("seen", none)).mapInArrow(_promises, "row long, bound long, shard long")
    nearest = written(reach.groupBy("row").agg(F.max_by("shard", F.struct("bound", "shard")).alias("seen")), "nearest")
    first = queries.join(nearest, "row").withColumn("floor", none)
    # A shard that many queries begin with meets them in blocks.
    at_first = first.groupBy("dim", "seen", "block").applyInArrow(
        lambda t: _block(t).append_column("shard", t.column("seen")[:1]).select(["dim", "shard", "block", "queries"]), _PAIR
    )
    seeds = found(at_first, "seeds")
    floors = seeds.groupBy("row").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k).select("row", "floor")
    bounded = queries.join(nearest, "row").join(floors, "row", "left").withColumn("floor", F.coalesce("floor", none))
    rest = found(facing(bounded).mapInArrow(_meetings, _PAIR), "hits")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = seeds.union(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
