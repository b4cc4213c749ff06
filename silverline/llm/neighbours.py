"""Nearest neighbours by largest inner product, over low-dimensional stable projections.

Inner products become distances by one added component that gives every candidate the same
length. `DIMS` random Gaussian directions then project the vectors: the squared projected
distance of two vectors, divided by their squared distance, has a chi-square distribution with
that many degrees of freedom, whatever the original dimension. A kd-tree over the projections
hands out candidates by growing projected distance; each is verified with its exact inner
product. A search stops when the next box lies so far away, measured by the k-th best distance
so far, that the chi-square test is sure that what lies there is not nearer; inside a box, a
candidate is verified only if its own projected distance passes the same test. A better
candidate is missed with a chance of at most 1 - `SURE`.

The tree's upper levels are split at medians of a bounded sample (about `SAMPLE` rows) into cells of
about `ROWS_A_CELL` rows; its lower levels are built inside each cell. Every row is indexed.
Round one searches each query's own cell; round two sends it to just those cells which the
k-th distance found there does not rule out. Queries of near cells form a block, and only the cells
that some query of a block visits are copied to it. Cells meet queries by a shuffle on cell and block,
and answer with candidates that beat the k-th only. A task compares `QUERIES` queries with
`LEAVES` leaves at a time, so its memory is that of a cell and a block.

Equal vectors are one candidate, kept with its k + 1 smallest ids: no more of them can be among
the k nearest. Equal queries are searched once. So a vector that a third of all rows share
costs one row. What is broadcast is the tree: at most `MAX_CELLS` boxes.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
those whose length is not the most frequent one (the smaller of two as frequent); ids must be
unique, of rows repeated with id and vector one counts; a null id takes no part; with fewer
candidates all are returned; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.sources.shared import durable

DIMS, SURE = 24, 0.85
SAMPLE = 20_000
ROWS_A_CELL, LEAST_CELLS, MAX_CELLS = 1 << 16, 32, 1 << 16
QUERIES_A_BLOCK = 1 << 16
LEAF, LEAVES, QUERIES, PAIRS = 64, 8, 512, 1 << 15


def chance_within(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half, term = x / 2, np.ones_like(x)
    total = term.copy()
    for i in range(1, dims // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def reach(dims: int = DIMS, sure: float = SURE) -> float:
    """The squared projected distance, per squared distance, at which the test holds."""
    low, high = 0.0, 1e3
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chance_within(np.array([middle]), dims)[0] < sure else (low, middle)
    return high


@dataclass
class Space:
    """Projection of vectors whose squared length is at most `top`."""
    directions: np.ndarray
    top: float

    @classmethod
    def make(cls, dim: int, top: float, dims: int = DIMS, seed: int = 7) -> Space:
        return cls(np.random.default_rng(seed).standard_normal((dim + 1, dims)), top)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.top - np.einsum("nd,nd->n", x, x)))
        return x @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.directions[:-1]

    def squared(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distances for given inner products."""
        return np.maximum(1e-12, np.einsum("nd,nd->n", q, q) + self.top - 2 * score)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each box."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        p = points[:, j, None]
        out += np.maximum(0, np.maximum(low[:, j] - p, p - high[:, j])) ** 2
    return out


@dataclass
class Tree:
    """Splits of the upper levels: level by level, an axis and a value for each node."""
    axes: np.ndarray
    values: np.ndarray
    levels: int

    @classmethod
    def grow(cls, sample: np.ndarray, levels: int) -> Tree:
        axes, values = np.zeros(1 << levels, np.int64), np.zeros(1 << levels)
        parts = {1: sample}
        for node in range(1, 1 << levels):
            part = parts.pop(node)
            if len(part):
                axes[node] = int(np.argmax(np.ptp(part, axis=0)))
                values[node] = np.median(part[:, axes[node]])
            right = part[:, axes[node]] > values[node]
            parts[2 * node], parts[2 * node + 1] = part[~right], part[right]
        return cls(axes, values, levels)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + (points[rows, self.axes[node]] > self.values[node])
        return node - (1 << self.levels)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Lower levels of the tree: halves at medians down to leaves."""
    todo, done = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            done.append(own)
            continue
        axis = int(np.argmax(np.ptp(points[own], axis=0)))
        order = own[np.argpartition(points[own, axis], len(own) // 2)]
        todo += [order[:len(own) // 2], order[len(own) // 2:]]
    return done


def scores_of(x: np.ndarray, q: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Inner products of given pairs of rows and queries."""
    return np.concatenate([np.einsum("nd,nd->n", x[rows[i:i + PAIRS]], q[own[i:i + PAIRS]])
                           for i in range(0, len(rows), PAIRS)] or [np.zeros(0)])


def search(space: Space, x: np.ndarray, reps: np.ndarray, q: np.ndarray, least: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each query the k best rows of one cell (-1: none), their inner products, and how many
    pairs were verified.

    `least` is the k-th best inner product known so far; only rows that reach it are wanted.
    """
    order = np.argsort(reps)
    x = x[order]
    projected, asked = space.candidates(x), space.queries(q)
    parts = leaves(projected)
    low = np.stack([projected[p].min(axis=0) for p in parts])
    high = np.stack([projected[p].max(axis=0) for p in parts])
    limit = reach(space.directions.shape[1])
    rows, scores, verified = np.full((len(q), k), -1), np.full((len(q), k), -np.inf), 0
    for start in range(0, len(q), QUERIES):
        some = np.arange(start, min(start + QUERIES, len(q)))
        far = box_distances(asked[some], low, high)
        turn = np.argsort(far.mean(axis=0), kind="stable")
        kth = least[some].copy()
        for j in range(0, len(turn), LEAVES):
            bound = np.where(np.isfinite(kth), limit * space.squared(q[some], np.where(np.isfinite(kth), kth, 0)), np.inf)
            near = turn[j:j + LEAVES]
            live = np.nonzero(far[:, near].min(axis=1) < bound)[0]
            if not len(live):
                continue
            block = np.sort(np.concatenate([parts[i] for i in near]))
            p, a = projected[block], asked[some[live]]
            apart = (np.einsum("nd,nd->n", a, a)[:, None] + np.einsum("nd,nd->n", p, p) - 2 * (a @ p.T))
            own, cand = np.nonzero(apart < bound[live, None])
            own, cand = some[live[own]], block[cand]
            got = scores_of(x, q, cand, own)
            verified += len(got)
            hit = got >= kth[own - start]
            if not hit.any():
                continue
            changed, at = np.unique(own[hit], return_inverse=True)
            at = np.concatenate([np.repeat(np.arange(len(changed)), k), at])
            who = np.concatenate([rows[changed].ravel(), cand[hit]])
            both = np.concatenate([scores[changed].ravel(), got[hit]])
            best = np.lexsort((who, -both, at))
            at = at[best]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            best, at, place = (v[place < k] for v in (best, at, place))
            rows[changed[at], place], scores[changed[at], place] = who[best], both[best]
            kth[changed - start] = np.maximum(kth[changed - start], scores[changed, -1])
    return np.where(np.isfinite(scores), order[rows], -1), scores, verified


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(vec_id, vec) of the rows that take part, and their dimension."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           F.col(embedding).cast("array<double>").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
                    & F.forall("vec", finite) & F.exists("vec", lambda v: v != 0)))
    kind = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = kind["dim"] if kind else 1
    return rows.filter(F.size("vec") == dim), dim


def _home(space: Space, tree: Tree):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                points = space.candidates(matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.cell(points))],
                                                 ["rep", "ids", "vec", "cell"])
    return run


def _boxes(space: Space):
    """Corners of each batch's rows by cell."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            cells, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            if not len(cells):
                continue
            points = space.candidates(matrix(batch.column(1)))
            low = np.stack([points[at == i].min(axis=0) for i in range(len(cells))])
            high = np.stack([points[at == i].max(axis=0) for i in range(len(cells))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(low.tolist(), pa.list_(pa.float64())),
                 pa.array(high.tolist(), pa.list_(pa.float64()))], ["cell", "low", "high"])
    return run


def _homes(space: Space, boxes):
    """(query, vec, least, home): the nearest cell of each query."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, low, high = boxes.value
        for batch in rows:
            if batch.num_rows:
                far = box_distances(space.queries(matrix(batch.column(1))), low, high)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.argmin(far, axis=1))],
                                                 ["query", "vec", "least", "home"])
    return run


def _visits(space: Space, boxes, first: bool):
    """(query, vec, least, block, cell): the home cell, or all others that are not ruled out."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = boxes.value
        limit = reach(space.directions.shape[1])
        for batch in rows:
            if not batch.num_rows:
                continue
            at, to = np.arange(batch.num_rows), batch.column(4).to_numpy()
            if not first:
                q, least = matrix(batch.column(1)), batch.column(2).to_numpy()
                known = np.isfinite(least)
                bound = np.where(known, limit * space.squared(q, np.where(known, least, 0)), np.inf)
                open_ = box_distances(space.queries(q), low, high) < bound[:, None]
                open_[at, to] = False
                at, to = np.nonzero(open_)
            part = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(cells[to])],
                                             ["query", "vec", "least", "block", "cell"])
    return run


def blocked(queries: DataFrame, a_block: int) -> DataFrame:
    """Blocks of about `a_block` queries from the same or neighbouring home cells.

    Cells are laid out in tree order, each as long as it has queries; a hash places a query inside
    its cell, so one with many queries is cut into several blocks.
    """
    held = queries.groupBy("home").count()  # at most MAX_CELLS rows
    starts = held.select("home", F.col("count").alias("n"), (
        F.sum("count").over(Window.orderBy("home")) - F.col("count")).alias("at"))
    place = F.col("at") + F.pmod(F.xxhash64("query"), F.col("n"))
    return (queries.join(F.broadcast(starts), "home")
            .select("query", "vec", "least", F.floor(place / a_block).alias("block"), "home"))


def _answers(space: Space, k: int):
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = {"query": pa.int64(), "rep": pa.int64(), "ids": pa.list_(pa.int64()),
                 "score": pa.float64()}
        if not points.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        reps = points["rep"].to_numpy()
        rows, scores, _ = search(space, matrix(points["vec"]), reps, matrix(queries["vec"]),
                              queries["least"].to_numpy(), k)
        at, place = np.nonzero(rows >= 0)
        hit = rows[at, place]
        return pa.table({"query": queries["query"].to_numpy()[at], "rep": reps[hit],
                         "ids": points["ids"].combine_chunks().take(pa.array(hit)).cast(kinds["ids"]),
                         "score": scores[at, place]}, schema=pa.schema(list(kinds.items())))
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): up to k nearest others of each row that is a query."""
    spark = vectors.sparkSession
    rows, dim = usable(vectors, vec_id, embedding)
    by_id = Window.partitionBy("vec").orderBy("vec_id")
    classes = (rows.dropDuplicates(["vec", "vec_id"]).withColumn("_n", F.row_number().over(by_id))
               .filter(F.col("_n") <= k + 1).groupBy("vec")
               .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
               .select(F.element_at("ids", 1).alias("rep"), "ids", "vec"))
    classes = durable(classes)
    length = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    count, top = classes.agg(F.count(F.lit(1)), F.max(length)).first()
    space = Space.make(dim, (top or 1.0) * (1 + 1e-9))
    levels = math.ceil(math.log2(min(MAX_CELLS, max(LEAST_CELLS, count / ROWS_A_CELL))))
    share = int(min(1.0, SAMPLE / max(1, count)) * (1 << 30))
    picked = (classes.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < share)
              .select("vec").limit(2 * SAMPLE).toArrow())  # SAMPLE rows on average
    tree = Tree.grow(space.candidates(matrix(picked["vec"])) if count else np.zeros((0, DIMS)), levels)
    points = durable(classes.mapInArrow(
        _home(space, tree), "rep long, ids array<bigint>, vec array<double>, cell long"))
    corners = [F.array(*[f(F.col(c)[j]) for j in range(DIMS)]).alias(c)
               for c, f in (("low", F.min), ("high", F.max))]
    boxes = (points.select("cell", "vec").mapInArrow(
        _boxes(space), "cell long, low array<double>, high array<double>")
        .groupBy("cell").agg(*corners).orderBy("cell").toArrow())  # at most MAX_CELLS rows
    shared = spark.sparkContext.broadcast(
        (boxes["cell"].to_numpy(), matrix(boxes["low"]), matrix(boxes["high"])))

    asked = rows.filter(is_query).distinct().join(classes.select("rep", "vec"), "vec")
    asked = durable(asked.select("vec_id", "rep", "vec"))
    queries = (asked.groupBy("rep").agg(F.first("vec").alias("vec"))
               .select(F.col("rep").alias("query"), "vec", F.lit(float("-inf")).alias("least")))
    homes = queries.mapInArrow(_homes(space, shared), "query long, vec array<double>, least double, home long")
    queries = durable(blocked(durable(homes), QUERIES_A_BLOCK))

    def visit(wanted: DataFrame, first: bool) -> DataFrame:
        sent = durable(wanted.mapInArrow(
            _visits(space, shared, first), "query long, vec array<double>, least double, block long, cell long"))
        visited = sent.groupBy(F.col("cell").alias("at"), F.col("block").alias("block")).count()
        return (points.join(visited, F.col("cell") == F.col("at"))
                .select("rep", "ids", "vec", "cell", "block").groupBy("cell", "block")
                .cogroup(sent.groupBy("cell", "block"))
                .applyInArrow(_answers(space, k + 1), "query long, rep long, ids array<bigint>, score double"))

    near = durable(visit(queries, True))
    kth = (near.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
           .filter(F.col("n") > k))
    known = queries.drop("least").join(kth, "query", "left").select(
        "query", "vec", F.coalesce("least", F.lit(float("-inf"))).alias("least"), "block", "home")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = (near.union(visit(known, False)).withColumn("_n", F.row_number().over(best))
             .filter(F.col("_n") <= k + 1).select("query", "score", "ids"))
    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
            .join(found, "query").select("query_id", "score", F.explode("ids").alias("vec_id"))
            .filter("vec_id <> query_id").withColumn("rank", F.row_number().over(ordered))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
