"""Nearest neighbours by stable projections and a kd-tree.

All vectors are projected to a few dimensions by one Gaussian matrix. Median splits of the
projections of a bounded sample (about ``SAMPLE`` rows) cut the space into cells, ``CELLS`` at
most; every row belongs to one cell, and a cell of more than ``BLOCK_ROWS`` rows is dealt by hash
into blocks. A task takes a block's rows, builds a kd-tree over their projections and lets the
queries stream past. A query visits leaves in order of projected distance, computing exact
distances of their rows. With m dimensions the squared ratio of projected to true distance is
chi-square with m degrees of freedom. The search of a block ends when a row closer than the
k-th best found would have had a projected distance below that of all unseen leaves with
probability ``sure``. Each query first searches its own block; by the k-th distance found there
the same test tells which cells' boxes it need not visit, and it goes to the blocks of the others.
The best of all blocks are merged per query. A block is sent once for each ``CHUNK_QUERIES``
of the queries that visit it.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no
part. Rows that share an id are one vector, the smallest. Vectors of another length than
the query are no candidates. Ties go to the smaller id; with fewer than k candidates all
are returned. Without queries or rows the result is empty.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import hash_share
from tallymill.llm.vectors import by_length, matrix, usable
from tallymill.session import materialise

DIMENSIONS, LEAF = 8, 64
BLOCK_ROWS, CHUNK_QUERIES = 8_192, 32_768
SAMPLE, CELLS = 65_536, 4_096


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = math.exp(-x / 2)
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - total


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < p else (low, middle)
    return high


class Tree:
    """A kd-tree: nodes split their rows at the median of the widest dimension, down to leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.below: list[tuple[int, int] | np.ndarray] = []  # two nodes, or the rows of a leaf
        if len(points):
            self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.boxes)
        part = self.points[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.boxes.append((low, high))
        self.below.append(rows)
        if len(rows) > self.leaf:
            order = np.argpartition(part[:, (high - low).argmax()], len(rows) // 2)
            half = len(rows) // 2
            self.below[at] = self._build(rows[order[:half]]), self._build(rows[order[half:]])
        return at

    def bound(self, node: int, point: np.ndarray) -> float:
        """Squared distance to the node's box."""
        low, high = self.boxes[node]
        off = np.maximum(np.maximum(low - point, point - high), 0.0)
        return float(off @ off)

    def leaves(self, point: np.ndarray):
        """Leaves by rising projected distance: (squared distance, rows)."""
        heap = [(self.bound(0, point), 0)] if self.boxes else []
        while heap:
            bound, node = heapq.heappop(heap)
            below = self.below[node]
            if isinstance(below, tuple):
                for child in below:
                    heapq.heappush(heap, (max(bound, self.bound(child, point)), child))
            else:
                yield bound, below


def slack(point: np.ndarray) -> float:
    """What rounding may add to a squared projected distance, so that copies stay at distance 0."""
    return 1e-12 * float(point @ point)


def search(
    tree: Tree, vectors: np.ndarray, ids: np.ndarray, point: np.ndarray, query: np.ndarray, query_id: int, k: int, quantile: float, radius: float = math.inf
):
    """The k nearest found within ``radius``, which may be infinite: ids and distances, nearest first, ties by id."""
    best_d, best_i = np.empty(0), np.empty(0, np.int64)
    most = radius * radius * (1 + 1e-9)  # a root and its square may differ in the last place
    for bound, rows in tree.leaves(point):
        if bound > quantile * most + slack(point):
            break
        rows = rows[ids[rows] != query_id]
        off = vectors[rows] - query
        d, i = (off * off).sum(axis=1), ids[rows]
        near = d <= most
        if near.any():
            d, i = np.concatenate([best_d, d[near]]), np.concatenate([best_i, i[near]])
            order = np.lexsort((i, d))[:k]
            best_d, best_i = d[order], i[order]
            if len(best_d) == k:
                most = min(most, best_d[-1])
    return best_i, np.sqrt(best_d)


def projection(seed: int, length: int) -> np.ndarray:
    return np.random.default_rng([seed, length]).normal(size=(length, DIMENSIONS))


class Splits:
    """Median splits of points down to 2^depth cells, each along the widest dimension of its points."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(2**depth, np.int64)
        self.value = np.zeros(2**depth)
        parts = {1: points}
        for node in range(1, 2**depth):  # the nodes below node n are 2n and 2n + 1
            part = parts.pop(node)
            if len(part):
                self.axis[node] = (part.max(axis=0) - part.min(axis=0)).argmax()
                self.value[node] = np.median(part[:, self.axis[node]])
            above = part[:, self.axis[node]] > self.value[node]
            parts[2 * node], parts[2 * node + 1] = part[~above], part[above]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            above = points[np.arange(len(points)), self.axis[node]] > self.value[node]
            node = 2 * node + above
        return node


def learn_splits(rows: DataFrame, total: int, seed: int) -> dict[int, Splits]:
    """Splits by vector length, from the sample; lengths too rare for two blocks have none.

    The driver gets the projections of the sample, not its vectors.
    """

    def project(batches):
        for batch in batches:
            length = np.zeros(batch.num_rows, np.int64)
            points = np.zeros((batch.num_rows, DIMENSIONS))
            for part in by_length(batch.column("v")) if batch.num_rows else []:
                x = matrix(batch.column("v").take(pa.array(part)))
                length[part], points[part] = x.shape[1], x @ projection(seed, x.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(length), *map(pa.array, points.T)], names=["length", *names])

    names = [f"p{i}" for i in range(DIMENSIONS)]
    sample = rows.where(hash_share(F.col("vec_id"), SAMPLE / max(1, total))).select("v")
    found = sample.mapInArrow(project, ", ".join(["length long", *(f"{n} double" for n in names)])).toArrow()
    length, points = found.column("length").to_numpy(), np.stack([found.column(n).to_numpy() for n in names], axis=1)
    splits = {}
    for n in np.unique(length).tolist():
        cells = min(CELLS, total / BLOCK_ROWS) * float((length == n).mean())
        if cells > 1:
            splits[n] = Splits(points[length == n], math.ceil(math.log2(cells)))
    return splits


BLOCK = ["length", "cell", "block"]


def in_cells(rows: DataFrame, splits: dict[int, Splits], seed: int) -> DataFrame:
    """vec_id, v, length, cell and p (the projection, where the length has splits)."""

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            length = np.zeros(batch.num_rows, np.int64)
            cell = np.zeros(batch.num_rows, np.int64)
            points: list = [None] * batch.num_rows
            for part in by_length(column) if batch.num_rows else []:
                x = matrix(column.take(pa.array(part)))
                length[part] = x.shape[1]
                if x.shape[1] in splits:
                    p = x @ projection(seed, x.shape[1])
                    cell[part] = splits[x.shape[1]].cells(p)
                    for i, point in zip(part, p.tolist()):
                        points[i] = point
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), column, pa.array(length), pa.array(cell), pa.array(points, pa.list_(pa.float64()))],
                names=["vec_id", "v", "length", "cell", "p"],
            )

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v binary, length long, cell long, p array<double>")


def allowed_cells(asked: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], seed: int, quantile: float) -> DataFrame:
    """``asked`` (query_id, v, length, cell, block, radius) with ``cells``: those that the radius does not rule out."""

    def run(batches):
        for batch in batches:
            out = []
            for v, radius in zip(batch.column("v").to_pylist(), batch.column("radius").to_pylist()):
                query = np.frombuffer(v, np.float64)
                if len(query) not in boxes:
                    out.append([0])
                    continue
                cells, low, high = boxes[len(query)]
                point = query @ projections(len(query))
                off = np.maximum(np.maximum(low - point, point - high), 0.0)
                most = quantile * radius * radius * (1 + 1e-9) + slack(point)
                out.append(cells[(off * off).sum(axis=1) <= most].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])

    known: dict[int, np.ndarray] = {}

    def projections(length: int) -> np.ndarray:
        if length not in known:
            known[length] = projection(seed, length)
        return known[length]

    schema = "query_id long, v binary, length long, cell long, block long, radius double, cells array<long>"
    return asked.mapInArrow(run, schema)


def searched(base: DataFrame, asked: DataFrame, k: int, quantile: float, seed: int) -> DataFrame:
    """query_id, vec_id, score: the nearest found of each query in the blocks it is sent to.

    ``base`` and ``asked`` share the columns of BLOCK and ``chunk``. A block's rows come first, so a
    task holds them and one batch of queries.
    """
    key = [*BLOCK, "chunk"]
    both = base.select(*key, F.lit(0).alias("side"), F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("radius"))
    both = both.unionByName(asked.select(*key, F.lit(1).alias("side"), F.col("query_id").alias("id"), "v", "radius"))

    def run(batches):
        now, x, ids, tree, project = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*key, "side")], axis=1)
            starts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for at, end in zip(starts, starts[1:]):
                part, mark = batch.slice(at, end - at), tuple(marks[at])
                if mark[:-1] != now:
                    now, x, ids, tree = mark[:-1], [], [], None
                    project = projection(seed, int(mark[0]))
                own, own_ids = matrix(part.column("v")), part.column("id").to_numpy()
                if mark[-1] == 0:
                    x.append(own)
                    ids.append(own_ids)
                    continue
                if not x:
                    continue
                if tree is None:
                    x, ids = [np.concatenate(x)], [np.concatenate(ids)]
                    tree = Tree(x[0] @ project)
                out: list[list] = [[], [], []]
                radii = part.column("radius").to_pylist()
                for query_id, query, point, radius in zip(own_ids.tolist(), own, own @ project, radii):
                    i, d = search(tree, x[0], ids[0], point, query, query_id, k, quantile, radius)
                    out[0] += [query_id] * len(i)
                    out[1] += i.tolist()
                    out[2] += d.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    sorted_rows = both.repartition(*key).sortWithinPartitions(*key, "side")
    return sorted_rows.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, sure: float = 0.995, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest rows of each query row of ``vectors``."""
    rows = materialise(usable(vectors), "ann-rows")
    quantile = chi_square_quantile(sure, DIMENSIONS)
    splits = learn_splits(rows, rows.count(), seed)
    placed = in_cells(rows, splits, seed)
    sides = [f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(DIMENSIONS)]
    cells = materialise(placed.groupBy("length", "cell").agg(F.count("*").alias("n"), *sides), "ann-cells")
    boxes = {}
    for length in splits:
        own = cells.where(F.col("length") == length).toArrow()  # CELLS at most
        low, high = (np.stack([own.column(f"{n}{i}").to_numpy() for i in range(DIMENSIONS)], axis=1) for n in ("low", "high"))
        boxes[length] = own.column("cell").to_numpy(), low, high
    blocks = cells.select("length", "cell", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
    own_block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block")
    base = placed.join(blocks, ["length", "cell"]).select("vec_id", "v", "length", "cell", own_block)
    asked = base.where(is_query).withColumnRenamed("vec_id", "query_id")

    one = F.lit(0).cast("long").alias("chunk")
    everywhere = F.lit(float("inf")).alias("radius")
    first = materialise(searched(base.select("*", one), asked.select("*", one, everywhere), k, quantile, seed), "ann-first")
    radius = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).alias("radius"))
    asked = asked.join(radius, "query_id", "left").withColumn("radius", F.coalesce("radius", everywhere))

    sent = allowed_cells(asked, boxes, seed, quantile).withColumnsRenamed({"cell": "own_cell", "block": "own_block"})
    sent = sent.withColumn("cell", F.explode("cells")).join(blocks, ["length", "cell"])
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sent = sent.where((F.col("cell") != F.col("own_cell")) | (F.col("block") != F.col("own_block")))
    chunks = sent.groupBy(*BLOCK).agg(F.ceil(F.count("*") / CHUNK_QUERIES).alias("chunks"))
    chunks = materialise(chunks, "ann-chunks")
    chunk = F.pmod(F.xxhash64("query_id"), F.col("chunks")).alias("chunk")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    again = searched(base.join(chunks, BLOCK).select("*", copies), sent.join(chunks, BLOCK).select("*", chunk), k, quantile, seed)

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = first.unionByName(again).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
