"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Each tree splits a bounded sample by hyperplanes between two random points until its leaves are
small; vectors are lengthened to equal norm first, so the nearest by angle is the largest inner
product. Every vector is filed under one leaf of each tree. A query walks all trees at once through
one shared priority queue (the node with the best worst margin first) until it has asked PROBES
leaves; the vectors of those leaves are then ranked by their exact inner product.

Equal vectors are one entry with their smallest ids (as many as any answer can hold), so a very
common vector fills no leaf. A leaf's entries are dealt over parts of bounded size, and each part
answers its queries with the best few only.

Defined cases: vectors that are null, empty, of another length than most, zero, or that hold a null
or non-finite component neither ask nor answer; a null id takes no part; a repeated id with equal vectors answers
once, with different vectors its best counts; an empty table gives no rows; fewer candidates than k
give fewer rows. Only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headroom.llm.text import small_sample, table, written

K = 20
QUERIES = 20
TREES = 8
#: Vectors on which the trees are grown, and sample vectors in a leaf.
SAMPLE = 20_000
LEAF = 256
#: Leaves that a query asks, over all trees.
PROBES = 128
#: Entries of a leaf in one part.
PART = 2_048
SEED = 11


class Tree(NamedTuple):
    """Inner nodes: plane and cut; children as node numbers, or -1 - leaf."""

    plane: np.ndarray
    cut: np.ndarray
    child: np.ndarray


def grow(x: np.ndarray, seed: int) -> Tree:
    rng = np.random.default_rng(seed)
    planes, cuts, children, leaves = [], [], [], 0
    root = [None]
    todo = [(np.arange(len(x)), root, 0)]
    while todo:
        rows, parent, side = todo.pop()
        plane = None
        if len(rows) > LEAF:
            a, b = x[rng.choice(rows, 2, replace=False)]
            plane = (a - b) / max(1e-12, np.linalg.norm(a - b))
            value = x[rows] @ plane
            cut = np.median(value)
            if not (value < cut).any():
                plane = None
        if plane is None:
            parent[side] = -1 - leaves
            leaves += 1
            continue
        parent[side] = len(planes)
        node = [None, None]
        planes.append(plane)
        cuts.append(cut)
        children.append(node)
        todo += [(rows[value < cut], node, 0), (rows[value >= cut], node, 1)]
    return Tree(np.array(planes).reshape(-1, x.shape[1]), np.array(cuts), np.array(children, int).reshape(-1, 2))


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(len(x), int) if len(tree.cut) else np.full(len(x), -1)
    while (live := np.flatnonzero(at >= 0)).size:
        node = at[live]
        right = np.einsum("ij,ij->i", x[live], tree.plane[node]) >= tree.cut[node]
        at[live] = tree.child[node, right.astype(int)]
    return -1 - at


def probe(trees: list[Tree], x: np.ndarray, probes: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the best leaves of all trees for one vector, through one queue."""
    margin = [t.plane @ x - t.cut for t in trees]
    queue = [(-np.inf, k, 0 if len(t.cut) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out = []
    while queue and len(out) < probes:
        worst, k, node = heapq.heappop(queue)
        if node < 0:
            out.append((k, -1 - node))
            continue
        m = margin[k][node]
        left, right = trees[k].child[node]
        heapq.heappush(queue, (max(worst, m), k, int(left)))
        heapq.heappush(queue, (max(worst, -m), k, int(right)))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _best(filed: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """Each query's k nearest ids among the entries of one part."""
    near = _matrix(asked.column("q")) @ _matrix(filed.column("v")).T
    ids = filed.column("ids").combine_chunks()
    entry = np.repeat(np.arange(len(ids)), ids.value_lengths().to_numpy())
    ids, queries, out = ids.flatten().to_numpy(), asked.column("query").to_numpy(), []
    for query, score in zip(queries, near, strict=True):
        own = score[entry]
        at = np.flatnonzero(ids != query)
        if len(at) > k:
            at = at[own[at] >= np.partition(own[at], len(at) - k)[len(at) - k]]
        out.append(at[np.lexsort((ids[at], -own[at]))][:k])
    row, at = np.repeat(np.arange(len(out)), [len(x) for x in out]), np.concatenate(out)
    return pa.table({"query_id": queries[row], "vec_id": ids[at], "score": near[row, entry[at]]})


def search(rows: DataFrame, *, id: str = "vec_id", vector: str = "embedding", k: int = K, every: int = QUERIES, probes: int = PROBES) -> DataFrame:  # noqa: A002
    """``query_id, rank, vec_id, score``: the k nearest of the rows whose id is divisible by ``every``."""
    spark = rows.sparkSession
    kind = rows.schema[vector].dataType.simpleString()
    own = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).filter("id is not null and v is not null")
    own = own.filter("forall(v, e -> e is not null and not isnan(e) and abs(e) < double('infinity')) and exists(v, e -> e <> 0)").distinct()
    size = own.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = own.filter(F.size("v") == size["size"])
    least = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = own.withColumn("nth", least).filter(F.col("nth") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = written(entries, "ann-entries")
    norm = F.expr("sqrt(aggregate(v, 0D, (s, e) -> s + cast(e as double) * e))")
    stats = entries.agg(F.max(norm).alias("norm"), F.count("*").alias("n")).first()
    longest = stats["norm"]

    def lengthen(x: np.ndarray) -> np.ndarray:
        return np.concatenate((x, np.sqrt(np.maximum(0, longest ** 2 - (x * x).sum(axis=1)))[:, None]), axis=1)

    points = lengthen(_matrix(small_sample(entries, SAMPLE, stats["n"], "ann", "v").select("v").toArrow().column("v")))
    points = points[np.lexsort(points.T)]
    shared = spark.sparkContext.broadcast([grow(points, SEED + i) for i in range(TREES)])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                x = lengthen(_matrix(part.column("v")))
                for t, tree in enumerate(shared.value):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(leaf_of(tree, x).astype(np.int32)),
                                                      part.column("v"), part.column("ids")], names=["tree", "leaf", "v", "ids"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [probe(shared.value, np.append(row, 0.0), probes) for row in _matrix(part.column("v"))]
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                flat = np.array([p for f in found for p in f], np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1]), part.column("id").take(at), part.column("v").take(at)],
                                                 names=["tree", "leaf", "query", "q"])

    leaf = ["tree", "leaf"]
    filed = written(entries.mapInArrow(file, f"tree int, leaf int, v {kind}, ids array<bigint>"), "ann-index")
    asked = written(own.filter(F.pmod("id", F.lit(every)) == 0).select("id", "v").mapInArrow(ask, f"tree int, leaf int, query bigint, q {kind}"), "ann-probes")
    sizes = filed.groupBy(*leaf).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    sizes = sizes.join(asked.groupBy(*leaf).agg(F.ceil(F.count("*") / PART).cast("int").alias("turns")), leaf)
    filed = (filed.join(sizes, leaf).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("parts", "turns"))
    asked = (asked.join(sizes, leaf).withColumn("turn", F.pmod(F.xxhash64("query"), F.col("turns")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "turns"))
    cell = [*leaf, "part", "turn"]
    found = (filed.groupBy(*cell).cogroup(asked.groupBy(*cell))
             .applyInArrow(lambda f, a: _best(f, a, k) if f.num_rows and a.num_rows else _NOTHING, "query_id bigint, vec_id bigint, score double"))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", nth).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


_NOTHING = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def op9_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, among all rows."""
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
