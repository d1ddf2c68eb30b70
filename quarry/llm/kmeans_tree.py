"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

Vectors get one more component that makes their lengths equal, so that the
nearest in the tree's space has the largest inner product. The tree is fitted
on a sample of at most about ``SAMPLE`` vectors chosen by a hash of their
ids; every vector is put into a leaf. A query walks the tree best bin first:
a priority queue holds the nodes seen, by distance of their centroids, and
the nearest is opened next. How many leaves a query visits is calibrated:
for a few of the queries, chosen by a hash, the true neighbours over all rows are found by
brute force, and visits are widened until ``TARGET`` of these lie in visited
leaves. What a visited leaf holds is compared exactly, in double precision:
first in the nearest few leaves; the score of the last neighbour found there
is the least that a vector of the other leaves must reach to be passed on.

Leaves are split into parts of bounded size, and the queries of a leaf into
blocks, so no task's work grows with the largest leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32
from quarry.llm.common import checkpointed

#: Bound of the fitting sample, and vectors a leaf should hold on average (a sample of this size has a leaf for every 8 vectors at most).
SAMPLE, LEAF_ROWS, BRANCH = 20_000, 256, 8
#: Queries whose true neighbours calibrate the visits, and the share of these to be found.
PROBES, TARGET = 400, 0.95
#: Leaves that a query visits first.
NEAR = 4
#: Rows of a part of a leaf, and of a block of queries.
PART_ROWS, BLOCK_ROWS = 4096, 1024


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` (double) of the vectors that take part: no null, no component null or not finite, not all zero, an id."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(fine).filter(F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def lifted(x: np.ndarray, radius: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(radius * radius - (x * x).sum(axis=1), 0))]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        of = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        centres = np.stack([x[of == j].mean(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))])
    return np.unique(centres, axis=0)


class Tree:
    """Children of each node (none: a leaf) and the centroid of each node; node 0 is the root."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.radius = float(np.sqrt((sample * sample).sum(axis=1).max())) if len(sample) else 1.0
        rng = np.random.default_rng(7)
        points = lifted(sample, self.radius)
        self.centres, self.children = [points.mean(axis=0)], [[]]
        open_ = [(-len(points), 0, np.arange(len(points)))]
        n_leaves = 1
        while open_ and n_leaves < leaves:  # the fullest leaf is divided next
            size, node, own = heapq.heappop(open_)
            k = min(BRANCH, leaves - n_leaves + 1)
            if -size < 2 * k:
                break
            centres = _kmeans(points[own], k, rng)
            if len(centres) < 2:
                continue
            of = ((centres * centres).sum(axis=1) - 2 * points[own] @ centres.T).argmin(axis=1)
            for j, c in enumerate(centres):
                self.children[node].append(len(self.centres))
                self.centres.append(c)
                self.children.append([])
                heapq.heappush(open_, (-int((of == j).sum()), len(self.centres) - 1, own[of == j]))
            n_leaves += len(centres) - 1
        self.centres = np.stack(self.centres)
        self.square = (self.centres * self.centres).sum(axis=1)
        self.n_leaves = sum(1 for c in self.children if not c)

    @classmethod
    def of(cls, state: dict) -> Tree:
        """The tree with this state: plain data travel to the tasks."""
        tree = cls.__new__(cls)
        tree.__dict__.update(state)
        return tree

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every node."""
        points, at = lifted(x, self.radius), np.zeros(len(x), np.int64)
        moving = np.arange(len(x))
        while len(moving):
            for node in np.unique(at[moving]).tolist():
                kids = self.children[node]
                if kids:
                    own = moving[at[moving] == node]
                    at[own] = np.array(kids)[(self.square[kids] - 2 * points[own] @ self.centres[kids].T).argmin(axis=1)]
            moving = moving[[bool(self.children[n]) for n in at[moving].tolist()]]
        return at

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of a best-bin-first walk."""
        q = np.r_[query / np.linalg.norm(query) * self.radius, 0.0]
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(node)
                continue
            for d, kid in zip((self.square[kids] - 2 * self.centres[kids] @ q).tolist(), kids):
                heapq.heappush(queue, (d, kid))
        return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, largest first; ``ids`` ascend, so ties go to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.argsort(-scores[some], kind="stable")][:k]
    return np.argsort(-scores, kind="stable")


def _top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, least: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """The ``k`` best of the candidates for each query, its own id and scores under ``least`` left out."""
    by = np.argsort(ids, kind="stable")
    ids, x = ids[by], x[by]
    out = []
    for at in range(0, len(q), 128):
        for n, (i, scores) in enumerate(zip(q_ids[at:at + 128].tolist(), q[at:at + 128] @ x.T), at):
            scores[ids == i] = -np.inf
            if least is not None:
                scores[scores < least[n]] = -np.inf
                if scores.max(initial=-np.inf) == -np.inf:
                    continue
            out += [(i, int(ids[p]), float(scores[p])) for p in best(scores, ids, k).tolist() if scores[p] > -np.inf]
    return out


RESULT = "query_id bigint, vec_id bigint, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query's candidates; of these there are ``k`` for each part visited."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """True neighbours of a bounded set of queries over all rows, block by block."""
    shared = vectors.sparkSession.sparkContext.broadcast((q_ids, q))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                rows = _top(*shared.value, np.asarray(part.column("vec_id")), _matrix(part.column("v")), k)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return _ranked(vectors.mapInArrow(kernel, RESULT), k)


def search(vectors: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best found for each row where the SQL condition ``is_query`` on ``vec_id`` holds.

    Candidates are all rows but those with the query's id. Null ids, null and
    zero vectors and those with a null or non-finite component take no part,
    nor do vectors of another length than most (the longest, if tied); repeated
    rows count once; ties go to the smaller id; with few candidates there are
    fewer ranks; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, total = rows.filter(F.size("v") == lengths["d"]), lengths["count"]
    chance = md5_u32(F.concat(F.lit("tree:"), F.col("vec_id").cast("string"))) / F.lit(2.0**32)
    sample = rows.withColumn("chance", chance).filter(F.col("chance") < min(1.0, SAMPLE / total)).toPandas().sort_values(["chance", "vec_id"], ignore_index=True)
    if not len(sample):
        sample = rows.orderBy("vec_id").limit(1).toPandas()
    points = np.stack(sample["v"]).astype(np.float64)
    tree = Tree(points, max(1, min(total // LEAF_ROWS, len(points) // 8)))
    shared = spark.sparkContext.broadcast(vars(tree))

    # Visits: until the target share of the probes' true neighbours lies in visited leaves.
    drawn = rows.filter(is_query).withColumn("chance", chance).orderBy("chance", "vec_id").limit(PROBES).toPandas()
    probe_ids = drawn["vec_id"].to_numpy(np.int64)
    probes = np.stack(drawn["v"]).astype(np.float64) if len(drawn) else points[:0]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tree.of(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(held.leaf(_matrix(batch.column("v"))))], names=["vec_id", "v", "leaf"])

    indexed = checkpointed(rows.mapInArrow(put, "vec_id bigint, v array<double>, leaf bigint"))
    true = brute_force(rows, probe_ids, probes, k).join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()  # PROBES * k rows
    order = {i: {leaf: at for at, leaf in enumerate(tree.visit(p, tree.n_leaves))} for i, p in zip(probe_ids.tolist(), probes)}
    needed = np.sort([order[i][leaf] + 1 for i, leaf in true.itertuples(index=False)]) if len(true) else np.array([1])
    visits = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tree.of(shared.value)
        for batch in batches:
            leaves = [held.visit(q, visits) for q in _matrix(batch.column("v"))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaves, pa.list_(pa.int64()))], names=["query_id", "q", "leaves"])  # nearest first

    queries = rows.filter(is_query).mapInArrow(walk, "query_id bigint, q array<double>, leaves array<bigint>").select("query_id", "q", F.posexplode("leaves").alias("turn", "leaf"))
    queries = checkpointed(queries)
    n_parts = checkpointed(indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("parts")))

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        rows = _top(q["query_id"].to_numpy(), np.stack(q["q"]), c["vec_id"].to_numpy(), np.stack(c["v"]), k, q["least"].to_numpy())
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": np.int64, "vec_id": np.int64, "score": np.float64})

    def candidates(asked: DataFrame) -> DataFrame:
        """What the leaves hold for ``query_id, q, leaf, least``."""
        n_blocks = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks"))
        shape = F.broadcast(n_parts.join(n_blocks, "leaf"))  # a row for each leaf: at most SAMPLE / 8
        left = asked.join(shape, "leaf").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        right = indexed.join(shape, "leaf").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cell = ["leaf", "part", "block"]
        return left.select(*cell, "query_id", "q", "least").groupBy(*cell).cogroup(right.select(*cell, "vec_id", "v").groupBy(*cell)).applyInPandas(compare, RESULT)

    first = checkpointed(_ranked(candidates(queries.filter(F.col("turn") < NEAR).withColumn("least", F.lit(float("-inf")))), k))
    least = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    others = queries.filter(F.col("turn") >= NEAR).join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    return _ranked(first.drop("rank").union(candidates(others)), k)
