"""Vector code compression: product codes trained by Lloyd rounds over cover trees.

A vector's components become integers and are cut into equal parts; each part
is replaced by the index of the nearest entry of that part's codebook. The
codebooks are trained by Lloyd rounds. To assign a block of vectors, a cover
tree is grown over each of its parts once, inside the task that holds the
block: the centres of a node's children cover its points within half its
radius and lie further apart than that. The tree's order makes every subtree one run,
so cumulative sums along that order give the sum of any subtree. An assignment
starts at the root: by the triangle inequality, a node whose nearest entry
leads every other by more than twice its radius goes to that entry whole, sum
and count included. Only nodes that are ambiguous descend, at last to exact
comparisons of their points. Distances are integers, so results do not depend on how rows
are partitioned.

Trees are written once to the shared folder and read again by each round; a
lost executor costs the blocks it was working on. What reaches the driver is
one row for each entry component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from quarry.llm.common import written
from quarry.plans.joins import null_safe_join
from quarry.plans.parallel import spread

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: A component is multiplied by this before it is floored.
SCALE = 256
#: Vectors of one block; it has a tree for each part.
BLOCK = 8192
#: A node of at most so many points is not split further.
LEAF = 12
#: Children that cover a node by distance; what none of them covers goes to the nearest, so that parts of many components cost no more.
MOST_CHILDREN = 48
DEEPEST = 24
#: Share by which float square roots may be off when a whole subtree is decided.
SLACK = 1e-9


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions from each start to its end, in order."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def _starts(labels: np.ndarray) -> np.ndarray:
    """Where runs of equal labels begin."""
    return np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]]))


def _split(points: np.ndarray, own: np.ndarray, owner: np.ndarray, centres: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child of each of the points ``own``, which lie node by node (``owner``), and the centre of each child.

    All nodes pick one centre at a time: their own first, then the first point not yet within
    ``limit`` (squared) of a centre.
    """
    child, nearest, best = np.full(len(own), -1), np.zeros(len(own), np.int64), np.full(len(own), np.inf)
    todo, picked, count = np.arange(len(own)), [], 0
    for step in range(MOST_CHILDREN):
        if not len(todo):
            break
        first = _starts(owner[todo])
        pick = centres[owner[todo[first]]] if step == 0 else own[todo[first]]
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(todo))))
        far = ((points[own[todo]] - points[pick[group]]) ** 2).sum(axis=1)
        closer = far < best[todo]
        best[todo[closer]], nearest[todo[closer]] = far[closer], count + group[closer]
        within = far <= limit[owner[todo]]
        child[todo[within]] = count + group[within]
        todo = todo[~within]
        picked.append(pick)
        count += len(pick)
    child[todo] = nearest[todo]
    return child, np.concatenate(picked)


def grow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cover tree over the rows of ``points`` (integers): tree order, nodes and their radii.

    A node is ``start, end`` in tree order, its centre's row, and its children ``from, to`` among the nodes.
    """
    order = np.arange(len(points))
    away = lambda rows, centre: np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1).astype(np.float64))
    nodes, radii = [np.array([[0, len(points), 0, 0, 0]])], [np.array([away(order, np.zeros_like(order)).max()])]
    total = 1
    for _ in range(DEEPEST):
        level, radius = nodes[-1], radii[-1]
        split = np.flatnonzero((level[:, 1] - level[:, 0] > LEAF) & (radius > 0))
        if not len(split):
            break
        place = _runs(level[split, 0], level[split, 1])
        owner = np.repeat(np.arange(len(split)), level[split, 1] - level[split, 0])
        child, centres = _split(points, order[place], owner, level[split, 2], (radius[split] / 2) ** 2)
        sort = np.lexsort((child, owner))
        order[place] = order[place][sort]
        child, first = child[sort], _starts(child[sort])
        size = np.diff(np.append(first, len(child)))
        below = np.zeros((len(first), 5), np.int64)
        below[:, 0], below[:, 1], below[:, 2] = place[first], place[first] + size, centres[child[first]]
        parents = owner[first]
        level[split, 3] = total + np.searchsorted(parents, np.arange(len(split)))
        level[split, 4] = total + np.searchsorted(parents, np.arange(len(split)), "right")
        nodes.append(below)
        radii.append(np.maximum.reduceat(away(order[place], np.repeat(below[:, 2], size)), first))
        total += len(below)
    return order, np.concatenate(nodes), np.concatenate(radii)


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, exact; in floats (and BLAS) where those hold them."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if points.shape[1] * 4 * most * most < 2**53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]


def assign(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower index) of each point, and each entry's sum and count over its points."""
    order, nodes, radii = tree
    distinct = np.sort(np.unique(entries, axis=0, return_index=True)[1])  # of equal entries only the first can win
    choice = entries[distinct]
    along = points[order]
    upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(along, axis=0)])
    code = np.zeros(len(points), np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    level = np.array([0])
    while len(level):
        node, radius = nodes[level], radii[level]
        squares = _squares(points[node[:, 2]], choice)
        nearest = squares.argmin(axis=1)
        lead = np.full(len(level), np.inf)
        if len(choice) > 1:
            two = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(np.float64))
            lead = two[:, 1] - two[:, 0] - SLACK * two[:, 1]
        whole = (lead > 2 * radius * (1 + SLACK)) | (radius == 0)
        done, entry = node[whole], distinct[nearest[whole]]
        code[_runs(done[:, 0], done[:, 1])] = np.repeat(entry, done[:, 1] - done[:, 0])
        np.add.at(sums, entry, upto[done[:, 1]] - upto[done[:, 0]])
        np.add.at(counts, entry, done[:, 1] - done[:, 0])
        rest = node[~whole]
        leaf = rest[rest[:, 3] == rest[:, 4]]
        if len(leaf):
            place = _runs(leaf[:, 0], leaf[:, 1])
            exact = distinct[_squares(along[place], choice).argmin(axis=1)]
            code[place] = exact
            np.add.at(sums, exact, along[place])
            np.add.at(counts, exact, 1)
        inner = rest[rest[:, 3] < rest[:, 4]]
        level = _runs(inner[:, 3], inner[:, 4])
    back = np.empty_like(code)
    back[order] = code
    return back, sums, counts


_BLOCK = StructType([
    StructField("ids", ArrayType(LongType())), StructField("labels", ArrayType(StringType())), StructField("points", BinaryType()),
    *(StructField(f, ArrayType(BinaryType())) for f in ("orders", "nodes", "radii")),
])


def _blocks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """One row for each ``BLOCK`` vectors of a partition, with their trees."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks])
            points = np.floor(SCALE * values).astype(np.int64).reshape(-1, parts, width)
            trees = [grow(np.ascontiguousarray(points[:, p])) for p in range(parts)]
            packed = [[t[0].astype(np.int32).tobytes() for t in trees], [t[1].astype(np.int32).tobytes() for t in trees], [t[2].tobytes() for t in trees]]
            columns = [table.column("vec_id").to_pylist()], [table.column("label").to_pylist()], [points.astype(np.int32).tobytes()], *([x] for x in packed)
            types = pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), *[pa.list_(pa.binary())] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_BLOCK.names)

        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, BLOCK - size)
                batch = batch.slice(piece.num_rows)
                held.append(piece)
                size += piece.num_rows
                if size == BLOCK:
                    yield row(held)
                    held, size = [], 0
        if size:
            yield row(held)

    return written(spread(kept).mapInArrow(build, _BLOCK), "code-blocks")


def _opened(batch: pa.RecordBatch, width: int, parts: int) -> Iterator[tuple[int, np.ndarray, list]]:
    """Row, points and trees of each block."""
    for i in range(batch.num_rows):
        read = lambda name, kind: [np.frombuffer(x, kind) for x in batch.column(name)[i].as_py()]  # noqa: B023, E731
        points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).astype(np.int64).reshape(-1, parts, width)
        yield i, points, list(zip(read("orders", np.int32), [x.reshape(-1, 5).astype(np.int64) for x in read("nodes", np.int32)], read("radii", np.float64)))


def _retrained(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one Lloyd round: floored means; an entry without points stays."""
    parts, entries, width = books.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for _, points, trees in _opened(batch, width, parts):
                for p, tree in enumerate(trees):
                    _, own, count = assign(points[:, p], tree, books[p])
                    sums[p, :, :width] += own
                    sums[p, :, width] += count
        slots = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(sums.reshape(-1)[slots], pa.int64())], names=["slot", "total"])

    got = blocks.mapInArrow(totals, "slot bigint, total bigint").groupBy("slot").agg(F.sum("total").alias("total")).toArrow()
    sums = np.zeros(parts * entries * (width + 1), np.int64)
    sums[got.column("slot").to_numpy()] = got.column("total").to_numpy()
    sums = sums.reshape(parts, entries, width + 1)
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray] | None:
    """Blocks with their trees, and the trained codebooks ``[part, entry, component]``; None where no vector takes part.

    See :func:`compress` for which vectors take part. The codebooks start as
    the parts of the ``entries`` smallest ids (null last; rows of one id by their components).
    """
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = every.filter(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    found = finite.filter((F.size("v") > 0) & (F.size("v") % parts == 0)).groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).orderBy(F.desc("n"), F.desc("size")).first()
    if found is None:
        return None
    if SCALE * found["most"] >= math.isqrt(2**62 // found["size"]) // 2:
        raise ValueError(f"components up to {found['most']:g}: squared distances would pass 64 bits")
    width = found["size"] // parts
    kept = finite.filter(F.size("v") == found["size"])
    least = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    books = np.floor(SCALE * np.array([r["v"] for r in least])).astype(np.int64).reshape(-1, parts, width).transpose(1, 0, 2)
    blocks = _blocks(kept, width, parts)
    for _ in range(rounds):
        books = _retrained(blocks, np.ascontiguousarray(books))
    return blocks, np.ascontiguousarray(books)


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every vector of the blocks: entry indexes in part order, and the squared distances to those entries summed up."""
    parts, _, width = books.shape

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, points, trees in _opened(batch, width, parts):
                chosen = np.stack([assign(points[:, p], tree, books[p])[0] for p, tree in enumerate(trees)], axis=1)
                error = ((points - books[np.arange(parts)[None, :], chosen]) ** 2).sum(axis=(1, 2))
                arrays = [batch.column(c)[i].values for c in ("ids", "labels")] + [pa.FixedSizeListArray.from_arrays(pa.array(chosen.reshape(-1), pa.int32()), parts).cast(pa.list_(pa.int32())), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "code", "error"])

    schema = StructType([StructField("vec_id", LongType()), StructField("label", StringType()), StructField("code", ArrayType(IntegerType())), StructField("error", LongType())])
    return blocks.mapInArrow(codes, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error`` of every vector that takes part, and the codebooks.

    ``label_error`` is the error summed over equal labels, nulls together.
    Vectors that are null or hold null or non-finite components take no part, nor do empty ones and,
    where lengths differ, those of another length than the most frequent that ``parts`` divides (ties: the longest). Rows with
    one id, or a null id, all stay; fewer vectors than ``entries`` make as many entries;
    an empty table gives an empty result and no codebooks. Other columns are not read, so none can clash.
    Components so large that squared distances pass 64 bits raise ValueError.
    """
    got = train(vectors, parts, entries, rounds, id_col, vector_col, label_col)
    if got is None:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, label string, code array<int>, error bigint, label_error bigint"), np.zeros((parts, 0, 0), np.int64)
    done = written(encode(*got), "codes")
    per_label = done.groupBy("label").agg(F.sum("error").alias("label_error"))
    return null_safe_join(done, per_label, ["label"]).select("vec_id", "label", "code", "error", "label_error"), got[1]


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
