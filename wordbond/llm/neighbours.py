"""Approximate nearest neighbours by cosine, over low-dimensional stable projections.

Vectors are scaled to length one, where the largest cosine is the least distance,
and projected by a fixed Gaussian matrix to ``DIMENSIONS`` numbers. The squared
projected distance of two vectors over their true one then follows a chi-square
law with that many degrees of freedom, whatever the data.

The projections are indexed by a kd-tree. Its upper part is fitted on a bounded
sample and cuts the space into regions; every vector is indexed in its region, in
blocks of about ``BLOCK_ROWS`` that hold the lower parts. A query first searches
its own block, which bounds the distance of its k-th neighbour, and then every
block whose region may hold a nearer one. In a block it takes leaves by growing
projected distance, and of their points those that are near enough in projection,
and verifies their true distance, until the chi-square test says that a nearer
vector would have shown up by now with probability ``confidence``. The queries of a
block go through its leaves together, each in its own order, so that those that are
at the same leaf share one matrix product.

Regions with very many equal vectors are dealt by id over several blocks, and the
queries that visit a block over parts, so no task holds more than a block and a part.
A block is repeated only for parts beyond its first, and not read where no query
visits it. Scores are cosines in double precision of the original vectors.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite numbers take no part, nor do rows without an id. Rows of one id are one
item, as near as its nearest vector; a query never finds its own id. A query with
fewer candidates finds all of them. An empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joining import broadcast_if_small
from ..workspace import Workspace

DIMENSIONS, CONFIDENCE, SEED = 8, 0.99, 7
SAMPLE_ROWS, BLOCK_ROWS, LEAF_ROWS, QUERY_ROWS = 20_000, 8192, 512, 4096
# Points of the sample that a region needs; a larger sample makes more regions.
REGION_SAMPLE = 4
QUERY_STEP, NEAREST = 50, 5


def chi_square_quantile(freedom: int, probability: float) -> float:
    """For an even number of degrees of freedom."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(freedom // 2))

    low, high = 0.0, 1.0
    while below(high) < probability:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


# --- the tree ----------------------------------------------------------------


@dataclass
class Splits:
    """A kd-tree as arrays: inner nodes split on an axis, leaves carry numbers."""

    axis: list[int]
    at: list[float]
    children: list[tuple[int, int]]
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to."""
        found = np.zeros(len(points), np.int64)
        if not self.axis:
            return found
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            right = points[rows, self.axis[node]] > self.at[node]
            for child, chosen in zip(self.children[node], (rows[~right], rows[right])):
                if child < 0:
                    found[chosen] = -child - 1
                elif len(chosen):
                    waiting.append((child, chosen))
        return found


def split_space(points: np.ndarray, leaves: int) -> Splits:
    """Halve the fullest part along its widest axis until there are ``leaves`` parts."""
    tree = Splits([], [], [], 1)
    parts: list[tuple[np.ndarray, int | None, int]] = [(np.arange(len(points)), None, 0)]
    done: list[tuple[int | None, int]] = []
    while parts and len(parts) + len(done) < leaves:
        parts.sort(key=lambda part: len(part[0]))
        rows, parent, side = parts.pop()
        inside = points[rows]
        axis = int(np.argmax(np.ptp(inside, axis=0))) if len(rows) else 0
        at = float(np.median(inside[:, axis])) if len(rows) else 0.0
        right = inside[:, axis] > at if len(rows) else np.zeros(0, bool)
        if not right.any():  # equal along all axes, or the median is the largest
            if not len(rows) or np.ptp(inside[:, axis]) == 0:
                done.append((parent, side))
                continue
            at = float(np.max(inside[inside[:, axis] < at, axis]))
            right = inside[:, axis] > at
        node = len(tree.axis)
        tree.axis.append(axis)
        tree.at.append(at)
        tree.children.append((0, 0))
        if parent is not None:
            _hang(tree, parent, side, node)
        parts += [(rows[~right], node, 0), (rows[right], node, 1)]
    ends = [(parent, side) for _, parent, side in parts] + done
    for number, (parent, side) in enumerate(ends):
        if parent is not None:
            _hang(tree, parent, side, -number - 1)
    tree.leaves = len(ends)
    return tree


def _hang(tree: Splits, parent: int, side: int, child: int) -> None:
    pair = list(tree.children[parent])
    pair[side] = child
    tree.children[parent] = (pair[0], pair[1])


def _boxes(points: np.ndarray, leaf: np.ndarray, leaves: int):
    """Rows of each leaf that has any, and its bounds."""
    order = np.argsort(leaf, kind="stable")
    edges = np.searchsorted(leaf[order], np.arange(leaves + 1))
    filled = [order[a:b] for a, b in zip(edges, edges[1:]) if b > a]
    low = np.array([points[rows].min(axis=0) for rows in filled])
    high = np.array([points[rows].max(axis=0) for rows in filled])
    return filled, low, high


def _box_distances(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns)."""
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        at = points[:, axis, None]
        gap = np.maximum(np.maximum(low[None, :, axis] - at, at - high[None, :, axis]), 0.0)
        total += gap * gap
    return total


# Products of matrices differ in their last bits from place to place; candidates whose
# cosines agree to this many digits are ties until their scores are computed one by one.
_DIGITS = 10


@dataclass
class _Found:
    """The nearest candidates of some queries so far: a row each, best first."""

    places: np.ndarray  # in the block, -1 where there is none yet
    ids: np.ndarray
    scores: np.ndarray
    bound: np.ndarray  # on the squared distance of the k-th

    @classmethod
    def none(cls, bound: np.ndarray, k: int) -> "_Found":
        shape = len(bound), k
        return cls(np.full(shape, -1), np.full(shape, -1, np.int64), np.full(shape, -np.inf), bound.copy())

    def add(self, rows: np.ndarray, places: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Cosines of points (columns) for some queries (rows); ``-inf`` where a point does not count."""
        k = self.ids.shape[1]
        scores = np.round(scores, _DIGITS)
        better = scores > -np.inf
        full = self.places[rows, -1] >= 0
        better[full] &= scores[full] >= self.scores[rows[full], -1, None]
        for at in np.flatnonzero(better.any(axis=1)).tolist():
            row, new = rows[at], np.flatnonzero(better[at])
            known = np.flatnonzero(self.places[row] >= 0)
            every = [np.concatenate([mine[row, known], others]) for mine, others in (
                (self.places, places[new]), (self.ids, ids[new]), (self.scores, scores[at, new])
            )]
            best = _best(every[1], every[2], k)
            for mine, found in zip((self.places, self.ids, self.scores), every):
                mine[row, :len(best)] = found[best]
            if len(best) == k:
                self.bound[row] = min(self.bound[row], max(2 - 2 * self.scores[row, -1], 1e-12))


class _Block:
    """Vectors with their projections and the lower part of the tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        self.ids, self.vectors, self.projected = ids, vectors, projected
        self.units = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        tree = split_space(projected, max(1, len(ids) // LEAF_ROWS))
        self.leaves, self.low, self.high = _boxes(projected, tree.leaf_of(projected), tree.leaves)

    def search(
        self, own: np.ndarray, vectors: np.ndarray, projected: np.ndarray, k: int, quantile: float, bound: np.ndarray
    ) -> _Found:
        """The nearest points found for each query.

        ``bound`` are bounds on the squared distance of the k-th that are known already.
        """
        found = _Found.none(bound, k)
        units = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        far = _box_distances(self.low, self.high, projected)
        order = np.argsort(far, axis=1, kind="stable")
        for step in range(len(self.leaves)):
            leaf = order[:, step]
            going = far[np.arange(len(far)), leaf] <= quantile * found.bound
            if not going.any():
                break  # leaves only get farther, and bounds smaller
            for place in np.unique(leaf[going]).tolist():
                rows = np.flatnonzero(going & (leaf == place))
                points = self.leaves[place]
                gap = (
                    (projected[rows] ** 2).sum(axis=1)[:, None] + (self.projected[points] ** 2).sum(axis=1)[None, :]
                    - 2 * projected[rows] @ self.projected[points].T
                )
                near = gap <= quantile * found.bound[rows, None] + 1e-9
                near &= self.ids[points][None, :] != own[rows, None]
                some = near.any(axis=0)
                if some.any():
                    scores = np.where(near[:, some], units[rows] @ self.units[points[some]].T, -np.inf)
                    found.add(rows, points[some], self.ids[points[some]], scores)
        return found


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of different ids, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    first.sort()
    return order[first[:k]]


# --- Spark -------------------------------------------------------------------


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)


def _projected(vectors: DataFrame, matrix: np.ndarray, id_column: str, vector_column: str) -> DataFrame:
    """``_id, _vector, _point`` of the vectors that take part."""
    size = len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(
                np.array(pa.compute.list_value_length(batch.column(1)).fill_null(-1)) == size
            )))
            values = _matrix(batch.column(1), size)
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.sqrt((values * values).sum(axis=1))
            good = np.flatnonzero(np.isfinite(values).all(axis=1) & np.isfinite(norm) & (norm > 0))
            values, norm = values[good], norm[good]
            points = (values / norm[:, None]) @ matrix
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good)), _lists(values), _lists(points)],
                ["_id", "_vector", "_point"],
            )

    rows = vectors.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_id"), F.col(vector_column).alias("_vector")
    )
    return rows.mapInArrow(run, "_id bigint, _vector array<double>, _point array<double>")


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _usual_length(vectors: DataFrame, id_column: str, vector_column: str) -> int | None:
    """The most frequent length of a vector, the smaller if there are two."""
    lengths = vectors.filter(F.col(id_column).isNotNull() & (F.size(vector_column) > 0)).groupBy(
        F.size(vector_column).alias("length")
    ).count().orderBy(F.desc("count"), "length").first()
    return lengths.length if lengths else None


_FOUND = "_query bigint, _found bigint, _score double"


def nearest_neighbours(
    vectors: DataFrame,
    workspace: Workspace,
    nearest: int = NEAREST,
    query_step: int = QUERY_STEP,
    confidence: float = CONFIDENCE,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``query_step``.

    ``sample_rows`` points fit the upper tree, which has a region for every
    ``REGION_SAMPLE`` of them at most; beyond ``sample_rows / 4`` blocks of vectors take
    a larger sample, or regions hold several blocks each.
    """
    spark = vectors.sparkSession
    size = _usual_length(vectors, id_column, vector_column)
    if size is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    matrix = np.random.default_rng(SEED).standard_normal((size, DIMENSIONS))
    quantile = chi_square_quantile(DIMENSIONS, confidence)
    points = workspace.store(_projected(vectors, matrix, id_column, vector_column), "points")
    total = points.count()
    # A sample of points fits the upper tree; all points are indexed. The share is cut
    # first, so that no more than the sample is sorted.
    share = min(1.0, 1.2 * sample_rows / max(total, 1))
    sample = points.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).select(
        "_id", "_point"
    ).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows).collect()
    regions = min(max(1, len(sample) // REGION_SAMPLE), max(1, -(-total // BLOCK_ROWS)))
    tree = split_space(np.array([row._point for row in sample]).reshape(-1, DIMENSIONS), regions)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = tree.leaf_of(_matrix(batch.column(2), DIMENSIONS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(region, pa.int32())], ["_id", "_vector", "_point", "_region"]
            )

    indexed = workspace.store(
        points.mapInArrow(assign, "_id bigint, _vector array<double>, _point array<double>, _region int"),
        "indexed",
    )
    bounds = [f(F.col("_point")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max))
              for i in range(DIMENSIONS)]
    # A row per region, of which the sample bounds the number.
    boxes = indexed.groupBy("_region").agg(F.count("*").alias("rows"), *bounds).collect()
    blocks = {row._region: -(-row.rows // BLOCK_ROWS) for row in boxes}
    low = np.array([[row[f"low{i}"] for i in range(DIMENSIONS)] for row in boxes])
    high = np.array([[row[f"high{i}"] for i in range(DIMENSIONS)] for row in boxes])
    numbers = [row._region for row in boxes]
    block_count = F.element_at(
        F.array(*[F.lit(blocks.get(region, 1)) for region in range(tree.leaves)]), F.col("_region") + 1
    )
    placed = indexed.withColumn("_block", F.pmod(F.xxhash64("_id"), block_count).cast("int"))

    def search_own(table: pa.Table) -> pa.Table:
        ids, values, projected = _columns(table, size)
        rows = np.flatnonzero(ids % query_step == 0)
        bound = np.full(len(rows), 4.0)
        if len(rows):
            block = _Block(ids, values, projected)
            bound = block.search(ids[rows], values[rows], projected[rows], nearest, quantile, bound).bound
        return pa.table({
            "_id": ids[rows], "_vector": _lists(values[rows]), "_point": _lists(projected[rows]),
            "_bound": pa.array(bound, pa.float64()),
        })

    bounded = workspace.store(placed.groupBy("_region", "_block").applyInArrow(
        search_own, "_id bigint, _vector array<double>, _point array<double>, _bound double"
    ), "bounds")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            projected, bound = _matrix(batch.column(2), DIMENSIONS), batch.column(3).to_numpy()
            near = _box_distances(low, high, projected) <= quantile * bound[:, None]
            rows, where, which = [], [], []
            for row, place in zip(*(found.tolist() for found in np.nonzero(near))):
                count = blocks[numbers[place]]
                rows += [row] * count
                where += [numbers[place]] * count
                which += range(count)
            yield pa.RecordBatch.from_arrays(
                [*(column.take(pa.array(rows, pa.int64())) for column in batch.columns),
                 pa.array(where, pa.int32()), pa.array(which, pa.int32())],
                ["_id", "_vector", "_point", "_bound", "_region", "_block"],
            )

    visits = bounded.mapInArrow(
        visit, "_id bigint, _vector array<double>, _point array<double>, _bound double, _region int, _block int"
    )
    # A block meets its queries part by part; most blocks have one part, and the others are
    # repeated. The counts are a row per block.
    counted = workspace.store(visits.groupBy("_region", "_block").agg(
        F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("_parts")
    ), "visits")
    by_block = ["_region", "_block"]
    keys = [*by_block, "_part"]
    parts = broadcast_if_small(counted)
    asked = visits.join(parts, by_block).withColumn(
        "_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")
    ).drop("_parts")
    repeated = placed.join(parts, by_block).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).drop("_parts")

    def search(points: pa.Table, asked: pa.Table) -> pa.Table:
        queries, ids, scores = (np.empty(0, kind) for kind in (np.int64, np.int64, float))
        if points.num_rows and asked.num_rows:
            block = _Block(*_columns(points, size))
            own, values, projected = _columns(asked, size)
            bound = asked.column("_bound").to_numpy()
            found = block.search(own, values, projected, nearest, quantile, bound)
            used = found.places >= 0
            queries, ids = np.repeat(own, used.sum(axis=1)), found.ids[used]
            # The products above may differ in the last bit; the score is the measure itself.
            left = np.repeat(values, used.sum(axis=1), axis=0)
            right = block.vectors[found.places[used]]
            scores = (left * right).sum(axis=1) / (
                np.sqrt((left * left).sum(axis=1)) * np.sqrt((right * right).sum(axis=1))
            )
        return pa.table({
            "_query": pa.array(queries, pa.int64()), "_found": pa.array(ids, pa.int64()),
            "_score": pa.array(scores, pa.float64()),
        })

    found = repeated.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, _FOUND)
    best = found.groupBy("_query", "_found").agg(F.max("_score").alias("_score"))
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("_score"), "_found"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= nearest).select(
        F.col("_query").alias("query_id"), "rank", F.col("_found").alias("vec_id"), F.col("_score").alias("score")
    )


def _columns(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    vectors, points = (
        np.concatenate([_matrix(chunk, n) for chunk in table.column(name).chunks] or [np.empty((0, n))])
        for name, n in (("_vector", size), ("_point", DIMENSIONS))
    )
    return table.column("_id").to_numpy(), vectors, points
