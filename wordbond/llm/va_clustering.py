"""Centroid clustering with a vector-approximation file.

Every component x becomes the whole number ``floor(1024 * x)``, and a vector's numbers
become cells of ``bits`` bits: the place between cut points of that dimension. The
cells lie in a file of their own columns, a fraction of the vectors' size.

A round reads the cells only. Tables look up, for each dimension, cell and centroid,
between what bounds that dimension's part of the squared distance lies, less the
part that all centroids share; summed over dimensions they give an interval for the
distance to each centroid. Where one interval lies below all others the vector is
assigned without being read. The vectors whose intervals overlap are fetched by a
join and measured exactly, as are those that change their cluster, since the sums
of clusters are carried from round to round and only moves change them. The vector
file is dealt by row number into buckets, so the join shuffles row numbers and
never vectors.

The first assignment and the last read all vectors, one for the sums and the other
for the distances; they too measure only where intervals overlap.

Cut points are quantiles of a bounded sample (``SAMPLE_ROWS``), with the least and
largest number of each dimension in all vectors as ends, so intervals hold for every
vector and the result does not depend on the sample. What comes to the driver are
these bounds, the sums per centroid and the sample.

Vectors of another length than ``length``, and those that are null or hold null or
non-finite numbers, take no part. Numbers so large that a squared distance may not
fit in a long fail the job. Ids are read as bigint, and other ids that can be cast;
rows without an id are assigned, and start a centroid only after all others. Rows of
equal ids are taken one by one, in the order of their numbers where they start
centroids. With fewer vectors than centroids there are as few of those. An empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace
from .integers import (
    digest_text, floor_means, label_sums, scaled_vectors, squared_distances, unpacked,
)

SCALE, LENGTH, CENTROIDS, ROUNDS, BITS = 1024, 64, 8, 10, 8
SAMPLE_ROWS = 10_000
SEED_PREFIX = "3:"


# --- cells -------------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """Bounds of the cells: cell c of dimension d holds ``low[d, c]`` to ``high[d, c]``, both included."""

    bits: int
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def over(cls, sample: np.ndarray, least: np.ndarray, largest: np.ndarray, bits: int) -> "Grid":
        """Cells with about as many vectors of the sample each."""
        if not 1 <= bits <= 8:
            raise ValueError("bits must lie between 1 and 8")
        shares = np.arange(1, 1 << bits) / (1 << bits)
        cuts = np.floor(np.quantile(sample, shares, axis=0)).astype(np.int64).T  # cell c + 1 begins at cut c
        low = np.concatenate([least[:, None], np.maximum(cuts, least[:, None])], axis=1)
        high = np.concatenate([np.minimum(cuts - 1, largest[:, None]), largest[:, None]], axis=1)
        return cls(bits, np.minimum(low, largest[:, None]), np.maximum(high, least[:, None]))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each number; of cells that begin at the same number the last."""
        found = np.empty(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            found[:, d] = np.searchsorted(self.low[d, 1:], vectors[:, d], side="right")
        return found

    def pack(self, cells: np.ndarray) -> pa.Array:
        places = (cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8)) & 1
        raw = np.packbits(places.reshape(len(cells), -1), axis=1)
        offsets = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
        return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])

    def unpack(self, column: pa.Array) -> np.ndarray:
        dimensions = len(self.low)
        width = -(-dimensions * self.bits // 8)
        raw = np.frombuffer(b"".join(value.as_buffer() for value in column), np.uint8).reshape(-1, width)
        places = np.unpackbits(raw, axis=1, count=dimensions * self.bits).reshape(-1, dimensions, self.bits)
        return (places << np.arange(self.bits, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)


class Intervals:
    """Lookup tables of one set of centroids."""

    def __init__(self, grid: Grid, centroids: np.ndarray):
        # |x - c|^2 - |x - m|^2 = |c|^2 - |m|^2 - 2 x (c - m): the term that all centroids
        # share is left out, which narrows the intervals. m is the centroids' mean.
        middle = centroids.sum(axis=0) // len(centroids)
        slope = (-2 * (centroids - middle)).T[:, None, :]
        constant = (centroids * centroids - middle * middle).T[:, None, :]
        ends = grid.low[:, :, None] * slope, grid.high[:, :, None] * slope
        self.low = np.minimum(*ends) + constant  # dimension, cell, centroid
        self.high = np.maximum(*ends) + constant

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each vector and centroid: may it be the nearest?"""
        shape = len(cells), self.low.shape[2]
        low, high = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for d in range(cells.shape[1]):
            low += self.low[d, cells[:, d]]
            high += self.high[d, cells[:, d]]
        return low <= high.min(axis=1, keepdims=True)


def _settle(possible: np.ndarray) -> np.ndarray:
    """The one candidate, or -1 where there are several."""
    return np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)


def _assign(vectors: np.ndarray, cells: np.ndarray, tables: Intervals, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid; distances are measured where intervals overlap."""
    labels = _settle(tables.candidates(cells))
    rows = np.flatnonzero(labels < 0)
    labels[rows] = squared_distances(vectors[rows], centroids).argmin(axis=1)
    return labels


# --- rounds ------------------------------------------------------------------

_STATE = "_row bigint, _cells binary, _label int, _rows bigint, _sums array<bigint>"


class _Tally:
    """What a task adds to the counts and sums of the centroids."""

    def __init__(self, centroids: np.ndarray):
        self.rows, self.sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)

    def add(self, vectors: np.ndarray, labels: np.ndarray, sign: int = 1) -> None:
        rows, sums = label_sums(vectors, labels, len(self.rows))
        self.rows += sign * rows
        self.sums += sign * sums

    def batch(self) -> pa.RecordBatch:
        """A row per centroid that something was added to, without a row number."""
        used = np.flatnonzero(self.rows.astype(bool) | self.sums.any(axis=1))
        return _state(
            pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()), used, pa.array(self.rows[used]),
            pa.array(list(self.sums[used]), pa.list_(pa.int64())),
        )


def _state(rows: pa.Array, cells: pa.Array, labels: np.ndarray, counted=None, sums=None) -> pa.RecordBatch:
    size = len(rows)
    return pa.RecordBatch.from_arrays([
        rows, cells, pa.array(labels.astype(np.int32)), pa.nulls(size, pa.int64()) if counted is None else counted,
        pa.nulls(size, pa.list_(pa.int64())) if sums is None else sums,
    ], ["_row", "_cells", "_label", "_rows", "_sums"])


def _first_round(file: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """State rows of all vectors, and the tasks' tallies."""
    length = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, tally = Intervals(grid, centroids), _Tally(centroids)
        for batch in batches:
            vectors = unpacked(batch.column("_vector"), length)
            labels = _assign(vectors, grid.unpack(batch.column("_cells")), tables, centroids)
            tally.add(vectors, labels)
            yield _state(batch.column("_row"), batch.column("_cells"), labels)
        yield tally.batch()

    return file.select("_row", "_cells", "_vector").mapInArrow(run, _STATE)


def _judge(state: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """State rows with ``_new``, the nearest centroid by the cells alone, or -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Intervals(grid, centroids)
        for batch in batches:
            new = _settle(tables.candidates(grid.unpack(batch.column("_cells"))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new.astype(np.int32))], ["_row", "_cells", "_label", "_new"]
            )

    return state.mapInArrow(run, "_row bigint, _cells binary, _label int, _new int")


def _move(fetched: DataFrame, centroids: np.ndarray) -> DataFrame:
    """State rows of fetched vectors with their exact labels, and what the moves add to the sums."""
    length = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(centroids)
        for batch in batches:
            vectors = unpacked(batch.column("_vector"), length)
            old, new = (batch.column(name).to_numpy().astype(np.int64) for name in ("_label", "_new"))
            rows = np.flatnonzero(new < 0)
            new[rows] = squared_distances(vectors[rows], centroids).argmin(axis=1)
            moved = np.flatnonzero(new != old)
            tally.add(vectors[moved], old[moved], -1)
            tally.add(vectors[moved], new[moved])
            yield _state(batch.column("_row"), batch.column("_cells"), new)
        yield tally.batch()

    return fetched.select("_row", "_cells", "_label", "_new", "_vector").mapInArrow(run, _STATE)


@dataclass
class _Sums:
    """Counts and sums of the clusters so far, as Python integers."""

    rows: list[int]
    sums: list[list[int]]

    def add(self, tallies: DataFrame) -> None:
        """Add the tasks' rows: a column for each place, so they are never spread out into a row for each."""
        places = range(len(self.sums[0]) if self.sums else 0)
        exact = tallies.groupBy("_label").agg(F.sum("_rows").alias("rows"), *[
            F.sum(F.get("_sums", F.lit(place)).cast("decimal(38,0)")).alias(f"total{place}") for place in places
        ])
        for row in exact.collect():  # a row per centroid
            self.rows[row._label] += int(row.rows)
            for place in places:
                self.sums[row._label][place] += int(row[f"total{place}"])


def _fit(file: DataFrame, workspace: Workspace, grid: Grid, centroids: np.ndarray, rounds: int) -> np.ndarray:
    known = _Sums([0] * len(centroids), [[0] * centroids.shape[1] for _ in centroids])
    columns = ["_row", "_cells", "_label"]
    state = None
    for _ in range(rounds):
        if state is None:
            made = workspace.store(_first_round(file, grid, centroids), "state")
            state = made.filter(F.col("_row").isNotNull()).select(*columns)
        else:
            judged = workspace.store(_judge(state, grid, centroids), "judged")
            same = F.col("_new") == F.col("_label")
            # Row numbers and cells are shuffled to the vectors, which stay in their buckets.
            wanted = judged.filter(~same)
            fetched = wanted.join(file.select("_row", "_vector").hint("merge"), "_row")
            made = workspace.store(_move(fetched, centroids), "moved")
            state = judged.filter(same).select(*columns).unionByName(
                made.filter(F.col("_row").isNotNull()).select(*columns)
            )
        known.add(made.filter(F.col("_row").isNull()))
        after = floor_means(known.rows, known.sums, centroids)
        if (after == centroids).all():
            break  # nothing moves any more
        centroids = after
    return centroids


# --- the whole ---------------------------------------------------------------


def _first_centroids(points: DataFrame, length: int, count: int, prefix: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    text = F.concat(F.lit(prefix), F.col("_id").cast("string"))
    first = points.orderBy(F.asc_nulls_last(F.sha2(text, 256)), "_vector").limit(count).select("_vector")
    rows = [np.frombuffer(bytes(row._vector), "<i4").astype(np.int64) for row in first.collect()]
    return np.array(rows, np.int64).reshape(-1, length)


def _bounds(points: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The least and the largest number of each dimension, and the number of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, least, largest = 0, None, None
        for batch in batches:
            vectors = unpacked(batch.column(0), length)
            if len(vectors):
                rows += len(vectors)
                least = vectors.min(axis=0) if least is None else np.minimum(least, vectors.min(axis=0))
                largest = vectors.max(axis=0) if largest is None else np.maximum(largest, vectors.max(axis=0))
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(length, rows)), pa.array(np.arange(length)), pa.array(least), pa.array(largest)
            ], ["rows", "place", "least", "largest"])

    found = points.select("_vector").mapInArrow(run, "rows bigint, place bigint, least bigint, largest bigint")
    rows = found.groupBy("place").agg(
        F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("largest").alias("largest")
    ).orderBy("place").collect()
    return (
        np.array([row.least for row in rows], np.int64), np.array([row.largest for row in rows], np.int64),
        rows[0].rows if rows else 0,
    )


def _sample(points: DataFrame, total: int, length: int, sample_rows: int) -> np.ndarray:
    """About ``sample_rows`` vectors, chosen by the hash of their row numbers."""
    share = min(1.0, sample_rows / total)
    chosen = points.filter(F.pmod(F.xxhash64("_row"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    rows = [np.frombuffer(bytes(row._vector), "<i4").astype(np.int64) for row in chosen.select("_vector").collect()]
    return np.array(rows, np.int64).reshape(-1, length)


def _measure(file: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of all vectors."""
    length = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Intervals(grid, centroids)
        for batch in batches:
            vectors = unpacked(batch.column("_vector"), length)
            labels = _assign(vectors, grid.unpack(batch.column("_cells")), tables, centroids)
            gap = vectors - centroids[labels]
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), pa.array(labels.astype(np.int32)), pa.array((gap * gap).sum(axis=1)),
            ], ["vec_id", "cluster", "distance"])

    return file.select("_id", "_cells", "_vector").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame,
    workspace: Workspace,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    bits: int = BITS,
    sample_rows: int = SAMPLE_ROWS,
    seed_prefix: str = SEED_PREFIX,
    buckets: int | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors that take part.

    ``buckets`` are the files that the vectors are dealt into, as many as the
    session's shuffle partitions unless given.
    """
    spark = vectors.sparkSession
    numbered = scaled_vectors(vectors, length, scale, id_column, vector_column).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    points = workspace.store(numbered, "points")
    least, largest, total = _bounds(points, length)
    if not total:
        return spark.createDataFrame([], (
            "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        ))
    grid = Grid.over(_sample_or_ends(points, total, length, sample_rows, least, largest), least, largest, bits)
    file = workspace.store_bucketed(_with_cells(points, grid, length), "vectors", ["_row"], buckets)
    first = _first_centroids(points, length, centroids, seed_prefix)
    final = _fit(file, workspace, grid, first, rounds)

    measured = workspace.store(_measure(file, grid, final), "distances")
    by_cluster = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia = sum(row.cluster_inertia for row in by_cluster)
    known = spark.createDataFrame([  # a row per centroid
        (row.cluster, row.cluster_inertia, inertia, hashlib.sha256(digest_text(final[row.cluster]).encode()).hexdigest())
        for row in by_cluster
    ], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return measured.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sample_or_ends(points, total, length, sample_rows, least, largest) -> np.ndarray:
    sample = _sample(points, total, length, sample_rows)
    return sample if len(sample) else np.stack([least, largest])


def _with_cells(points: DataFrame, grid: Grid, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.cells(unpacked(batch.column("_vector"), length))
            yield pa.RecordBatch.from_arrays([*batch.columns, grid.pack(cells)], [*batch.schema.names, "_cells"])

    return points.select("_row", "_id", "_vector").mapInArrow(
        run, "_row bigint, _id bigint, _vector binary, _cells binary"
    )
