"""Vectors of numbers as vectors of whole numbers, and exact products of those.

BLAS multiplies floating-point matrices only, and a float64 holds integers up to
``2**53``. Integers are therefore broken into limbs, as many as keep the sums of
limb products below that bound, and the products are put together again in int64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

# Squared distances, and differences of two, must fit in a long.
LONG_BITS = 62


def _check_size(values: np.ndarray) -> None:
    """Raise if a squared distance between two such vectors may not fit in a long."""
    largest = int(np.abs(values).max(initial=0))
    if largest >= 1 << 31 or 4 * values.shape[1] * largest * largest >= 1 << LONG_BITS:
        raise ValueError("vector components are too large: squared distances would not fit in a long")


def scaled_batch(column: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of ``length`` finite numbers, and ``floor(scale * x)`` of their numbers x."""
    fitting = np.flatnonzero(
        np.array(pa.compute.list_value_length(column).fill_null(-1)) == length
    )
    chosen = column.take(pa.array(fitting))
    numbers = chosen.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)
    good = np.isfinite(numbers).all(axis=1)  # a missing number is NaN here
    with np.errstate(over="ignore"):
        floors = np.floor(scale * numbers[good])
    if not (np.abs(floors) < 2.0**31).all():
        raise ValueError("vector components are too large: squared distances would not fit in a long")
    values = floors.astype(np.int64)
    _check_size(values)
    return fitting[good], values


def packed(values: np.ndarray) -> pa.Array:
    """Integer vectors as binary values, four little-endian bytes a number."""
    raw = np.ascontiguousarray(values, "<i4")
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * (4 * raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def unpacked(column: pa.Array, length: int) -> np.ndarray:
    """What :func:`packed` made, as int64."""
    raw = b"".join(value.as_buffer() for value in column)
    return np.frombuffer(raw, "<i4").reshape(-1, length).astype(np.int64)


def scaled_vectors(
    vectors: DataFrame, length: int, scale: int, id_column: str, vector_column: str, kept: str | None = None
) -> DataFrame:
    """``_id, _vector[, _kept]``: the vectors of ``length`` finite numbers as packed whole numbers.

    ``_kept`` carries the column ``kept`` along.
    """
    columns = [F.col(id_column).cast("bigint").alias("_id"), F.col(vector_column).cast("array<double>").alias("_vector")]
    if kept is not None:
        columns.append(F.col(kept).alias("_kept"))
    rows = vectors.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = scaled_batch(batch.column(1), length, scale)
            taken = [batch.column(i).take(pa.array(places)) for i in range(batch.num_columns)]
            taken[1] = packed(values)
            yield pa.RecordBatch.from_arrays(taken, batch.schema.names)

    kinds = dict(rows.dtypes) | {"_vector": "binary"}
    return rows.mapInArrow(run, ", ".join(f"{name} {kinds[name]}" for name in rows.columns))


# --- exact products ----------------------------------------------------------


def limb_bits(terms: int) -> int:
    """Bits of a limb for which a sum of ``terms`` limb products stays below ``2**53``."""
    return (53 - max(terms - 1, 1).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 matrices whose sum, each shifted by ``bits`` more than the one before, is ``values``.

    The lower limbs are not negative; the top one carries the sign. As many are
    made as the largest number needs.
    """
    parts = []
    while np.abs(values).max(initial=0) >= 1 << bits:
        parts.append((values & ((1 << bits) - 1)).astype(float))
        values = values >> bits
    return [*parts, values.astype(float)]


def exact_products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact if the result fits in int64.

    Sums on the way may wrap around, which their total undoes.
    """
    bits = limb_bits(left.shape[1]) if bits is None else bits
    total = np.zeros((len(left), len(right)), np.int64)
    rights = limbs(right, bits)
    for i, upper in enumerate(limbs(left, bits)):
        for j, lower in enumerate(rights):
            if bits * (i + j) < 64:
                total += (upper @ lower.T).astype(np.int64) << (bits * (i + j))
    return total


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances, a row per point and a column per centre."""
    return (
        (points * points).sum(axis=1)[:, None] - 2 * exact_products(points, centres)
        + (centres * centres).sum(axis=1)[None, :]
    )


def label_sums(points: np.ndarray, labels: np.ndarray, count: int, sign: np.ndarray | None = None):
    """Rows with each label, and the sums of their numbers; both times ``sign`` if given.

    ``bincount`` adds float64: exact while rows times the largest number stay below 2**53,
    so it is given slices of at most that.
    """
    rows, sums = np.zeros(count, np.int64), np.zeros((count, points.shape[1]), np.int64)
    step = max(1, (1 << 52) // max(1, int(np.abs(points).max(initial=0))))
    for start in range(0, len(points), step):
        part, label = points[start:start + step], labels[start:start + step]
        weight = np.ones(len(part), np.int64) if sign is None else sign[start:start + step]
        rows += np.bincount(label, weight, count).astype(np.int64)
        for place in range(points.shape[1]):
            sums[:, place] += np.bincount(label, weight * part[:, place], count).astype(np.int64)
    return rows, sums


def floor_means(rows: list[int], sums: list[list[int]], before: np.ndarray) -> np.ndarray:
    """``floor(sum / count)``, and the row of ``before`` where nothing was counted."""
    return np.array([
        [total // count for total in line] if count else list(old)
        for count, line, old in zip(rows, sums, before.tolist())
    ], np.int64).reshape(before.shape)


def digest_text(values: np.ndarray) -> str:
    """Decimal integers joined by commas."""
    return ",".join(map(str, values.ravel().tolist()))
