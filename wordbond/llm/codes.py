"""Vector code compression: codebooks per part of a vector, by exact integer arithmetic.

Every component x becomes the whole number ``floor(4096 * x)``. Vectors are cut into
equal consecutive parts, and each part position has a codebook of its own. A round
assigns every part to the nearest entry of its codebook and replaces each entry by
the floor of its parts' mean. Distances come from matrix products: the numbers are
broken into limbs whose float64 products are exact, the products are put together
in int64, and the first of the smallest distances wins.

Spark reads the stored numbers once a round. Each task adds up its own parts, so
what is shuffled is a row per task, part position, entry and place, and what comes
to the driver is one codebook, whatever the number of vectors. The sums by label
are pre-aggregated, and labels with very many rows are split where they are joined.

Vectors that are null or hold null or non-finite numbers take no part. Nor do those
whose length is not the most frequent one among the lengths that can be cut (the
smaller of two; empty vectors can't). Numbers so large that a squared distance may
not fit in a long fail the job. Ids are read as bigint, and other ids that can be
cast. Rows without an id are encoded, but start no codebook. Rows of equal ids are
taken one by one, and start codebooks in the order of their numbers. With fewer
vectors than entries a codebook is as short; an empty table gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joining import attach_totals, store_totals
from ..workspace import Workspace
from .integers import digest_text, floor_means, label_sums, scaled_vectors, squared_distances, unpacked

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` holds the whole numbers of one entry."""

    entries: np.ndarray

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry of each part, and the squared distance to it."""
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        labels = np.zeros(cut.shape[:2], np.int64)
        errors = np.zeros(cut.shape[:2], np.int64)
        for part, entries in enumerate(self.entries):
            distances = squared_distances(cut[:, part], entries)
            labels[:, part] = distances.argmin(axis=1)
            errors[:, part] = np.take_along_axis(distances, labels[:, part, None], axis=1)[:, 0]
        return labels, errors

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes (a row of entry numbers each) stand for."""
        return np.concatenate([entries[codes[:, part]] for part, entries in enumerate(self.entries)], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(digest_text(self.entries).encode()).hexdigest()


def usual_length(vectors: DataFrame, vector_column: str, parts: int) -> int | None:
    """The most frequent length of a vector that can be cut into ``parts``, the smaller if there are two."""
    size = F.size(vector_column)
    found = vectors.filter((size > 0) & (size % parts == 0)).groupBy(size.alias("length")).count()
    first = found.orderBy(F.desc("count"), "length").first()
    return first.length if first else None


def first_codebooks(numbers: DataFrame, length: int, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, of which there are ``entries`` at most."""
    first = numbers.filter(F.col("_id").isNotNull()).orderBy("_id", "_vector").limit(entries).select("_vector")
    rows = [np.frombuffer(bytes(row._vector), "<i4").astype(np.int64) for row in first.collect()]
    vectors = np.array(rows, np.int64).reshape(len(rows), parts, length // parts)
    return Codebooks(np.ascontiguousarray(vectors.transpose(1, 0, 2)))


def refine(numbers: DataFrame, books: Codebooks) -> Codebooks:
    """One round: assign every part, then move each entry to the floor of its parts' mean."""
    parts, entries, width = books.entries.shape
    length = books.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            vectors = unpacked(batch.column(0), length)
            labels, _ = books.nearest(vectors)
            for part in range(parts):
                more, added = label_sums(vectors[:, part * width:(part + 1) * width], labels[:, part], entries)
                rows[part] += more
                sums[part] += added
        used = np.flatnonzero(rows.ravel())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))),
            pa.array(np.repeat(rows.ravel()[used], width)), pa.array(sums.reshape(-1, width)[used].ravel()),
        ], ["slot", "place", "rows", "total"])

    added = numbers.select("_vector").mapInArrow(run, "slot bigint, place bigint, rows bigint, total bigint")
    exact = added.groupBy("slot", "place").agg(  # decimals, as totals of all rows may pass a long
        F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    counts, totals = [0] * (parts * entries), [[0] * width for _ in range(parts * entries)]
    for row in exact.collect():  # a row for each number of the codebooks
        counts[row.slot] = int(row.rows)
        totals[row.slot][row.place] = int(row.total)
    before = books.entries.reshape(-1, width)
    return Codebooks(floor_means(counts, totals, before).reshape(books.entries.shape))


def fit_codebooks(
    numbers: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of a stored table of packed vectors (``_id, _vector``)."""
    books = first_codebooks(numbers, length, parts, entries)
    for _ in range(rounds if books.entries.shape[1] else 0):
        books = refine(numbers, books)
    return books


def encode(numbers: DataFrame, books: Codebooks) -> DataFrame:
    """``_id, _kept, _code, _error``: a byte per part, and the squared distances summed."""
    kinds = dict(numbers.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, errors = books.nearest(unpacked(batch.column("_vector"), books.length))
            codes = labels.astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), batch.column("_kept"),
                pa.array([code.tobytes() for code in codes], pa.binary()), pa.array(errors.sum(axis=1)),
            ], ["_id", "_kept", "_code", "_error"])

    return numbers.select("_id", "_kept", "_vector").mapInArrow(
        run, f"_id bigint, _kept {kinds['_kept']}, _code binary, _error bigint"
    )


def compress_vectors(
    vectors: DataFrame,
    workspace: Workspace,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the vectors that take part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte for each part, so entries must lie between 1 and 256")
    spark = vectors.sparkSession
    length = usual_length(vectors, vector_column, parts)
    if length is None:
        return spark.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        )
    numbers = workspace.store(
        scaled_vectors(vectors, length, scale, id_column, vector_column, label_column), "numbers"
    )
    books = fit_codebooks(numbers, length, parts, entries, rounds)
    if not books.entries.shape[1]:  # no vector with an id
        books = Codebooks(np.zeros((parts, 1, length // parts), np.int64))
    # Labels of any type, and missing ones, as one key that joins.
    key = F.when(F.col("_kept").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("_kept").cast("string")))
    encoded = workspace.store(encode(numbers, books).withColumn("_label", key).drop("_kept"), "codes")
    by_label = encoded.groupBy("_label").agg(
        F.sum("_error").alias("label_error"), F.count("*").alias("rows")
    )
    totals, sizes = store_totals(by_label, workspace, "label-errors")
    joined = attach_totals(encoded, totals, ["_label"], ["_id", "_code"], sizes[None])
    return joined.select(
        F.col("_id").alias("vec_id"), F.lower(F.hex("_code")).alias("code"), F.col("_error").alias("error"),
        "label_error", F.lit(books.digest()).alias("codebooks_sha256"),
    )
