"""Best-fit-decreasing packing of documents into sequences of a fixed length.

A document's pieces are its ids cut every ``capacity`` tokens, so only longer
documents are cut. Best fit decreasing only sees lengths, and there are at most
``capacity`` of them: the driver packs the *histogram* of lengths, however many
pieces there are. It takes lengths from long to short and puts a whole run of
equal pieces into the tightest open bins at once, found by a segment tree over
remaining capacities. The outcome is a table of runs, whose size depends on the
capacity and not on the corpus; each piece looks up its run by its length and
its number among the pieces of that length.

Null texts are empty and hold only the end id. Equal ids and repeated rows each
give pieces of their own, and equal pieces may change places. An empty table
gives no pieces; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace
from .batches import small_batches
from .numbering import number_rows
from .words import binary_values, token_ids

CAPACITY, END = 4096, 1
_PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end: int | None = END,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``_id, piece, start, length, ids_crc32`` of every piece, and on request its ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for owner, ids in zip(
                range(batch.num_rows), token_ids(binary_values(batch.column(1)), tokenizer_path, end)
            ):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start:start + capacity].astype("<u4")
                    rows.append((owner, piece, start, len(cut), zlib.crc32(cut.tobytes()), cut))
            columns = list(zip(*rows)) if rows else [()] * 6
            out = [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
            out += [pa.array(column, pa.int64()) for column in columns[2:5]]
            if with_ids:
                out.append(pa.array([cut.astype("<i4") for cut in columns[5]], pa.list_(pa.int32())))
            names = ["_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(out, names[:len(out)])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, {_PIECES}" + ", ids array<int>" * with_ids)


class _OpenBins:
    """Bins by remaining capacity, with a segment tree that finds the tightest fit."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.runs: list[deque] = [deque() for _ in range(capacity + 1)]

    def _mark(self, room: int, filled: bool) -> None:
        node = self.leaves + room
        self.filled[node] = filled
        while node > 1:
            node //= 2
            now = self.filled[2 * node] or self.filled[2 * node + 1]
            if self.filled[node] == now:
                break
            self.filled[node] = now

    def add(self, room: int, first: int, count: int) -> None:
        """``count`` bins from number ``first`` on that have ``room`` left."""
        if room and count:
            self.runs[room].append((first, count))
            self._mark(room, True)

    def tightest(self, length: int) -> int | None:
        """The least room of an open bin that is at least ``length``."""
        node = self.leaves + length
        while not self.filled[node]:
            while node & 1:  # a right child: what lies further right is above
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            node += not self.filled[node]
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].popleft()
        if not self.runs[room]:
            self._mark(room, False)
        return run


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Runs of equal pieces: rows of (length, first, bin, per_bin, offset).

    Piece number ``first + d`` of a length goes to bin ``bin + d // per_bin`` at
    ``offset + d % per_bin * length``, up to the next run of that length. A bin
    that takes a piece stays the tightest while it has room for another, so one
    run fills its bins as best fit decreasing, piece by piece, would.
    """
    bins, opened, runs = _OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        left, number = histogram[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            else:
                first, count = bins.take(room)
            per_bin = room // length
            runs.append((length, number, first, per_bin, capacity - room))
            placed = min(left, count * per_bin)
            full, rest = divmod(placed, per_bin)
            bins.add(room - per_bin * length, first, full)
            if rest:
                bins.add(room - rest * length, first + full, 1)
            untouched = full + (rest > 0)
            bins.add(room, first + untouched, count - untouched)
            left, number = left - placed, number + placed
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, unique: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to stored pieces with a column ``length``.

    ``unique`` names the columns that tell pieces apart. Lengths run from 1 to
    ``capacity``.
    """
    histogram = dict(pieces.groupBy("length").count().collect())  # at most capacity rows
    runs = best_fit_decreasing(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    # Length and number as one sortable key.
    scale = max(histogram.values(), default=0) + 1
    shared = pieces.sparkSession.sparkContext.broadcast((runs, runs[:, 0] * scale + runs[:, 1]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = shared.value
        for batch in batches:
            number = batch.column("_number").to_numpy()
            length = batch.column("length").to_numpy()
            run = table[np.searchsorted(keys, length * scale + number, "right") - 1]
            ahead = number - run[:, 1]
            found = [
                pa.array(run[:, 2] + ahead // run[:, 3]),
                pa.array(run[:, 4] + ahead % run[:, 3] * length),
            ]
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_number"]
            names = [name for name in batch.schema.names if name != "_number"]
            yield pa.RecordBatch.from_arrays(columns + found, names + ["sequence_id", "offset"])

    numbered = number_rows(pieces, "length", unique, "_number")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.select(*pieces.columns, "_number").mapInArrow(
        place, f"{fields}, sequence_id bigint, offset bigint"
    )


def pack_documents(
    docs: DataFrame,
    workspace: Workspace,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end: int | None = END,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place: id, ``piece, start, length,
    ids_crc32, [ids,] sequence_id, offset``."""
    cut = cut_documents(docs, tokenizer_path, capacity, end, id_column, text_column, with_ids)
    with small_batches(docs.sparkSession):
        pieces = workspace.store(cut, "pieces")
    packed = pack(pieces, ["_id", "piece", "ids_crc32"], capacity)
    return packed.withColumnRenamed("_id", id_column)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed training sequences, from pieces with their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
