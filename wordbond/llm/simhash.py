"""Near-duplicates by SimHash, linked with multi-index hashing.

A text's words (runs without blank, tab or line end) are lower-cased in A-Z and
cut into overlapping shingles; a text of fewer words is one shingle, and a text
without words has fingerprint zero, linked like any other. Null counts as empty.
A bit is 1 if more than half of the shingles' hashes have it set.

Fingerprints are cut into segments. If two differ in at most ``distance`` bits,
then in some segment they differ in no more than its radius, so looking up the
small ball around each segment value finds every such pair; whole distances are
checked inside the join. Equal fingerprints are collapsed before, so copies cost
one row, and components need no list of all pairs in a group.

Repeated rows and equal ids each give a row. An empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joining import attach_totals, broadcast_if_small, store_totals
from ..workspace import Workspace
from .batches import small_batches
from .components import components
from .words import binary_values

SHINGLE, DISTANCE, SEGMENTS = 4, 4, 3
_SEED = 42
# Bytes of one text that are cut into words at a time, and hashes counted at a time.
_BLOCK, _HASHES = 1 << 20, 1 << 17
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words in blocks that overlap by one shingle less a word."""
    at, carry = 0, []
    while at < len(text):
        end = len(text)
        if end - at > _BLOCK:
            gap = _SPACE.search(text, at + _BLOCK)
            end = gap.start() if gap else end
        words = carry + text[at:end].split()
        if len(words) >= shingle or end == len(text):
            yield words
            carry = words[len(words) - shingle + 1:] if shingle > 1 else []
        else:
            carry = words
        at = end


def _hashes(words: list[bytes], shingle: int) -> list[int]:
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], _SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]


def _count_bits(hashes: list[int], starts: list[int]) -> np.ndarray:
    bits = np.unpackbits(
        np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


class _Counter:
    """Set bits and shingles of texts, counted for many texts in one go."""

    def __init__(self, texts: int):
        self.ones = np.zeros((texts, 64), np.int64)
        self.shingles = np.zeros(texts, np.int64)
        self.hashes, self.starts, self.owners = [], [], []

    def add(self, text: int, hashes: list[int]) -> None:
        if hashes:
            self.starts.append(len(self.hashes))
            self.owners.append(text)
            self.hashes += hashes
            self.shingles[text] += len(hashes)
        if len(self.hashes) >= _HASHES:
            self.flush()

    def flush(self) -> None:
        if self.hashes:
            np.add.at(self.ones, self.owners, _count_bits(self.hashes, self.starts))
            self.hashes, self.starts, self.owners = [], [], []

    def fingerprints(self) -> np.ndarray:
        self.flush()
        majority = (2 * self.ones > self.shingles[:, None]).astype(np.uint8)
        return np.packbits(majority, axis=1, bitorder="little").view("<i8").ravel()


def simhash(texts: Iterable[bytes], count: int, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of ``count`` UTF-8 texts as signed 64-bit numbers."""
    counter = _Counter(count)
    for place, text in enumerate(texts):
        first = True
        for words in _word_blocks(text.lower(), shingle):
            if len(words) >= shingle:
                counter.add(place, _hashes(words, shingle))
            elif words and first:
                counter.add(place, _hashes(words, len(words)))
            first = False
    return counter.fingerprints()


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``_id, fp``: each document's fingerprint as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = simhash(binary_values(batch.column(1)), batch.num_rows, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["_id", "fp"])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("t"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, fp bigint")


def _fingerprint_column(text: Column, shingle: int) -> Column:
    """The fingerprint of each text, for rows that keep their other columns."""
    @F.arrow_udf("bigint")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(simhash(binary_values(column), len(column), shingle), pa.int64())

    return run(text.cast("binary"))


def _segments(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """Shift, width and radius of each segment.

    If every segment differed in more than its radius, the whole would differ in
    at least (sum of radii + segments) bits, so radii adding up to
    ``distance - segments + 1`` are enough.
    """
    spare = max(distance - segments + 1, 0)
    used = min(segments, distance + 1)
    found, shift = [], 0
    for i in range(used):
        width = 64 // used + (i < 64 % used)
        found.append((shift, width, spare // used + (i < spare % used)))
        shift += width
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segment_key(shift: int, width: int, place: int, value: str) -> str:
    bits = f"shiftrightunsigned({value}, {shift}) & {_signed((1 << width) - 1)}L"
    return f"struct({place} AS place, {bits} AS bits)"


def near_fingerprints(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs of distinct fingerprints (column ``fp``) that differ in at most ``distance`` bits.

    More documents want longer and so fewer segments: 3 serve some hundred million
    fingerprints, 2 serve some hundred billion with larger balls. The result is
    the same. A pair found in several segments comes as often.
    """
    cut = _segments(distance, segments)
    table = fps.selectExpr(
        "fp AS other",
        "explode(array(" + ", ".join(
            _segment_key(s, w, i, "fp") for i, (s, w, _) in enumerate(cut)
        ) + ")) AS key",
    )
    balls = []
    for place, (shift, width, radius) in enumerate(cut):
        masks = [
            _signed(sum(1 << (shift + bit) for bit in bits))
            for size in range(radius + 1) for bits in itertools.combinations(range(width), size)
        ]
        # The highest bit of the mask differs between the two, so only one of them asks.
        ask = (
            fps.withColumn("mask", F.explode(F.lit(masks).cast("array<bigint>")))
            .filter("mask = 0 OR fp < (fp ^ mask)")
            .selectExpr("fp", "mask", _segment_key(shift, width, place, "(fp ^ mask)") + " AS key")
        )
        balls.append(ask)
    asked = balls[0]
    for ball in balls[1:]:
        asked = asked.union(ball)
    found = asked.join(table, (asked["key"] == table["key"]) & F.expr(
        f"bit_count(fp ^ other) <= {distance} AND (mask <> 0 OR fp < other)"
    ))
    return found.select("fp", "other")


def _rooted(
    docs: DataFrame,
    workspace: Workspace,
    id_column: str,
    text_column: str,
    shingle: int,
    distance: int,
    segments: int,
) -> tuple[DataFrame, DataFrame]:
    """Stored ``_id, fp`` of each document, and ``fp, least, rows, root`` of each fingerprint."""
    with small_batches(docs.sparkSession):
        prints = workspace.store(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    classes = workspace.store(
        prints.groupBy("fp").agg(F.min("_id").alias("least"), F.count("*").alias("rows")), "classes"
    )
    links = near_fingerprints(classes.select("fp"), distance, segments)
    roots = components(links, workspace)
    return prints, workspace.store(
        classes.join(roots, classes["fp"] == roots["u"], "left").select(
            "fp", "least", "rows", F.coalesce("v", "fp").alias("root")
        ), "roots",
    )


def _name_groups(prints: DataFrame, rooted: DataFrame, workspace: Workspace) -> DataFrame:
    """``_id, fp, component_id`` of each document."""
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("rows"))
    stored, sizes = store_totals(smallest, workspace, "components")
    named = attach_totals(rooted.withColumnRenamed("rows", "_n"), stored, ["root"], ["fp"], sizes[None])
    per_print, print_sizes = store_totals(
        named.select("fp", "component_id", F.col("_n").alias("rows")), workspace, "members"
    )
    return attach_totals(prints, per_print, ["fp"], ["_id"], print_sizes[None])


def simhash_groups(
    docs: DataFrame,
    workspace: Workspace,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` bits.
    """
    prints, rooted = _rooted(docs, workspace, id_column, text_column, shingle, distance, segments)
    return _name_groups(prints, rooted, workspace).select(
        F.col("_id").alias(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def drop_near_copies(
    docs: DataFrame,
    workspace: Workspace,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns, whatever their names.

    A null id is the largest. If an id repeats, its rows are decided one by one, each
    in its own group. If the smallest id repeats within a group, one of its rows with
    the smallest fingerprint (as a signed number) stays.
    """
    prints, rooted = _rooted(docs, workspace, id_column, text_column, shingle, distance, segments)
    gone = workspace.store(
        _name_groups(prints, rooted, workspace).filter("_id <> component_id")
        .select(F.col("_id").alias("_gone")).distinct(), "near-copies",
    )
    # A document is one struct here, so that no name of its columns meets those below.
    whole = docs.select(
        F.struct("*").alias("_all"), F.col(id_column).alias("_id"), F.col(text_column).alias("_text")
    )
    own = F.col("_id")
    # Ids that don't tell their rows apart.
    unclear = workspace.store(
        prints.groupBy(F.col("_id").alias("_unclear")).agg(F.count("*").alias("_n"))
        .filter("_n > 1 OR _unclear IS NULL").select("_unclear"), "repeated-ids",
    )
    if unclear.isEmpty():
        return whole.join(broadcast_if_small(gone), own == F.col("_gone"), "left_anti").select("_all.*")
    unclear = broadcast_if_small(unclear)
    clear = whole.join(unclear, own.eqNullSafe(F.col("_unclear")), "left_anti").join(
        broadcast_if_small(gone), own == F.col("_gone"), "left_anti"
    )
    # A fingerprint is in one group only, so id and fingerprint name the row that stays.
    first = F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("_first")
    stays = workspace.store(
        rooted.groupBy("root").agg(first).select(F.col("_first.least").alias("_stays"), F.col("_first.fp").alias("_print"))
        .join(unclear, F.col("_stays").eqNullSafe(F.col("_unclear")), "left_semi"), "rows-that-stay",
    )
    judged = whole.join(unclear, own.eqNullSafe(F.col("_unclear")), "left_semi").withColumn(
        "_own", _fingerprint_column(F.col("_text"), shingle)
    )
    kept = judged.join(
        broadcast_if_small(stays),
        own.eqNullSafe(F.col("_stays")) & F.col("_own").eqNullSafe(F.col("_print")), "left_semi",
    )
    return clear.select("_all").union(kept.dropDuplicates(["_id", "_own"]).select("_all")).select("_all.*")
