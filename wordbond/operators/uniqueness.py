"""Pairs with several rows, found without moving the pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace
from .counting import PAIR, duplicate_pairs
from .joining import broadcast_if_small

# Keys whose hashes one task of the second step compares, and how much fuller than the
# others a part may be before its keys are taken to repeat.
PART_ROWS, SLACK = 1_000_000, 1.5


def suspicious_hashes(hashes: DataFrame, parts: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Hashes that occur more than once, and the numbers of parts left out as one key may fill them.

    ``hashes`` has the columns ``part`` and ``hash``. Each task packs the hashes of a
    part into one array, so a row for each task and part is shuffled and none for a key.
    Parts that hold far more than their share are left out: there a key repeats very
    often, and an array of its hashes would not be small.
    """
    sizes = hashes.groupBy("part").agg(F.count("*").alias("rows"))
    limit = SLACK * rows / parts + 1000
    overfull = sizes.filter(F.col("rows") > limit).select("part")  # at most parts / SLACK rows
    level = hashes.join(F.broadcast(overfull), "part", "left_anti")
    packed = level.groupBy("part").agg(F.collect_list("hash").alias("hashes"))
    again = packed.select("part", F.explode("hashes").alias("hash")).groupBy("part", "hash").agg(
        F.count("*").alias("copies")
    )
    return again.filter("copies > 1").select("hash"), overfull


def find_duplicate_pairs(
    pairs: DataFrame, workspace: Workspace, stored: bool = False, part_rows: int = PART_ROWS
) -> DataFrame:
    """What :func:`duplicate_pairs` finds, for tables in which few or no keys repeat.

    Only keys whose 64-bit hash repeats go to the exact count. ``pairs`` is stored
    unless ``stored`` says that it comes from files; it is read three times, with its
    three keys only.
    """
    if not stored:
        pairs = workspace.store(pairs.select(*PAIR), "keys")
    keys = pairs.select(*PAIR)
    rows = keys.count()
    parts = max(1, -(-rows // part_rows))
    value = F.xxhash64(*PAIR)
    part = F.pmod(F.shiftright(value, 7), F.lit(parts)).cast("int")
    hashes = keys.select(part.alias("part"), value.alias("hash"))
    repeated, overfull = (
        workspace.store(found, name)
        for found, name in zip(suspicious_hashes(hashes, parts, rows), ("repeated-hashes", "overfull-parts"))
    )
    hashed = keys.select(*PAIR, part.alias("_part"), value.alias("_hash"))
    suspects = hashed.join(broadcast_if_small(repeated), F.col("_hash") == F.col("hash"), "left_semi")
    if not overfull.isEmpty():
        suspects = suspects.union(hashed.join(F.broadcast(overfull), F.col("_part") == F.col("part"), "left_semi"))
    return duplicate_pairs(suspects)


def require_unique_pairs(pairs: DataFrame, workspace: Workspace | None = None, stored: bool = False) -> DataFrame:
    """Return ``pairs``, or raise if a pair has more than one row."""
    found = find_duplicate_pairs(pairs, workspace or Workspace(pairs.sparkSession), stored).take(3)
    if found:
        examples = ", ".join(f"({row.decade}, {row.w1}, {row.w2})" for row in found)
        raise ValueError(f"more than one row for a pair of a decade, such as {examples}")
    return pairs
