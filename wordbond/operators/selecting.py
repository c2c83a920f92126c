"""Choice of the pairs worth reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..workspace import Workspace
from .joining import broadcast_if_small
from .naming import unused_names
from .ranging import by_score, count_ranges


def keep_high_scores(scores: DataFrame, min_npmi: float, rel_min_npmi: float) -> DataFrame:
    """Keep a pair if its score or its relative score reaches the threshold.

    Written as a negation because a NaN fails both comparisons and is to be kept.
    """
    return scores.filter(~((F.col("npmi") < min_npmi) & (F.col("rel_npmi") < rel_min_npmi)))


def drop_high_scores(scores: DataFrame, max_npmi: float | None) -> DataFrame:
    """Drop scores above ``max_npmi``; NaN, which Spark sorts highest, is kept."""
    if max_npmi is None:
        return scores
    return scores.filter(F.isnan("npmi") | (F.col("npmi") <= max_npmi))


def drop_self_pairs(scores: DataFrame) -> DataFrame:
    """Drop pairs of a word with itself."""
    return scores.filter(F.col("w1") != F.col("w2"))


def drop_repeated_scores(scores: DataFrame) -> DataFrame:
    """One row per (decade, score, pair), for results read from several files."""
    return scores.dropDuplicates(["decade", "npmi", "w1", "w2"])


def top_k_per_decade(
    scores: DataFrame, k: int, workspace: Workspace | None = None, stored: bool = False
) -> DataFrame:
    """The ``k`` best pairs of each decade, ties broken by the words.

    One way for every ``k``, and no decade is ranked in one task. ``scores`` is
    computed once: it is stored, unless ``stored`` says that it comes from files.
    Scores rounded to three digits are counted per decade; rows below the level that
    holds the k-th best go at once, and what is left is sorted in ranges that these
    counts give. A row's place in its decade is its place in its partition plus the
    rows of the partitions before, of which there is a small table.
    """
    workspace = workspace or Workspace(scores.sparkSession)
    if k < 1:
        return scores.limit(0)
    if not stored:
        scores = workspace.store(scores, "scores")
    ranges = count_ranges(scores, by_score(), workspace, first=k)
    place, decade, at, offset = unused_names(scores.columns, "_place", "_decade", "_part", "_offset")
    ranked = workspace.store(
        ranges.sort(scores).withColumn(place, F.monotonically_increasing_id()), "top-ranges"
    )
    part = F.shiftright(place, 33)  # the upper bits of the number are the partition
    parts = ranked.groupBy(F.col("decade").alias(decade), part.alias(at)).agg(
        F.min(place).alias("first"), F.count("*").alias("rows")
    )
    before = F.sum("rows").over(Window.partitionBy(decade).orderBy(at)) - F.col("rows")
    offsets = workspace.store(parts.select(decade, at, (before - F.col("first")).alias(offset)), "top-offsets")
    return ranked.join(
        broadcast_if_small(offsets),
        F.col("decade").eqNullSafe(F.col(decade)) & (part == F.col(at)) & (F.col(place) + F.col(offset) < k),
    ).drop(place, decade, at, offset)
