"""Scores of counted pairs and their totals per decade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.association import npmi, relative, share
from ..functions.sums import exact_sum

TOTAL_SCOPES = ("decade", "running")


def is_whole_decade():
    """True where a pair is all there is in its decade, so NPMI is undefined."""
    return share("c12", "n") == 1.0


def drop_whole_decade_pairs(counts: DataFrame) -> DataFrame:
    return counts.filter(~is_whole_decade())


def whole_decade_pairs(counts: DataFrame) -> DataFrame:
    """The rows :func:`drop_whole_decade_pairs` removes."""
    return counts.filter(is_whole_decade())


def with_npmi(counts: DataFrame) -> DataFrame:
    """Add ``npmi`` to rows with ``c12, n, c1, c2``; undefined rows are dropped."""
    return drop_whole_decade_pairs(counts).withColumn("npmi", npmi())


def npmi_totals(scores: DataFrame) -> DataFrame:
    """``total_npmi`` per decade, with the number of pairs it covers.

    The sum is the same to the last bit however the rows are dealt and ordered, and
    so are relative scores and what a threshold on them keeps.
    """
    return scores.groupBy("decade").agg(
        exact_sum("npmi").alias("total_npmi"), F.count("*").alias("rows")
    )


def running_npmi_totals(totals: DataFrame, buckets: int = 11) -> DataFrame:
    """Totals that also include earlier decades with the same ``decade % buckets``.

    ``totals`` has one row per decade, so the window is over a handful of rows.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    earlier = (
        Window.partitionBy(F.col("decade") % buckets)
        .orderBy("decade")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return totals.withColumn("total_npmi", F.sum("total_npmi").over(earlier))


def scoped_totals(scores: DataFrame, total_scope: str = "decade", buckets: int = 11) -> DataFrame:
    """Totals per decade, alone or running over the decades of a bucket."""
    if total_scope not in TOTAL_SCOPES:
        raise ValueError(f"total_scope must be one of {TOTAL_SCOPES}, not {total_scope!r}")
    totals = npmi_totals(scores)
    return running_npmi_totals(totals, buckets) if total_scope == "running" else totals


def with_relative_npmi(scores: DataFrame) -> DataFrame:
    """Add ``rel_npmi``, the score as a part of ``total_npmi``."""
    return scores.withColumn("rel_npmi", relative())
