"""Output orders. All sort by full keys in counted ranges, so a large decade spans many tasks.

The input is computed once: it is stored first, unless ``stored`` says that it
comes from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..workspace import Workspace
from .ranging import by_score, by_words, range_sorted


def order_counts(counts: DataFrame, workspace: Workspace | None = None, stored: bool = False) -> DataFrame:
    """By decade, first word, second word."""
    return range_sorted(counts, by_words("w1", "w2"), workspace, stored)


def order_scores(scores: DataFrame, workspace: Workspace | None = None, stored: bool = False) -> DataFrame:
    """By decade, second word, first word."""
    return range_sorted(scores, by_words("w2", "w1"), workspace, stored)


def order_collocations(
    collocations: DataFrame, workspace: Workspace | None = None, stored: bool = False
) -> DataFrame:
    """By decade, falling score, first word, second word."""
    return range_sorted(collocations, by_score(), workspace, stored)


def order_top_rows(top: DataFrame) -> DataFrame:
    """The same order for rows that a stage table holds, of which there are few: no counting, but a sample."""
    return top.orderBy(*by_score().order)
