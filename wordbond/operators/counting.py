"""Pair counts and the totals above them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace
from .joining import JoinLimits, Located, Size, attach_totals, locate, store_totals

PAIR = ["decade", "w1", "w2"]

# Values of grouping_id(decade, w1, w2): a bit is set for each column summed over.
PAIR_LEVEL, LEFT_LEVEL, RIGHT_LEVEL, DECADE_LEVEL = 0, 1, 2, 3
_LEVEL_KEYS = {
    PAIR_LEVEL: PAIR,
    LEFT_LEVEL: ["decade", "w1"],
    RIGHT_LEVEL: ["decade", "w2"],
    DECADE_LEVEL: ["decade"],
}
_TOTAL_NAMES = {LEFT_LEVEL: "c1", RIGHT_LEVEL: "c2", DECADE_LEVEL: "n"}
MARGINAL_LEVELS = (LEFT_LEVEL, RIGHT_LEVEL, DECADE_LEVEL)


def count_pairs_per_decade(ngrams: DataFrame) -> DataFrame:
    """``c12``: the summed count of each ordered pair in each decade."""
    return ngrams.groupBy(*PAIR).agg(F.sum("match_count").alias("c12"))


def decade_totals(pairs: DataFrame) -> DataFrame:
    """``n``: the summed count of all pairs of a decade."""
    return pairs.groupBy("decade").agg(F.sum("c12").alias("n"))


def count_rollup(pairs: DataFrame, levels=(PAIR_LEVEL, *MARGINAL_LEVELS)) -> DataFrame:
    """Sums of ``c12`` at several levels, each from the smallest table that holds it.

    The words' sums come from the pairs, each from a scan of its own two keys and the
    count, with no copy of a row for each level. The decade's come from the words' sums,
    which Spark computes once for both. ``rows`` says how many pairs a sum covers,
    which later tells how many detail rows a key will meet in a join.
    """
    kinds = dict(pairs.dtypes)
    words = RIGHT_LEVEL if RIGHT_LEVEL in levels and LEFT_LEVEL not in levels else LEFT_LEVEL

    def of_pairs(level: int) -> DataFrame:
        return pairs.groupBy(*_LEVEL_KEYS[level]).agg(F.sum("c12").alias("total"), F.count("*").alias("rows"))

    def totals(level: int) -> DataFrame:
        if level != DECADE_LEVEL:
            return of_pairs(level)
        return of_pairs(words).groupBy("decade").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))

    return reduce(DataFrame.union, [
        totals(level).select(*[
            (F.col(name) if name in _LEVEL_KEYS[level] else F.lit(None).cast(kinds[name])).alias(name) for name in PAIR
        ], F.lit(level).alias("level"), "total", "rows")
        for level in levels
    ])


@dataclass(frozen=True)
class Marginal:
    """One level of totals, stored and measured."""

    table: DataFrame
    size: Size

    limits: JoinLimits

    def attach(
        self, pairs: DataFrame, keys: list[str], spread: list[str], limits: JoinLimits | None = None
    ) -> DataFrame:
        return attach_totals(pairs, self.table, keys, spread, self.size, limits or self.limits)


def marginals(
    pairs: DataFrame, workspace: Workspace, levels=MARGINAL_LEVELS, limits: JoinLimits = JoinLimits()
) -> dict[int, Marginal]:
    """Per-decade totals and word marginals of a pair table, by level.

    ``limits`` hold for the joins that attach them.
    """
    stored, sizes = store_totals(
        count_rollup(pairs, levels), workspace, "marginals", levels, limits
    )
    return {
        level: Marginal(
            stored.filter(F.col("level") == level).select(
                *_LEVEL_KEYS[level], F.col("total").alias(_TOTAL_NAMES[level]), "rows"
            ),
            sizes[level], limits,
        )
        for level in levels
    }


def attach_decade_total(
    pairs: DataFrame, counted: dict[int, Marginal], limits: JoinLimits | None = None
) -> DataFrame:
    """Add ``n``, the count of all pairs of the decade."""
    return counted[DECADE_LEVEL].attach(pairs, ["decade"], ["w1", "w2"], limits)


def attach_left_marginal(
    pairs: DataFrame, counted: dict[int, Marginal], limits: JoinLimits | None = None
) -> DataFrame:
    """Add ``c1``, the count of all pairs of the decade that begin with ``w1``."""
    return counted[LEFT_LEVEL].attach(pairs, ["decade", "w1"], ["w2"], limits)


def attach_right_marginal(
    pairs: DataFrame, counted: dict[int, Marginal], limits: JoinLimits | None = None
) -> DataFrame:
    """Add ``c2``, the count of all pairs of the decade that end with ``w2``."""
    return counted[RIGHT_LEVEL].attach(pairs, ["decade", "w2"], ["w1"], limits)


def locate_by_left(
    pairs: DataFrame, counted: dict[int, Marginal], workspace: Workspace, limits: JoinLimits | None = None
) -> Located:
    """The pairs stored by decade and first word; ``attach`` adds ``c1`` where they lie."""
    left = counted[LEFT_LEVEL]
    return locate(pairs, left.table, ["decade", "w1"], ["w2"], workspace, left.size, limits or left.limits)


def duplicate_pairs(pairs: DataFrame) -> DataFrame:
    """Keys that occur in more than one row, with the number of rows."""
    return pairs.groupBy(*PAIR).agg(F.count("*").alias("copies")).filter("copies > 1")
