"""Global orders and ranks from counted ranges.

``orderBy`` computes its input twice, once for a sample that sets the range bounds.
Here the input is stored once, and a histogram of the leading digits of its sort key
gives exact bounds: cells of equal digits, in order, are filled into ranges of about
equal size, and a row's cell tells its partition. A cell with more rows than a range
is counted again by the next digit, and so on, until the digits hold the whole key;
rows of one key that are still too many have no order among them and are dealt out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import Workspace
from .joining import broadcast_if_small
from .naming import unused_names

# Rows that a range holds at least before another is begun.
RANGE_ROWS = 100_000
# Digits that the first histogram counts by.
_FIRST = 2


@dataclass(frozen=True)
class SortKey:
    """``digits`` refine each other: sorted ascending, nulls first, they follow ``order``, and the last completes it.

    The first digit is a group (the decade): no range spans two.
    """

    digits: tuple[Column, ...]
    order: tuple[Column, ...]


def _beginning(word: str) -> Column:
    return F.substring(word, 1, 2)


def by_words(first: str, second: str) -> SortKey:
    """By decade and two words."""
    return SortKey(
        (F.col("decade"), _beginning(first), F.col(first), _beginning(second), F.col(second)),
        (F.asc("decade"), F.asc(first), F.asc(second)),
    )


def by_score() -> SortKey:
    """By decade, falling score and both words; NaN comes first and null last, as Spark sorts them."""
    score = F.col("npmi")
    level = F.when(F.isnan(score), 2.0).when(score.isNull(), -2.0).otherwise(
        F.greatest(F.least(F.round(score, 3), F.lit(1.001)), F.lit(-1.001))
    )
    return SortKey(
        (F.col("decade"), -level, -F.round(score, 6), -score, _beginning("w1"), F.col("w1"), _beginning("w2"), F.col("w2")),
        (F.asc("decade"), F.desc("npmi"), F.asc("w1"), F.asc("w2")),
    )


@dataclass(frozen=True)
class Ranges:
    """Cells with the numbers of their ranges, a table for each number of digits that occurs."""

    key: SortKey
    names: list[str]
    cells: dict[int, DataFrame]
    partitions: int

    def deal(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """Rows in a cell, with the range of each in a new column of the name returned."""
        range_of, spread = self.names[-2:]
        found = []
        for depth, cells in self.cells.items():
            first, parts = unused_names([*rows.columns, *self.names], "_range", "_spread")
            rows = rows.join(
                broadcast_if_small(cells.withColumnsRenamed({range_of: first, spread: parts})),
                _same(self.key.digits[:depth], self.names), "left",
            ).drop(*self.names[:depth])
            # Rows with equal keys, of which there are more than a range holds.
            among = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(parts)).cast("int")
            number = F.col(first) + F.when(F.col(parts) > 1, among).otherwise(0)
            rows = rows.withColumn(first, number).drop(parts)
            found.append(first)
        (name,) = unused_names(rows.columns, "_part")
        part = F.coalesce(*found) if len(found) > 1 else F.col(found[0])
        return rows.withColumn(name, part).filter(F.col(name).isNotNull()).drop(*found), name

    def sort(self, rows: DataFrame) -> DataFrame:
        """The rows in a cell, in order over all partitions."""
        if not self.partitions:
            return rows.limit(0)
        dealt, part = self.deal(rows)
        return dealt.repartitionById(self.partitions, F.col(part)).drop(part).sortWithinPartitions(*self.key.order)


def _same(digits: tuple[Column, ...], names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [digit.eqNullSafe(F.col(name)) for digit, name in zip(digits, names)])


def _count(rows: DataFrame, key: SortKey, names: list[str], depth: int) -> DataFrame:
    digits = [digit.alias(name) for digit, name in zip(key.digits[:depth], names)]
    return rows.groupBy(*digits).agg(F.count("*").alias("rows"))


def _before(names: list[str]) -> Column:
    """Rows of the cells before a cell in its group: a window over a group's cells, not its rows."""
    return F.sum("rows").over(Window.partitionBy(names[0]).orderBy(*names[1:])) - F.col("rows")


def count_ranges(
    rows: DataFrame,
    key: SortKey,
    workspace: Workspace,
    partitions: int | None = None,
    range_rows: int = RANGE_ROWS,
    first: int | None = None,
) -> Ranges:
    """Ranges for a stored table, about as many as ``partitions`` (the session's shuffle partitions).

    With ``first`` only the cells that may hold the first rows of each group are kept.
    """
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = len(key.digits)
    *names, range_of, spread = unused_names(rows.columns, *[f"_digit{n}" for n in range(digits)], "_range", "_spread")

    def counted(found: DataFrame, depth: int) -> tuple[DataFrame, dict]:
        return workspace.store_observed(found, f"cells-{depth}", [
            F.sum("rows").alias("rows"), F.max("rows").alias("most")
        ])

    depth = min(_FIRST, digits)
    found = _count(rows, key, names, depth)
    if first is not None:
        cells = workspace.store(found, "cells")
        found = cells.withColumn("_before", _before(names[:depth])).filter(F.col("_before") < first).drop("_before")
    cells, seen = counted(found, depth)
    size = max(range_rows, -(-(seen["rows"] or 0) // partitions))
    leaves: list[DataFrame] = []
    while (seen["most"] or 0) > size and depth < digits:
        leaves.append(cells.filter(F.col("rows") <= size).withColumn("_depth", F.lit(depth)))
        hot = broadcast_if_small(cells.filter(F.col("rows") > size).drop("rows"))
        inside = rows.join(hot, _same(key.digits[:depth], names), "left_semi")
        depth += 1
        cells, seen = counted(_count(inside, key, names, depth), depth)
    leaves.append(cells.withColumn("_depth", F.lit(depth)))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), leaves)
    group = every.groupBy(F.col(names[0]).alias("_group")).agg(F.sum("rows").alias("_all"))
    ranges = F.floor((F.col("_all") - 1) / size) + 1
    groups = group.withColumn("_first", F.sum(ranges).over(Window.orderBy("_group")) - ranges)  # a row per decade
    numbered = every.withColumn("_before", _before(names[:depth])).join(
        F.broadcast(groups), F.col(names[0]).eqNullSafe(F.col("_group"))
    )
    last = F.floor((F.col("_before") + F.col("rows") - 1) / size)
    this = F.floor(F.col("_before") / size)
    table, seen = workspace.store_observed(numbered.select(
        *names[:depth], "_depth", (F.col("_first") + this).cast("int").alias(range_of),
        F.when((F.col("_depth") == digits) & (F.col("rows") > size), last - this + 1).otherwise(1).cast("int").alias(spread),
    ), "ranges", [F.max(F.col(range_of) + F.col(spread)).alias("partitions")])
    return Ranges(key, [*names, range_of, spread], {
        at: table.filter(F.col("_depth") == at).select(*names[:at], range_of, spread)
        for at in range(min(_FIRST, digits), depth + 1)
    }, seen["partitions"] or 0)


def range_sorted(
    rows: DataFrame,
    key: SortKey,
    workspace: Workspace | None = None,
    stored: bool = False,
    partitions: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``rows`` in order over all partitions; they are computed once, and stored unless ``stored`` says they are."""
    workspace = workspace or Workspace(rows.sparkSession)
    if not stored:
        rows = workspace.store(rows, "unordered")
    return count_ranges(rows, key, workspace, partitions, range_rows).sort(rows)
