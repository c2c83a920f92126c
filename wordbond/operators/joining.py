"""Joins of detail rows with small or skewed lookup tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..workspace import Workspace
from .naming import unused_names

# A table is broadcast only if its measured size is at most this.
BROADCAST_BYTES = 32 * 1024 * 1024
# Shuffled totals are hashed, sparing the detail a sort, only if a partition of
# them measures at most this.
HASH_BYTES = 64 * 1024 * 1024
# Detail rows of one key that a single task may take before the key is split.
SPLIT_ROWS = 2_000_000
# Allowance per row for offsets and the hash entry of a broadcast table.
_ROW_OVERHEAD = 48


def _row_bytes(columns: list[str]) -> str:
    parts = [f"coalesce(octet_length(cast(`{name}` AS STRING)), 0)" for name in columns]
    return " + ".join([f"{_ROW_OVERHEAD}L", *parts])


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its rows measure at most ``max_bytes``, else ``df``."""
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = df.agg(F.expr(f"sum({_row_bytes(df.columns)})")).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def local_table(
    spark: SparkSession, column: str, values: Iterable[str], max_bytes: int | None = None
) -> DataFrame:
    """Strings given in the program as a table, to be broadcast if they are few."""
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    values = sorted(set(values))
    table = spark.createDataFrame(pa.table({column: pa.array(values, pa.string())}))
    size = sum(_ROW_OVERHEAD + len(value.encode()) for value in values)
    return F.broadcast(table) if size <= limit else table


@dataclass(frozen=True)
class JoinLimits:
    """Measured sizes up to which a join takes the cheaper way; results never depend on them.

    ``broadcast_bytes``: totals that are broadcast. ``hash_bytes``: a partition of
    shuffled totals that is hashed rather than merged. ``split_rows``: detail rows
    of one key that stay in one task. ``hot_list_bytes``: the broadcast list of
    split keys; beyond it only keys with more rows are split.
    """

    broadcast_bytes: int = BROADCAST_BYTES
    hash_bytes: int = HASH_BYTES
    split_rows: int = SPLIT_ROWS
    hot_list_bytes: int = BROADCAST_BYTES


@dataclass(frozen=True)
class Size:
    """What :func:`attach_totals` must know of a totals table before it plans."""

    bytes: int
    detail_rows: int
    hot_keys: int
    hot_row_bytes: int
    split_rows: int

    @staticmethod
    def metrics(columns: list[str], split_rows: int, where: str = "true") -> list[str]:
        """SQL aggregates that measure the rows of a totals table ``where`` holds."""
        size, hot = _row_bytes(columns), f"{where} AND rows > {split_rows}"
        return [
            f"sum(if({where}, {size}, 0))", f"sum(if({where}, rows, 0))",
            f"count_if({hot})", f"max(if({hot}, {size}, 0))",
        ]

    @classmethod
    def of(cls, values: Iterable[int | None], split_rows: int) -> "Size":
        return cls(*[value or 0 for value in values], split_rows)

    @classmethod
    def measure(cls, totals: DataFrame, split_rows: int) -> "Size":
        metrics = map(F.expr, cls.metrics(totals.columns, split_rows))
        return cls.of(totals.agg(*metrics).first(), split_rows)


def store_totals(
    totals: DataFrame,
    workspace: Workspace,
    name: str,
    levels: Iterable[int] | None = None,
    limits: JoinLimits = JoinLimits(),
) -> tuple[DataFrame, dict[int | None, Size]]:
    """Store a totals table and measure it in the same job.

    With ``levels`` the table holds several kinds of totals, told apart by the
    column ``level`` and measured one by one.
    """
    wanted = {None: "true"} if levels is None else {level: f"level = {level}" for level in levels}
    names = {
        level: [f"of_{level}_{place}" for place in range(len(fields(Size)) - 1)] for level in wanted
    }
    metrics = [
        F.expr(metric).alias(alias)
        for level, where in wanted.items()
        for alias, metric in zip(names[level], Size.metrics(totals.columns, limits.split_rows, where))
    ]
    partition_by = None if levels is None else ["level"]
    stored, seen = workspace.store_observed(totals, name, metrics, partition_by)
    return stored, {
        level: Size.of((seen[alias] for alias in names[level]), limits.split_rows) for level in wanted
    }


def attach_totals(
    detail: DataFrame,
    totals: DataFrame,
    keys: list[str],
    spread: list[str],
    size: Size | None = None,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Inner join of ``totals`` to ``detail``, safe for keys with very many rows.

    ``totals`` holds one row per key and a column ``rows``: the number of detail
    rows with that key. Its ``size`` is measured here unless it is given for the
    same limits. If it is small it is broadcast and the detail stays where it is.
    Otherwise both sides are shuffled on the key and hashed or merged. A key with
    more than ``split_rows`` detail rows is split by the hash of the ``spread``
    columns into several tasks, and its one totals row is repeated for each of
    them. The list of such keys is broadcast. If it measures more than
    ``hot_list_bytes``, the threshold rises until it surely fits, since the ``rows``
    add up to the detail rows.
    """
    size = _sized(totals, size, limits)
    if size.bytes <= limits.broadcast_bytes:
        return detail.join(F.broadcast(totals.drop("rows")), keys)
    detail, totals, place = _split_hot(detail, totals, keys, spread, size, limits)
    return _joined(detail, totals.hint(_strategy(detail, size, limits)), keys, place)


def _sized(totals: DataFrame, size: Size | None, limits: JoinLimits) -> Size:
    return size if size is not None and size.split_rows == limits.split_rows else Size.measure(totals, limits.split_rows)


def _strategy(detail: DataFrame, size: Size, limits: JoinLimits) -> str:
    partitions = int(detail.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return "shuffle_hash" if size.bytes <= limits.hash_bytes * partitions else "merge"


def _joined(detail: DataFrame, totals: DataFrame, keys: list[str], place: str | None) -> DataFrame:
    return detail.join(totals, keys) if place is None else detail.join(totals, [*keys, place]).drop(place)


def _split_hot(
    detail: DataFrame, totals: DataFrame, keys: list[str], spread: list[str], size: Size, limits: JoinLimits
) -> tuple[DataFrame, DataFrame, str | None]:
    """Both sides with one more key (its name comes third), which deals hot keys into parts; None if no key is hot."""
    if not size.hot_keys:
        return detail, totals.drop("rows"), None
    split_rows = limits.split_rows
    if size.hot_keys * size.hot_row_bytes > limits.hot_list_bytes:
        fitting = max(1, limits.hot_list_bytes // size.hot_row_bytes)
        split_rows = max(split_rows, -(-size.detail_rows // fitting))
    split_rows = max(split_rows, 1)
    parts = F.ceil(F.col("rows") / F.lit(split_rows)).cast("int")

    in_parts, place = unused_names([*detail.columns, *totals.columns], "_parts", "_salt")
    hot = totals.filter(F.col("rows") > split_rows).select(*keys, parts.alias(in_parts))
    salt = F.pmod(F.xxhash64(*spread), F.coalesce(in_parts, F.lit(1)).cast("bigint")).cast("int")
    salted_detail = (
        detail.join(F.broadcast(hot), keys, "left").withColumn(place, salt).drop(in_parts)
    )
    salted_totals = (
        totals.withColumn(place, F.explode(F.sequence(F.lit(0), parts - 1))).drop("rows")
    )
    return salted_detail, salted_totals, place


@dataclass(frozen=True)
class Located:
    """A detail table stored in buckets of its key, so that totals come to it and it never moves again.

    The rows of a hot key lie in several buckets, dealt as :func:`attach_totals`
    would; ``totals`` repeats its one row for each.
    """

    table: DataFrame
    totals: DataFrame
    keys: list[str]
    place: str | None

    def detail(self) -> DataFrame:
        """The rows, without the part of their key."""
        return self.table if self.place is None else self.table.drop(self.place)

    def attach(self) -> DataFrame:
        """The rows with the totals of their key: only totals are shuffled, to the rows' buckets."""
        return _joined(self.table, self.totals, self.keys, self.place)


def locate(
    detail: DataFrame,
    totals: DataFrame,
    keys: list[str],
    spread: list[str],
    workspace: Workspace,
    size: Size | None = None,
    limits: JoinLimits = JoinLimits(),
    buckets: int | None = None,
) -> Located:
    """Store ``detail`` by ``keys`` in buckets, with hot keys split.

    The buckets are not sorted: Spark does not rely on the order in them, so a merge join
    would sort their rows again.

    Takes ``totals``, ``spread`` and ``size`` as :func:`attach_totals` does. It shuffles the
    detail as that join would, but once for all later joins and sums by the key.
    """
    size = _sized(totals, size, limits)
    detail, totals, place = _split_hot(detail, totals, keys, spread, size, limits)
    dealt = keys if place is None else [*keys, place]
    table = workspace.store_bucketed(detail, "located", dealt, buckets, sort=[])
    return Located(table, totals.hint(_strategy(detail, size, limits)), keys, place)
