"""Gapless numbers within groups, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Rows that one sort of the numbering may hold.
TARGET_ROWS = 2_000

_PARTS, _PART, _BEFORE, _ROWS = "_parts", "_part", "_before", "_rows"


def number_rows(
    df: DataFrame, key: str, unique: list[str], name: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each value of ``key``, in no special order.

    ``key`` must have a bounded number of values (shards, piece lengths): their
    row counts are broadcast. A value with many rows is dealt by the hash of the
    ``unique`` columns into parts of about ``target_rows``; parts are numbered one
    by one, after the rows of the parts before them. ``df`` is read three times,
    so it should be a stored table. Null keys form a group of their own.
    """
    totals = df.groupBy(key).agg(F.count("*").alias(_ROWS)).select(
        F.col(key).alias("_key"), (F.floor(F.col(_ROWS) / target_rows) + 1).alias(_PARTS)
    )
    dealt = (
        df.join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("_key")))
        .withColumn(_PART, F.pmod(F.xxhash64(*unique), F.col(_PARTS)))
        .drop("_key", _PARTS)
    )
    # The counts are a row per part; a key's parts are few, so this window is small.
    earlier = Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(F.col(key).alias("_key"), F.col(_PART).alias("_p"))
        .agg(F.count("*").alias(_ROWS))
        .select("_key", "_p", F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))
    )
    place = F.row_number().over(Window.partitionBy(key, _PART).orderBy(*unique))
    return (
        dealt.withColumn(name, place - 1)
        .join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col(_PART) == F.col("_p")))
        .withColumn(name, (F.col(name) + F.col(_BEFORE)).cast("bigint"))
        .drop("_key", "_p", _PART, _BEFORE)
    )
