"""Row sampling ahead of every other step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def check_fraction(fraction: float) -> float:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    return fraction


def sample_rows(df: DataFrame, fraction: float = 1.0, seed: int | None = None) -> DataFrame:
    """Keep each row with probability ``fraction``."""
    return df if check_fraction(fraction) == 1.0 else df.sample(fraction=fraction, seed=seed)


def sample_rows_by_hash(
    df: DataFrame, fraction: float = 1.0, column: str | tuple[str, ...] = "value"
) -> DataFrame:
    """Keep a row if the hash of ``column``, or of several columns' text, falls under ``fraction``.

    The choice depends on the text alone, so it survives retries and repeats
    whatever the partitioning. Equal texts are kept or dropped together.
    """
    if check_fraction(fraction) == 1.0:
        return df
    if isinstance(column, str):
        text = F.col(column)
    else:  # a tab, which no field of a record holds, and a mark for a missing one
        text = F.concat_ws("\t", *[F.coalesce(F.col(name).cast("string"), F.lit("\n")) for name in column])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.filter(bucket < int(fraction * 2**32))
