"""Saving stage results as Parquet, or in the text layout of the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import order_counts, order_scores


def _save_by_decade(df: DataFrame, path: str, mode: str) -> None:
    # The hint groups rows by decade so that each task writes to few folders,
    # and lets adaptive execution split a decade that is too big for one task.
    writer = df.hint("rebalance", "decade").write.partitionBy("decade")
    if mode == "dynamic":  # only the folders of decades in df are replaced
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def save_pair_counts(pair_counts: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet, one folder per decade; ``mode="dynamic"`` replaces the folders of the given decades only."""
    _save_by_decade(pair_counts, path, mode)


def save_pair_scores(scores: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet, one folder per decade; ``mode="dynamic"`` replaces the folders of the given decades only."""
    _save_by_decade(scores, path, mode)


def _keyed_line(*values: str):
    text = [F.col(name).cast("string") for name in ("decade", "w1", "w2")]
    return F.concat_ws(
        "\t", F.concat_ws(",", *text), F.concat_ws(",", *[F.col(v).cast("string") for v in values])
    ).alias("value")


def save_pair_count_lines(
    pair_counts: DataFrame, path: str, mode: str = "error", ordered: bool = False
) -> None:
    """Text lines ``decade,w1,w2 TAB c12,n,c1``; ``ordered`` sorts them over all files."""
    rows = order_counts(pair_counts) if ordered else pair_counts
    rows.select(_keyed_line("c12", "n", "c1")).write.mode(mode).text(path)


def save_pair_score_lines(
    scores: DataFrame, path: str, mode: str = "error", ordered: bool = False
) -> None:
    """Text lines ``decade,w1,w2 TAB npmi``; ``ordered`` sorts them over all files."""
    rows = order_scores(scores) if ordered else scores
    rows.select(_keyed_line("npmi")).write.mode(mode).text(path)
