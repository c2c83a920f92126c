"""Row filters that run before any counting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.words import decade_of, fold_case, in_alphabet
from .joining import broadcast_if_small, local_table

# What becomes of rows without a valid year and count; QUARANTINE is one of whole plans.
MODES = ("FAILFAST", "DROPMALFORMED")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return mode


def keep_language(ngrams: DataFrame, language: str) -> DataFrame:
    """Fold case, then keep rows whose two words consist of the language's letters."""
    folded = ngrams.withColumns({w: fold_case(w, language) for w in ("w1", "w2")})
    return folded.filter(in_alphabet("w1", language) & in_alphabet("w2", language))


def drop_stop_words(
    ngrams: DataFrame,
    stop_words: DataFrame | Iterable[str] | None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Drop rows where either word is a stop word, matched exactly.

    ``stop_words`` is a table with a column ``word``, or words given in the
    program. They are broadcast if their measured size allows. A larger list
    becomes two shuffled anti joins, whose hot words adaptive execution splits.
    """
    if isinstance(stop_words, str):
        raise TypeError("stop_words takes a table or words, not a single string")
    if stop_words is None:
        return ngrams
    if isinstance(stop_words, DataFrame):
        words = broadcast_if_small(stop_words.select("word"), broadcast_bytes)
    else:
        words = local_table(ngrams.sparkSession, "word", stop_words, broadcast_bytes)
    for side in ("w1", "w2"):
        ngrams = ngrams.join(words, ngrams[side] == words["word"], "left_anti")
    return ngrams


def reject_malformed(ngrams: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Fail on, or drop, rows without a valid year and a count of at least one."""
    valid = F.coalesce(F.col("year").isNotNull() & (F.col("match_count") >= 1), F.lit(False))
    if check_mode(mode) == "DROPMALFORMED":
        return ngrams.filter(valid)
    error = F.raise_error(F.concat(
        F.lit("malformed n-gram row: year or count does not parse for "), "w1", F.lit(" "), "w2",
    ))
    # The row number makes the filter one that Catalyst neither drops, whatever
    # columns are read, nor moves below the stop-word joins, where it would judge
    # rows these joins remove.
    always = F.monotonically_increasing_id() >= 0
    return ngrams.filter(F.when(valid, always).otherwise(error))


def with_decade(ngrams: DataFrame) -> DataFrame:
    """Replace the year by its decade."""
    return ngrams.select(decade_of("year").alias("decade"), "w1", "w2", "match_count")
