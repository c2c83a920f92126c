"""Stop-word lists: one word per line, matched exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.words import check_language

# File name of each language's list inside a stop-word folder.
STOP_WORD_FILES = {
    "english": "eng_stop_words.txt",
    "hebrew": "heb_stop_words.txt",
}


def read_stop_words(spark: SparkSession, path: str, language: str | None = None) -> DataFrame:
    """Read a list from ``path``, or the language's list from the folder ``path``."""
    if language is not None:
        path = f"{path.rstrip('/')}/{STOP_WORD_FILES[check_language(language)]}"
    return spark.read.text(path).select(F.col("value").alias("word"))
