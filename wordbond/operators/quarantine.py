"""Bad rows set aside instead of failing the job or vanishing."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.words import decade_of, fold_case, in_alphabet
from ..workspace import Workspace
from .cleaning import drop_stop_words

REASONS = ("fewer than two words", "year does not parse", "count does not parse", "count below one")


@dataclass(frozen=True)
class Quarantined:
    """Clean rows, bad rows, and how many there are of either: ``counts`` by reason, and ``kept``."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def _reason(short: Column) -> Column:
    tests = (short, F.col("year").isNull(), F.col("match_count").isNull(), F.col("match_count") < 1)
    chosen = F.when(tests[0], REASONS[0])
    for test, reason in zip(tests[1:], REASONS[1:]):
        chosen = chosen.when(test, reason)
    return chosen


def _records(lines: DataFrame) -> DataFrame:
    """``value, file`` and the fields of a record; words of a record without two are null."""
    tokens = F.split(F.col("value"), r"\s+", 5)
    split = lines.select("value", F.input_file_name().alias("file"), F.explode(F.array(tokens)).alias("t"))
    short = F.coalesce(F.get("t", F.lit(1)), F.lit("")) == ""
    return split.select(
        "value", "file", short.alias("short"),
        *[F.when(~short, F.get("t", F.lit(place))).alias(name) for place, name in enumerate(("w1", "w2"))],
        F.get("t", F.lit(2)).try_cast("int").alias("year"),
        F.get("t", F.lit(3)).try_cast("bigint").alias("match_count"),
    )


def quarantine_ngrams(
    lines: DataFrame,
    stop_words: DataFrame | Iterable[str] | None,
    language: str,
    workspace: Workspace,
    path: str | None = None,
    write_mode: str = "error",
) -> Quarantined:
    """Clean rows ``decade, w1, w2, match_count``, and bad rows ``reason, file, value``.

    Rows that a word filter removes are not judged, as everywhere; a record of fewer
    than two words is bad at once. One pass writes both kinds, each to a folder of its
    own, and counts them on the way. With ``path`` the bad rows are saved there too.
    """
    records = _records(lines)
    folded = records.withColumns({word: fold_case(word, language) for word in ("w1", "w2")})
    words = folded.filter(F.col("short") | (in_alphabet("w1", language) & in_alphabet("w2", language)))
    judged = drop_stop_words(words, stop_words).withColumn("reason", _reason(F.col("short")))
    bad = F.col("reason").isNotNull()
    rows = judged.select(
        F.when(~bad, decade_of("year")).alias("decade"), *[F.when(~bad, F.col(n)).alias(n) for n in ("w1", "w2", "match_count")],
        "reason", F.when(bad, F.col("file")).alias("file"), F.when(bad, F.col("value")).alias("value"),
        F.when(bad, "rejected").otherwise("kept").alias("status"),
    )
    metrics = [F.count_if(~bad).alias("kept")] + [
        F.count_if(F.col("reason") == reason).alias(f"bad_{place}") for place, reason in enumerate(REASONS)
    ]
    stored, seen = workspace.store_observed(rows, "judged", metrics, ["status"])
    kept = stored.filter("status = 'kept'").select("decade", "w1", "w2", "match_count")
    rejected = stored.filter("status = 'rejected'").select("reason", "file", "value")
    if path is not None:
        rejected.write.mode(write_mode).parquet(path)
    counts = {reason: seen[f"bad_{place}"] or 0 for place, reason in enumerate(REASONS)}
    return Quarantined(kept, rejected, {"kept": seen["kept"] or 0} | counts)
