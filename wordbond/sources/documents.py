"""N-gram records derived from a table of documents.

Corpora usually come as ready n-gram files. Where there are only documents, the
records are the pairs of neighbouring tokens of each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..settings import shuffle_tasks

# Bytes of text for a task, and those of one year that are counted in one task.
TASK_BYTES, YEAR_BYTES = 8 << 20, 24 << 20
# Tasks for each that years need, since they are dealt by hash and some tasks would get several.
ROOM = 4
# Tasks that read and cut the same texts at most.
MOST_PARTS = 4


def document_year(doc_id: Column | str = "doc_id") -> Column:
    """A stand-in year between 1780 and 2019 for documents that carry none."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.lit(1780) + (doc_id * 37) % 240).cast("int")


def _text_bytes(texts: DataFrame) -> tuple[int, int]:
    """Bytes of all texts and of the year with the most."""
    sums = texts.groupBy("year").agg(F.sum(F.octet_length("text").cast("bigint")).alias("bytes"))
    total, most = sums.agg(F.sum("bytes"), F.max("bytes")).first()
    return total or 0, most or 0


def _dealt(texts: DataFrame, spread: int | None) -> tuple[DataFrame, int]:
    """Texts dealt to tasks, and in how many parts each year is (0: a year is in any task).

    Where a year's texts fit a task, they go there together, so that its pairs are counted
    in place and only texts are shuffled. A larger year goes to a few tasks, each of which
    takes the pairs of its share of the first words. Where that would be many, or leave cores
    without work, texts are dealt by their place in the table.
    """
    cores = texts.sparkSession.sparkContext.defaultParallelism
    total, most = _text_bytes(texts)
    tasks, needed = shuffle_tasks(texts.sparkSession), -(-total // TASK_BYTES)
    parts = max(1, -(-most // YEAR_BYTES), -(-most * cores // max(total, 1)))
    if parts > MOST_PARTS:
        tasks = spread or max(tasks, needed)
        return texts.repartition(tasks, F.monotonically_increasing_id()).withColumn("part", F.lit(0)), 0
    tasks = spread or max(tasks, ROOM * needed)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0)
    return texts.select("*", every.alias("part")).repartition(tasks, "year", *(["part"] if parts > 1 else [])), parts


def document_bigrams(documents: DataFrame, year: Column | None = None, spread: int | None = None) -> DataFrame:
    """``w1, w2, year, match_count``: neighbouring tokens, counted per year.

    Pairs are cut from each document's token array inside its row, so no window
    or join over the document is needed.

    A document grows to some hundred pairs, and the files may be read by few tasks: a
    Parquet row group goes to one, however many documents it holds. So the texts are first
    dealt to ``spread`` tasks (as many as the session has shuffle partitions or cores, or
    more for more than 8 MB of text each, unless given). One job measures the years' texts: where
    each fits a few tasks, a year's texts meet there and no pair is shuffled. Otherwise
    they are dealt by their place in the table, and counts are pre-aggregated before their
    shuffle. 0 leaves the texts where they are, which suits a table whose rows come in
    another order when they are computed again.
    """
    tokens = F.filter(F.split("text", r"\s+"), lambda token: token != "")
    pairs = F.greatest(F.size("tokens") - 1, F.lit(0))
    texts = documents.select((document_year() if year is None else year).alias("year"), "text")
    texts, parts = (texts.withColumn("part", F.lit(0)), 0) if spread == 0 else _dealt(texts, spread)
    found = (
        texts.select("year", "part", tokens.alias("tokens"))
        .select("year", "part", F.explode(F.arrays_zip(
            F.slice("tokens", F.lit(1), pairs).alias("w1"),
            F.slice("tokens", F.lit(2), pairs).alias("w2"),
        )).alias("pair"))
        .select(F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2"), "year", "part")
    )
    if parts > 1:  # the part stays a key, by which Spark knows that equal pairs are in one task
        found = found.filter(F.pmod(F.hash("w1"), F.lit(parts)) == F.col("part"))
        return found.groupBy("w1", "w2", "year", "part").agg(F.count("*").alias("match_count")).drop("part")
    return found.groupBy("w1", "w2", "year").agg(F.count("*").alias("match_count"))


def as_lines(bigrams: DataFrame) -> DataFrame:
    """Bigram rows in the n-gram file layout, with two further columns to ignore."""
    return bigrams.select(F.concat(
        "w1", F.lit(" "), "w2", F.lit("\t"), F.col("year").cast("string"),
        F.lit("\t"), F.col("match_count").cast("string"), F.lit("\t1\t1"),
    ).alias("value"))
