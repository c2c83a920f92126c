"""Reading back what an earlier run saved."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import require_ansi

PAIR_COUNTS_SCHEMA = "decade INT, w1 STRING, w2 STRING, c12 BIGINT, n BIGINT, c1 BIGINT"
PAIR_SCORES_SCHEMA = f"{PAIR_COUNTS_SCHEMA}, c2 BIGINT, npmi DOUBLE"


def load_pair_counts(spark: SparkSession, path: str) -> DataFrame:
    """Pair counts saved as Parquet; a filter on ``decade`` prunes folders."""
    return spark.read.schema(PAIR_COUNTS_SCHEMA).parquet(path)


def load_pair_scores(spark: SparkSession, path: str) -> DataFrame:
    """Pair scores saved as Parquet; a filter on ``decade`` prunes folders."""
    return spark.read.schema(PAIR_SCORES_SCHEMA).parquet(path)


def _keyed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines ``decade,w1,w2 TAB values`` as arrays of all their fields."""
    require_ansi(spark)
    fields = F.split("value", r"[,\s]+")
    return spark.read.text(path).select(F.explode(F.array(fields)).alias("f"))


def read_pair_count_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pair counts in the text layout ``decade,w1,w2 TAB c12,n,c1``."""
    names = ["decade", "w1", "w2", "c12", "n", "c1"]
    types = ["int", "string", "string", "bigint", "bigint", "bigint"]
    return _keyed_lines(spark, path).select(*[
        F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(zip(names, types))
    ])


def read_pair_score_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pair scores in the text layout ``decade,w1,w2 TAB npmi``."""
    names = ["decade", "w1", "w2", "npmi"]
    types = ["int", "string", "string", "double"]
    return _keyed_lines(spark, path).select(*[
        F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(zip(names, types))
    ])


def read_collocation_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Result lines ``decade w1 w2 npmi`` of any number of files as one table.

    Fields are split on single blanks; the cast ignores a tab after the score. A
    broken line fails.
    """
    require_ansi(spark)
    fields = F.split("value", " ")
    lines = spark.read.text(path).select(F.explode(F.array(fields)).alias("f"))
    return lines.select(
        F.col("f")[0].cast("int").alias("decade"),
        F.col("f")[1].alias("w1"),
        F.col("f")[2].alias("w2"),
        F.col("f")[3].cast("double").alias("npmi"),
    )
