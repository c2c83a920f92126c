"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def require_ansi(spark: SparkSession) -> None:
    """Refuse a session in which overflow and unreadable numbers go unnoticed."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true: counts that overflow must fail")


def shuffle_tasks(spark: SparkSession) -> int:
    """The session's shuffle partitions, or its cores if there are more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spark_settings(
    shuffle_partitions: int | None = None, split_size: int | None = None
) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config(map=...)``.

    On a cluster also set ``spark.checkpoint.dir`` to a folder all executors
    share, and ``shuffle_partitions`` to two or three times the cores: adaptive
    execution merges partitions that turn out small, but cannot add any.
    ``split_size`` bounds the bytes of one input split of text and Parquet files.
    """
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Hash instead of sort where every partition of a marginal is small. Spark
        # ignores the setting if it is below the advisory size.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if split_size is not None:
        settings["spark.sql.files.maxPartitionBytes"] = str(split_size)
    return settings
