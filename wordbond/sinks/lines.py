"""Saving results as text lines ``decade w1 w2 npmi``, and any lines as SequenceFiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import order_collocations, order_top_rows


def collocation_lines(collocations: DataFrame, trailing_tab: bool = False) -> DataFrame:
    """One ``value`` line per row; ``trailing_tab`` ends it like an empty value would."""
    line = F.concat_ws(
        " ", F.col("decade").cast("string"), "w1", "w2", F.col("npmi").cast("string")
    )
    return collocations.select(
        (F.concat(line, F.lit("\t")) if trailing_tab else line).alias("value")
    )


def save_collocation_lines(
    collocations: DataFrame,
    path: str,
    ordered: bool = True,
    trailing_tab: bool = False,
    mode: str = "error",
) -> None:
    """Write the lines, by default ordered over all part files."""
    rows = order_collocations(collocations) if ordered else collocations
    collocation_lines(rows, trailing_tab).write.mode(mode).text(path)


def save_top_listing(
    top_rows: DataFrame, path: str, mode: str = "error", single_file: bool = False
) -> None:
    """Write top rows as one ordered listing, in range-sorted part files.

    ``single_file`` has one task write all of it, for listings known to be short.
    """
    if not single_file:
        return save_collocation_lines(order_top_rows(top_rows), path, ordered=False, mode=mode)
    rows = top_rows.repartition(1).sortWithinPartitions("decade", F.desc("npmi"), "w1", "w2")
    collocation_lines(rows).write.mode(mode).text(path)


def save_sequence_lines(lines: DataFrame, path: str) -> None:
    """Write ``value`` lines as SequenceFiles of ``Text`` values, a record each, with the key 0.

    There is no DataFrame writer for SequenceFiles. This is what ``saveAsSequenceFile`` of a
    PySpark RDD does on its JVM side, without passing every line through Python first.
    """
    spark = lines.sparkSession
    jvm, java = spark._jvm, spark._jvm.java.lang.Class
    encoders = jvm.org.apache.spark.sql.Encoders
    pairs = lines.select(F.lit(0).alias("_1"), F.col("value").alias("_2"))._jdf
    records = getattr(pairs, "as")(encoders.tuple(encoders.INT(), encoders.STRING())).rdd()
    encode = jvm.org.apache.spark.api.python.JavaToWritableConverter()
    written = jvm.org.apache.spark.api.python.PythonHadoopUtil.convertRDD(records, encode, encode)
    anything = jvm.scala.reflect.ClassTag.apply(java.forName("java.lang.Object"))
    jvm.org.apache.spark.api.java.JavaPairRDD.fromRDD(written, anything, anything).saveAsNewAPIHadoopFile(
        path,
        java.forName("org.apache.hadoop.io.IntWritable"),
        java.forName("org.apache.hadoop.io.Text"),
        java.forName("org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"),
        jvm.org.apache.hadoop.conf.Configuration(spark._jsc.hadoopConfiguration()),
    )
