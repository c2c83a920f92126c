"""Reading n-gram rows: ``w1 w2 year count [more columns]``, split on whitespace."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.cleaning import check_mode, reject_malformed

# Four columns are used; the fifth element takes the rest of the line unsplit.
_SPLIT_LIMIT = 5
# White space other than the blank and the tab, as regular expressions have it.
_UNUSUAL = "\n\x0b\f\r"
# Lines of an unsplittable file that go to one task together: 2 to this power.
_BLOCK_BITS = 10


@contextmanager
def bounded_splits(spark: SparkSession, split_size: int | None) -> Iterator[None]:
    """Bound the bytes of one input split of file scans that run inside.

    Spark has this as a setting of the session only, read when a scan runs, so it
    is set for as long as that takes and then put back.
    """
    if split_size is None:
        yield
        return
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(split_size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def check_split_size(split_size: int | None) -> None:
    if split_size is not None and split_size <= 0:
        raise ValueError("split_size must be positive")


def _sequence_lines(spark: SparkSession, path: str | list[str], split_size: int | None) -> DataFrame:
    """The values of SequenceFiles as rows, a record each, decoded inside the JVM.

    There is no DataFrame reader for SequenceFiles. PySpark's own RDD reader has its
    JVM side turn records into Java objects before it hands them to Python; here
    those objects become rows at once, so nothing passes through Python or is written,
    and a record stays one row whatever line ends it holds.
    """
    jvm, java = spark._jvm, spark._jvm.java.lang.Class
    conf = jvm.org.apache.hadoop.conf.Configuration(spark._jsc.hadoopConfiguration())
    if split_size is not None:
        conf.set("mapreduce.input.fileinputformat.split.maxsize", str(split_size))
    records = spark._jsc.newAPIHadoopFile(
        path if isinstance(path, str) else ",".join(path),
        java.forName("org.apache.hadoop.mapreduce.lib.input.SequenceFileInputFormat"),
        java.forName("org.apache.hadoop.io.LongWritable"),
        java.forName("org.apache.hadoop.io.Text"),
        conf,
    )
    shared = spark._jsc.broadcast(jvm.org.apache.spark.util.SerializableConfiguration(conf))
    decode = jvm.org.apache.spark.api.python.WritableToJavaConverter(shared)
    decoded = jvm.org.apache.spark.api.python.PythonHadoopUtil.convertRDD(records.rdd(), decode, decode)
    anything = jvm.scala.reflect.ClassTag.apply(java.forName("java.lang.Object"))
    values = jvm.org.apache.spark.api.java.JavaPairRDD.fromRDD(decoded, anything, anything).values()
    rows = spark._jsparkSession.createDataset(values.rdd(), jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(rows.toDF(), spark)


def _text_lines(spark: SparkSession, path: str | list[str], spread: int | None) -> DataFrame:
    """A text scan; the lines of files that cannot be split are dealt to ``spread`` tasks, block by block."""
    lines = spark.read.text(path).select("value")
    spread = spark.sparkContext.defaultParallelism if spread is None else spread
    files = lines.inputFiles() if spread else []
    whole = {ending for ending in {_ending(name) for name in files} if _cannot_be_split(spark, ending)}
    if not whole:
        return lines
    # A task decodes a file and hands its lines on as it goes, so neither it nor those
    # that parse them hold more than a few blocks. Which block a line is in depends on
    # its place in the file alone, so a task that runs again deals out the same.
    block = F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS)
    packed = spark.read.text([unquote(name) for name in files if _ending(name) in whole])
    dealt = packed.select("value", block.alias("block")).repartition(spread, "block").select("value")
    others = [unquote(name) for name in files if _ending(name) not in whole]
    return spark.read.text(others).select("value").union(dealt) if others else dealt


def _ending(name: str) -> str:
    return name.rpartition("/")[2].rpartition(".")[2]


def _cannot_be_split(spark: SparkSession, ending: str) -> bool:
    """Whether files of this ending are compressed as one stream."""
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = codecs.getCodec(jvm.org.apache.hadoop.fs.Path(f"lines.{ending}"))
    splittable = jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    return codec is not None and not splittable.isInstance(codec)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    format: str = "text",
    split_size: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Scan n-gram records into one ``value`` column.

    Text that is compressed as one stream, such as gzip, is decoded by one task a
    file; its lines are shuffled once, so that ``spread`` tasks split and filter them
    (as many as the session has cores unless given; 0 leaves them where they are).

    ``format`` is ``"text"`` (a record ends at a line end) or ``"sequence"``
    (SequenceFiles of ``Text`` values, a record each, line ends and all; the codec
    comes from the file header). Both are lazy. ``split_size`` bounds the bytes of
    one task's share of a SequenceFile. A text scan splits as the session says when
    it runs: set ``spark_settings(split_size=...)``, or let
    :func:`wordbond.collocations` bound its own scan.
    """
    check_split_size(split_size)
    if format == "text":
        if split_size is not None:
            raise ValueError("for text set the split size in spark_settings")
        return _text_lines(spark, path, spread)
    if format == "sequence":
        return _sequence_lines(spark, path, split_size)
    raise ValueError(f"format must be 'text' or 'sequence', not {format!r}")


def _records(lines: DataFrame) -> DataFrame:
    """``t``: the first fields of each record, split on white space.

    Records laid out as n-gram files are, ``w1 w2<tab>year<tab>count``, are cut at their one
    blank and their tabs, which gives the same fields for half the time of a regular
    split. The sizes of what was cut tell which records these are.
    """
    # The one-element explodes keep Catalyst from copying an expression into every
    # filter and column above it: each is computed once per record.
    def once(rows: DataFrame, array: Column, name: str) -> DataFrame:
        return rows.select("*", F.explode(F.array(array)).alias(name))

    value = F.col("value")
    cut = once(lines.select("value"), F.array(*[F.substring_index(value, "\t", n) for n in (1, 2, 3)]), "cut")
    words, to_year, to_count = (F.get("cut", F.lit(n)) for n in range(3))
    parted = once(cut, F.array(
        F.substring_index(words, " ", 1), F.substring_index(words, " ", -1),
        F.substring_index(to_year, "\t", -1), F.substring_index(to_count, "\t", -1),
    ), "parted")
    w1, w2, year, count = (F.get("parted", F.lit(n)) for n in range(4))
    size = F.octet_length
    usual = size(words) == size(w1) + 1 + size(w2)
    usual &= size(to_count) == size(words) + size(year) + size(count) + 2
    usual &= F.least(size(w1), size(w2), size(year), size(count)) > 0
    usual &= ~(F.contains(year, F.lit(" ")) | F.contains(count, F.lit(" ")))
    for mark in _UNUSUAL:
        usual &= ~F.contains(to_count, F.lit(mark))
    fields = F.when(usual, F.col("parted")).otherwise(F.split(value, r"\s+", _SPLIT_LIMIT))
    return parted.select(F.explode(F.array(fields)).alias("t"))


def split_ngrams(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Split records into ``w1, w2, year, match_count``.

    Only records with fewer than two words are judged here, since the word
    filters would hide them. A year or count that does not parse becomes NULL, to
    be judged by :func:`reject_malformed` after the word filters.
    """
    check_mode(mode)
    records = _records(lines)
    # Empty tokens can only be the first or the last of a record.
    long_enough = F.coalesce(F.get("t", F.lit(1)), F.lit("")) != ""
    if mode == "FAILFAST":
        long_enough = F.when(long_enough, True).otherwise(
            F.raise_error(F.lit("malformed n-gram row: fewer than two words"))
        )
    return records.filter(long_enough).select(
        F.get("t", F.lit(0)).alias("w1"),
        F.get("t", F.lit(1)).alias("w2"),
        F.get("t", F.lit(2)).try_cast("int").alias("year"),
        F.get("t", F.lit(3)).try_cast("bigint").alias("match_count"),
    )


def read_ngrams(
    spark: SparkSession,
    path: str | list[str],
    format: str = "text",
    mode: str = "FAILFAST",
    split_size: int | None = None,
) -> DataFrame:
    """Scan n-gram rows and judge every one of them, without any word filter."""
    lines = read_lines(spark, path, format, split_size)
    return reject_malformed(split_ngrams(lines, mode), mode)
