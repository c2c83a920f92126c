"""Stage tables: intermediate results written to the folder the cluster shares.

A stage table cuts the lineage behind an expensive result, so a lost executor
costs a re-read of the table and not a second pass over the corpus. Parquet is
used instead of ``DataFrame.checkpoint`` because the stages are read several
times with different columns, and Parquet lets each reader prune.
"""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import Column, DataFrame, Observation, SparkSession


# Tables with a row for each pair of words, few of which repeat often enough in a file for Parquet
# to keep a dictionary of them: without one they are written in two thirds of the time.
PLAIN = ("pairs", "scores")
# Names in the catalogue of workspaces that are gone and were never dropped.
_LEFT: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or ``setCheckpointDir``).

    Where neither is set, a folder in the session's own warehouse. On a cluster that
    must lie in a shared store: in a machine's own folder each executor would keep
    the part it wrote and read back only that.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:"):  # Spark names the store of the folder it was given
        check_shared("file", spark.sparkContext.master)
    return f"{warehouse}/_stages"


def check_shared(scheme: str, master: str) -> None:
    """Raise if executors of ``master`` do not share the files of a store of this ``scheme``."""
    if scheme == "file" and not (master == "local" or master.startswith("local[")):
        raise ValueError(
            "the warehouse is a folder of one machine; set spark.checkpoint.dir to one that all executors share"
        )


class Workspace:
    """Stage tables of one run, kept until :meth:`drop` or the end of the driver.

    Results read the stage tables lazily, so drop them only after the result
    was written or collected. What is not dropped by then goes when the driver's
    Spark ends::

        with Workspace(spark) as workspace:
            found = collocations(spark, path, ..., workspace=workspace)
            save_collocation_lines(found, target)
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{(folder or shared_folder(spark)).rstrip('/')}/wordbond-{uuid.uuid4().hex}"
        self._stored = 0
        self._tables: list[str] = []
        weakref.finalize(self, _LEFT.extend, self._tables)
        path, files = self._on_disk()
        files.mkdirs(path)
        files.deleteOnExit(path)  # of a folder that exists

    def _on_disk(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def new_path(self, name: str) -> str:
        self._stored += 1
        return f"{self.path}/{self._stored:02d}-{name}"

    def store(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` now and return a DataFrame that reads it back."""
        path = self.new_path(name)
        writer = df.write.option("parquet.enable.dictionary", "false") if name in PLAIN else df.write
        writer.parquet(path, partitionBy=partition_by)
        return self.spark.read.schema(df.schema).parquet(path)

    def store_observed(
        self, df: DataFrame, name: str, metrics: list[Column], partition_by: list[str] | None = None
    ) -> tuple[DataFrame, dict]:
        """Like :meth:`store`; the aliased ``metrics`` are computed while writing."""
        observation = Observation()
        stored = self.store(df.observe(observation, *metrics), name, partition_by)
        return stored, observation.get

    def store_bucketed(
        self, df: DataFrame, name: str, keys: list[str], buckets: int | None = None, sort: list[str] | None = None
    ) -> DataFrame:
        """Like :meth:`store`, dealt by the hash of ``keys`` into as many files as ``buckets``.

        Joins on ``keys``, or on more columns, and sums by them then find the rows in
        place and do not shuffle them again. ``df`` is shuffled once, so that a task
        writes a single file, and sorted by ``sort`` (``keys`` unless given; not at all if it is empty). The number
        of buckets is that of the session's shuffle partitions unless given. Only the
        session's catalogue can tell Spark of buckets, so the table has a name there
        until :meth:`drop`, or until the driver ends where the catalogue is in memory. The names of
        workspaces that are gone without it are taken out here; their files stay, and so
        does what reads them.
        """
        while _LEFT:
            self.spark.sql(f"DROP TABLE IF EXISTS {_LEFT.pop()}")
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = self.new_path(name)
        table = f"wordbond_{uuid.uuid4().hex}"
        self._tables.append(table)
        sort = keys if sort is None else sort
        writer = df.repartition(buckets, *keys).write.format("parquet").option("path", path).bucketBy(buckets, *keys)
        (writer.sortBy(*sort) if sort else writer).saveAsTable(table)
        return self.spark.table(table)

    def drop(self) -> None:
        """Delete the folder of this run."""
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        path, files = self._on_disk()
        files.delete(path, True)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_) -> None:
        self.drop()
