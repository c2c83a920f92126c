"""Adding to saved pair counts without counting the whole corpus again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.counting import PAIR, attach_decade_total, attach_left_marginal, count_pairs_per_decade, marginals
from ..operators.joining import JoinLimits
from ..sources.stored import PAIR_COUNTS_SCHEMA, load_pair_counts
from ..workspace import Workspace
from .tables import save_pair_counts

# Below a table's folder; readers pass over names that begin with an underscore.
_MERGES = "_merges"


class _Folder:
    """Files next to a table, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._new(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(self._new(path))]

    def touch(self, path: str) -> None:
        self._files.create(self._new(path), True).close()

    def delete(self, path: str) -> None:
        self._files.delete(self._new(path), True)


def merge_pair_counts(
    spark: SparkSession,
    path: str,
    added: DataFrame,
    batch: str,
    workspace: Workspace | None = None,
    limits: JoinLimits = JoinLimits(),
) -> list[int]:
    """Add cleaned n-grams or counted pairs to the counts saved at ``path``; the decades that changed.

    ``added`` holds ``decade, w1, w2`` and ``match_count`` (as :func:`clean_ngrams`
    gives) or ``c12``. Only its decades are read, counted and written again; the
    files of others are not touched. A ``path`` that does not exist is begun.

    ``batch`` names what is added, and a batch is added once: running it again does
    nothing. The new counts are staged next to the table before any folder of it
    changes. If the job dies after that, running the batch again only moves them into
    place; until then other batches are refused. Readers may see some decades with
    the batch and some without it while folders are replaced. One merge at a time.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.=-]*", batch):
        raise ValueError("a batch is named by letters, digits, points, signs of equality and hyphens")
    workspace = workspace or Workspace(spark)
    folder, place = _Folder(spark, path), f"{path.rstrip('/')}/{_MERGES}"
    staged, done = f"{place}/{batch}/counts", f"{place}/{batch}/done"
    if folder.exists(done):
        return []
    open_batches = [
        name for name in folder.names(place)
        if name != batch and folder.exists(f"{place}/{name}/counts/_SUCCESS") and not folder.exists(f"{place}/{name}/done")
    ]
    if open_batches:
        raise ValueError(f"the merge of {open_batches[0]!r} is unfinished; run it again first")
    if not folder.exists(f"{staged}/_SUCCESS"):
        saved = any(name.startswith("decade=") for name in folder.names(path))
        _stage(spark, path if saved else None, added, staged, workspace, limits)
    counts = spark.read.schema(PAIR_COUNTS_SCHEMA).parquet(staged)
    decades = sorted(row.decade for row in counts.select("decade").distinct().collect())  # folder names
    save_pair_counts(counts, path, mode="dynamic")
    folder.touch(done)
    folder.delete(staged)
    return decades


def _stage(
    spark: SparkSession, path: str | None, added: DataFrame, staged: str, workspace: Workspace, limits: JoinLimits
) -> None:
    """Write the counts of the changed decades, with what is saved of them at ``path``."""
    new = added.select(*PAIR, "c12") if "c12" in added.columns else count_pairs_per_decade(added)
    new = workspace.store(new, "added-pairs")
    if path is not None:
        changed = [row.decade for row in new.select("decade").distinct().collect()]  # a row per decade
        old = load_pair_counts(spark, path).filter(F.col("decade").isin(changed))  # prunes folders
        new = new.unionByName(old.select(*PAIR, "c12"))
    pairs = workspace.store(new.groupBy(*PAIR).agg(F.sum("c12").alias("c12")), "merged-pairs")
    counted = marginals(pairs, workspace, limits=limits)
    merged = attach_left_marginal(attach_decade_total(pairs, counted), counted)
    save_pair_counts(merged.select(*PAIR, "c12", "n", "c1"), staged, mode="overwrite")
