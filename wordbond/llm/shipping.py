"""Python workers must import this package too."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def share_import_path(spark: SparkSession) -> None:
    """Let workers look for the package where this process found it.

    That is enough where they see the same files. On a cluster install the package
    or send it along (``--py-files``); the path is then one that does not exist.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
