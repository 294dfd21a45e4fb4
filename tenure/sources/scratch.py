"""Where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used on a local master only; on a cluster
    executors would not see it, so this raises instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tenure-")
    return f"{root.rstrip('/')}/tenure/{name}-{uuid.uuid4().hex}"
