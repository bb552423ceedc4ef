"""A folder for files that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="almanac-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
