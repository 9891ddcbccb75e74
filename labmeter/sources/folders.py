"""Folders for tables that an operator keeps, in the place that all machines of a cluster share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder under `spark.checkpoint.dir`; under this machine's own only where Spark is local.

    Clearing it is the matter of who owns that folder.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="labmeter-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
