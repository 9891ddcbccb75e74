"""Intermediate tables in the folder that all machines of a cluster share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of this machine only where Spark is local."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="labmeter-")
    context._conf.set("spark.checkpoint.dir", made)
    return made


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: a short plan that survives lost executors.

    Every call takes a folder of its own; the cluster's owner clears them.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, row: str = "row_no") -> DataFrame:
    """``keep`` with a number for each row, so that repeated rows stay apart."""
    return keep(df.withColumn(row, F.monotonically_increasing_id()), name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
