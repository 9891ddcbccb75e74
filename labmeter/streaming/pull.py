"""Repeated pulls of the change feed from tables that can only be queried.

The mark is the latest `modified` stored so far. Each pull is a folder of its
own, named by its number, and counts only once its mark is written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.operators.changes import extract_changes

MARKS = "pull bigint, mark timestamp_ntz"


def last_mark(spark: SparkSession, store: str) -> tuple[int, datetime | None]:
    """Number and mark of the last complete pull; (-1, None) before the first."""
    try:
        marks = spark.read.schema(MARKS).parquet(f"{store}/marks")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, None
    top = marks.agg(F.max(F.struct("pull", "mark")).alias("top")).select("top.*").first()
    return top.pull, top.mark


def pull_changes(
    reservations: DataFrame,
    employees: DataFrame,
    power_log: DataFrame,
    store: str,
    now: datetime | str,
    start: datetime | str,
    only: str | None = "deleted",
) -> DataFrame:
    """Store and return the changes between the last mark (at first `start`) and `now`."""
    spark = reservations.sparkSession
    number, mark = last_mark(spark, store)
    low = mark or start
    path = f"{store}/changes/pull={number + 1}"
    extract_changes(reservations, employees, power_log, low, now, only).write.mode(
        "overwrite"
    ).parquet(path)
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("modified").alias("mark"))
    newest.select(
        F.lit(number + 1).cast("long").alias("pull"),
        F.coalesce("mark", F.lit(str(low)).cast("timestamp_ntz")).alias("mark"),
    ).write.mode("append").parquet(f"{store}/marks")
    return stored
