"""Parquet readers with explicit schemas.

Mail addresses are lower-cased here, once, because the original tables compare
them without regard to case. Other text keeps its case and is compared folded.
Times are cut to whole seconds, the resolution the tables are defined with: windows
over a week of one VM count on at most one row per second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from labmeter.functions.clock import whole_second
from labmeter.sources import schemas


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    stored = spark.read.schema(schema).parquet(path)
    times = [f.name for f in schema if f.dataType == TimestampNTZType()]
    return stored.withColumns({name: whole_second(F.col(name)) for name in times})


def _fold_email(df: DataFrame) -> DataFrame:
    return df.withColumn("email", F.lower("email"))


def read_reservations(spark: SparkSession, path: str) -> DataFrame:
    return _fold_email(_read(spark, path, schemas.RESERVATIONS))


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    return _fold_email(_read(spark, path, schemas.EMPLOYEES))


def read_events(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """`kind` is one of logins, logouts, power_log, power_ops."""
    return _read(spark, path, schemas.EVENT_TABLES[kind])


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.INTERVALS)
