"""Small tables for the golden cases."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from labmeter.sources import schemas

DAY = "2024-01-01"
NOW = f"{DAY} 12:00:00"


def at(clock: str | None, day: str = DAY) -> datetime | None:
    """A time of day, as 09:00 or 09:00:05."""
    if clock is None:
        return None
    return datetime.fromisoformat(f"{day} {clock if clock.count(':') == 2 else clock + ':00'}")


def events(spark: SparkSession, rows: list[tuple[str, str | None, str]]) -> DataFrame:
    """(vm_name, dt, action) rows with times of day."""
    data = [(vm, at(clock), action) for vm, clock, action in rows]
    return spark.createDataFrame(data, "vm_name string, dt timestamp_ntz, action string")


def reservations(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = schemas.RESERVATIONS.fieldNames()
    return spark.createDataFrame(
        [tuple(row.get(n) for n in names) for row in rows], schemas.RESERVATIONS
    )


def employees(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = schemas.EMPLOYEES.fieldNames()
    return spark.createDataFrame(
        [tuple(row.get(n) for n in names) for row in rows], schemas.EMPLOYEES
    )


def rows(df: DataFrame) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def plan_of(df: DataFrame) -> str:
    """The physical plan; final where the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()
