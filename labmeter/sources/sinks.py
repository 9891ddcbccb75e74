"""Append-only sinks for attributed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.operators.changes import latest_changes

# The two event tables a collector may name.
TABLE_OF_ACTION = {"in": "Logins", "out": "Logouts"}


def target_table(action: Column) -> Column:
    """Event table an action is stored in; NULL for any other action."""
    table = F
    for name, target in TABLE_OF_ACTION.items():
        table = table.when(action == name, target)
    return table


def stamp_arrival(df: DataFrame) -> DataFrame:
    """Adds `arrived`, the time of storing in UTC."""
    arrived = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.withColumn("arrived", arrived.cast("timestamp_ntz"))


def append_events(df: DataFrame, path: str) -> None:
    """Append rows stamped with their arrival time (UTC)."""
    stamp_arrival(df).write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, identity: Sequence[str], ts: str = "ts") -> int:
    """Append the rows whose identity is not stored yet, stamped with their arrival time; tells how many.

    A repeated batch leaves the table as it was, and one that was lost half-way is completed. Of rows with one identity
    in a batch one is taken. The table lies in folders by day of `ts`, and only the batch's days are compared.
    """
    spark = df.sparkSession
    day = F.to_date(ts).alias("day")
    batch = df.withColumn("day", day).dropDuplicates([*identity, "day"]).persist()
    try:
        days = [row.day for row in batch.select("day").distinct().collect()]  # one value per day of the batch
        try:
            stored = spark.read.schema(batch.schema).option("basePath", path).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            new = batch
        else:
            some = F.col("day").isin([d for d in days if d is not None])
            known = stored.filter(some | F.col("day").isNull() if None in days else some)
            same = F.struct(*identity, "day")
            known = known.select(same.alias("known")).distinct()
            new = batch.withColumn("own", same).join(known, F.col("own").eqNullSafe(F.col("known")), "left_anti").drop("own")
        new = new.persist()
        try:
            number = new.count()
            if number:
                stamp_arrival(new).write.mode("append").partitionBy("day").parquet(path)
            return number
        finally:
            new.unpersist()
    finally:
        batch.unpersist()


def upsert_changes(changes: DataFrame, path: str, buckets: int = 64) -> None:
    """Keep the newest change of each VM in a table keyed by `vm_name`; other buckets than the batch's keep their files.

    The table lies in folders by a hash of the name. The buckets that changes fall in are read, merged and written aside, and then
    replace the old ones. Taking the newest is idempotent, so that a repeat after a loss at any point gives the same table: what was
    written aside but not yet put in place is put in place first.
    """
    spark = changes.sparkSession
    turn = _put_in_place(spark, path)
    number = F.pmod(F.xxhash64("vm_name"), F.lit(buckets)).cast("int").alias("bucket")
    batch = latest_changes(changes).withColumn("bucket", number).persist()
    try:
        touched = [row.bucket for row in batch.select("bucket").distinct().collect()]  # at most as many as there are buckets
        if not touched:
            return
        rows = batch
        if _exists(spark, f"{path}/rows"):
            stored = spark.read.schema(batch.schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
            rows = batch.unionByName(stored.filter(F.col("bucket").isin(touched)))
        merged = latest_changes(rows.drop("bucket")).withColumn("bucket", number)
        merged.hint("rebalance", "bucket").withColumn("turn", F.lit(turn)).write.mode("overwrite").partitionBy(
            "turn", "bucket"
        ).parquet(f"{path}/aside{turn % 2}")
    finally:
        batch.unpersist()
    _put_in_place(spark, path)


def _put_in_place(spark: SparkSession, path: str) -> int:
    """Replaces the buckets that lie aside, if a complete set does that is not in place yet; tells the turn to come."""
    turn = 0
    if _exists(spark, f"{path}/placed"):
        turn = spark.read.schema("turn int").parquet(f"{path}/placed").agg(F.max("turn")).first()[0] + 1
    aside = f"{path}/aside{turn % 2}"
    if not (_exists(spark, f"{aside}/_SUCCESS") and _exists(spark, f"{aside}/turn={turn}")):
        return turn
    rows = spark.read.option("basePath", f"{aside}/turn={turn}").parquet(f"{aside}/turn={turn}")
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    spark.range(1).select(F.lit(turn).alias("turn")).write.mode("append").parquet(f"{path}/placed")
    return turn + 1


def stored_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("bucket")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def route_events(df: DataFrame, path: str, by: str = "action") -> None:
    """Append rows under one folder per target table.

    Rows are written where they are: no shuffle, so a dominant action spreads
    over as many tasks as the input does.
    """
    routed = df.withColumn("target", target_table(F.col(by))).filter(F.col("target").isNotNull())
    routed.write.mode("append").partitionBy("target").parquet(path)
