"""Keeping one document of each group of near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeter.llm.ngram_join import near_duplicates
from labmeter.llm.scratch import keep


def one_of_each(docs: DataFrame, ids: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One row of each group of linked documents, with all its columns: that with the smallest id.

    Rows are told apart by a number and not by id, so that rows with one id and different texts, and rows without id, are
    grouped by their texts alone. Rows without id form groups among themselves, beside those with id. Documents without words are groups of equal id and text. An empty table stays empty.
    """
    number = "__row"
    while number in docs.columns:
        number += "_"
    rows = keep(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    placed = near_duplicates(rows, number, text, percent).select(number, "n_shingles", "component_id")
    named = rows.select(number, F.col(ids).alias("id"), F.xxhash64(text).alias("h"))
    placed = keep(placed.join(named, number), "placed")
    order = F.struct("id", "h", number)
    worded = placed.filter("n_shingles > 0").groupBy("component_id", F.col("id").isNull()).agg(F.min(order).alias("least"))
    bare = placed.filter("n_shingles = 0").groupBy("id", "h").agg(F.min(order).alias("least"))
    kept = worded.select(F.col("least")[number].alias(number)).unionByName(bare.select(F.col("least")[number].alias(number)))
    return rows.join(kept, number, "left_semi").select(*docs.columns)
