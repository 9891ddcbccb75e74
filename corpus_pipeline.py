"""A training corpus from raw documents: five stages, each written as a table that the next one reads.

``run`` gives the rows of the last stage. SQL cannot express the learned stages and the segmentation, so that the
stages are tested against plain versions instead (``ORACLE_SQL`` is None).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.llm import dedupe, mixing, pieces, pii, toxicity
from labmeter.llm.catalog import ship
from labmeter.llm.scratch import keep, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model fitted to the labels of these documents."""
    ship(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("score") < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return dedupe.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; ``n_chars`` follows the new text."""
    masked = pii.mask_pii(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document; copies of one document are segmented by draws of their own."""
    ship(spark)
    encoded = pieces.encode(docs, copies=True)
    return encoded.select("doc_id", "lang", "source", "pieces", F.size("pieces").alias("n_pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mix", mix),
    ("pieces", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
