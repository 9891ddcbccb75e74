"""Texts that contain other texts, by an inverted index over rare q-grams.

Each short text is entered once, under one of its q-grams: the one that fewest of the short texts have. A long text looks
up its own q-grams, so that its rows grow with its length only, and what it finds is verified. Grams come in
several sizes. Where all grams of one size are frequent, a text is entered under a longer one, which fewer have: a gram that a third
of all texts share is the entry of those texts only that have nothing rarer. What stays frequent is a skewed equi-join, which Spark
splits at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (4, 8, 16)


def _grams(text: str, sizes: str) -> Column:
    """The distinct grams of the given sizes; a size beyond the text gives none."""
    places = f"sequence(1, length({text}) - size + 1)"
    of_size = f"if(size <= length({text}), transform({places}, place -> substring({text}, place, size)), array())"  # size 0: ''
    return F.expr(f"array_distinct(flatten(transform({sizes}, size -> {of_size})))")


def _entry_grams(text: str) -> Column:
    """What a short text may be entered under: its grams, or itself where it is shorter than all sizes."""
    sizes = ", ".join(map(str, SIZES))
    return F.when(F.length(text) < SIZES[0], F.array(text)).otherwise(_grams(text, f"array({sizes})"))


def rare_grams(texts: DataFrame, column: str = "rdp", taken: DataFrame | None = None) -> DataFrame:
    """(gram, column): each distinct text under its rarest gram (ties: the shorter, then the first).

    `taken` (gram, n) tells how many texts stand under a gram already.
    """
    known = texts.select(column).filter(F.col(column).isNotNull()).distinct()
    each = known.select(column, F.explode(_entry_grams(column)).alias("gram"))
    counted = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    if taken is not None:
        counted = counted.unionByName(taken).groupBy("gram").agg(F.sum("n").alias("n"))
    order = F.struct("n", F.length("gram").alias("size"), "gram")
    return each.join(counted, "gram").groupBy(column).agg(F.min(order).alias("best")).select("best.gram", column)


def lookup_grams(texts: DataFrame, column: str, shortest: Column) -> DataFrame:
    """(column, gram): the grams under which parts of a text can stand that have at least `shortest` characters."""
    known = texts.select(column).filter(F.col(column).isNotNull()).distinct()
    below = ", ".join(map(str, range(SIZES[0])))
    sizes = F.expr(f"concat(filter(array({below}), size -> size >= shortest), array({', '.join(map(str, SIZES))}))")
    sized = known.select(column, F.lower(column).alias("folded"), F.coalesce(shortest, F.lit(SIZES[0])).alias("shortest"))
    return sized.withColumn("sizes", sizes).select(column, F.explode(_grams("folded", "sizes")).alias("gram"))


def containing(texts: DataFrame, column: str, parts: DataFrame, part: str = "rdp") -> DataFrame:
    """(column, part) for every part (in lower case) that a text contains, case folded."""
    shortest = parts.agg(F.min(F.length(part)).alias("size")).scalar()
    return verified(lookup_grams(texts, column, shortest).join(rare_grams(parts, part), "gram"), column, part)


def verified(candidates: DataFrame, column: str, part: str = "rdp") -> DataFrame:
    return candidates.filter(F.lower(column).contains(F.col(part))).select(column, part)
