"""Mixing sources to target weights by capped water-filling.

The mix takes ``share`` times all words. Every source wants its part by weight, and no more than ``most_epochs``
times its own words. Sources above that are clamped and their excess goes to the others by
weight, round by round, until none is above (each round is one aggregation over the table of
sources; two sums reach the driver). A document is then taken whole as often as every document of
its source, and once more by a seeded choice: documents stand in the order of a keyed hash and are chosen as
long as the middle of a document lies below the words still wanted. A source's words thus miss its target by
half a document at most.

The running sums need no window over a source. Sizes are added up in ``2 ** BITS`` ranges of the hash, then once
more inside the one range of each source where the choice ends; only rows of that last range are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmeter.llm.scratch import keep

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2.0
SEED = "mix-1"
BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Sources with a weight by rank: code point order, null last, the weights repeating.

    A rank is the number of smaller sources. Counts of ranges are summed in order, and ranks are
    counted inside each range, so that no task orders all sources.
    """
    spark = sources.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = keep(
        sources.repartitionByRange(parts, F.col("source").isNull(), F.col("source"))
        .withColumn("part", F.spark_partition_id()), "sources",
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    rank = F.col("before") + F.row_number().over(inside) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    return (
        ranged.join(counts, "part").withColumn("rank", rank)
        .withColumn("weight", F.get(table, (F.col("rank") % len(weights)).cast("int"))).drop("part", "n", "before", "rank")
    )


def water_fill(sources: DataFrame, share: float, most_epochs: float) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): what is above a cap is shared anew by weight."""
    cap = F.col("source_size") * most_epochs
    filled = keep(sources.withColumn("clamped", F.lit(False)), "weights")
    while True:
        row = filled.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(F.col("clamped"), cap)).alias("held"),
            F.sum(F.when(~F.col("clamped"), F.col("weight"))).alias("open"),
        ).first()
        budget, open_weight = (row["all"] or 0) * share - (row["held"] or 0), row["open"] or 0
        wanted = F.lit(budget) * F.col("weight") / F.lit(open_weight or 1.0)
        filled = filled.withColumn("target", F.when(F.col("clamped"), cap).otherwise(wanted))
        above = ~F.col("clamped") & (F.col("target") > cap)
        if filled.filter(above).isEmpty():
            return filled.drop("clamped")
        filled = keep(filled.withColumn("clamped", F.col("clamped") | above).drop("target"), "weights")


def _bin(key: Column, shift: int) -> Column:
    return F.conv(F.substring(key, 1 + shift, BITS // 4), 16, 10).cast("int")


def _cut(rows: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """Per source the range of the hash in which its running sum passes ``left``, and what is left there."""
    bins = rows.groupBy("s", _bin(F.col("key"), 3 * level).alias("bin")).agg(F.sum("size").alias("size"))
    order = Window.partitionBy("s").orderBy("bin")
    bins = bins.withColumn("end", F.sum("size").over(order))
    found = bins.join(wanted, "s").filter(F.col("end") >= F.col("left"))
    first = found.groupBy("s").agg(F.min(F.struct("bin", "end", "size", "left")).alias("m"))
    return first.select("s", F.col("m.bin").alias("cut"), (F.col("m.left") - F.col("m.end") + F.col("m.size")).alias("left"))


def mix_sources(
    docs: DataFrame, ids: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE, most_epochs: float = MOST_EPOCHS, seed: str = SEED, carry: list[str] | None = None,
) -> DataFrame:
    """(ids, carried columns, size, source, source_size, target, copies, taken), a row per document.

    Null source: a source of its own, last in order. Null text and texts without words: size 0; they are
    taken once with no words in the whole copies of their source. Rows with the same id share their fate
    (their hashes are equal). An empty table gives no rows.
    """
    carry = carry or []
    hashed = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(ids).cast("string"), F.lit(""))))
    sized = keep(
        docs.select(
            F.col(ids).alias("id"), F.struct(F.col(source)).alias("s"), word_count(F.col(text)).alias("size"), hashed.alias("key"),
            *[F.col(c).alias(f"c_{c}") for c in carry],
        ), "sized",
    )
    totals = sized.groupBy("s").agg(F.sum("size").alias("source_size"))
    totals = ranked(totals.select(F.col(f"s.{source}").alias("source"), "source_size"), weights)
    filled = water_fill(totals, share, most_epochs).select(
        F.struct(F.col("source").alias(source)).alias("s"), "source_size", "target",
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = filled.withColumn("whole", F.floor(rate)).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size")
    )
    filled = keep(filled, "targets")
    narrow = sized.select("s", "size", "key")
    one = keep(_cut(narrow, filled.select("s", "left").filter("left > 0"), 0), "cuts")
    inner = narrow.join(one, "s").filter(_bin(F.col("key"), 0) == F.col("cut")).select("s", "size", "key")
    two = _cut(inner, one.select("s", "left"), 1).select("s", F.col("cut").alias("cut2"), F.col("left").alias("left2"))
    cuts = keep(one.select("s", "cut").join(two, "s"), "cuts")
    edge = (
        narrow.join(cuts, "s").filter((_bin(F.col("key"), 0) == F.col("cut")) & (_bin(F.col("key"), 3) == F.col("cut2")))
        .groupBy("s", "left2", "key").agg(F.sum("size").alias("size"))
    )
    so_far = F.sum("size").over(Window.partitionBy("s").orderBy("key"))
    last = (
        edge.withColumn("middle", so_far - F.col("size") / 2).filter(F.col("middle") <= F.col("left2"))
        .groupBy("s").agg(F.max("key").alias("last"))
    )
    plan = keep(filled.join(cuts, "s", "left").join(last, "s", "left"), "plan")
    place = F.struct(_bin(F.col("key"), 0).alias("a"), _bin(F.col("key"), 3).alias("b"))
    chosen = F.when(
        F.col("cut").isNotNull(),
        (place < F.struct(F.col("cut").alias("a"), F.col("cut2").alias("b"))) | F.coalesce(F.col("key") <= F.col("last"), F.lit(False)),
    ).otherwise(False)
    copies = (F.col("whole") + chosen.cast("int")).cast("int")
    return sized.join(plan, "s").select(
        F.col("id").alias(ids), *[F.col(f"c_{c}").alias(c) for c in carry], "size", F.col(f"s.{source}").alias(source), "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, ids: str = "doc_id", text: str = "text", source: str = "source", **rules) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with its own columns, whatever their names."""
    whole = docs.select(
        F.col(ids).alias("own_id"), F.col(text).alias("own_text"), F.col(source).alias("own_source"), F.struct("*").alias("own")
    )
    mixed = mix_sources(whole, "own_id", "own_text", "own_source", carry=["own"], **rules)
    repeats = F.explode(F.array_repeat(F.lit(1), F.col("copies")))
    return mixed.filter("copies > 0").select("own", repeats.alias("copy")).select("own.*")
