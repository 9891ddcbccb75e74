"""Places of regular-expression matches, with DataFrame functions only.

The pieces between the matches (``split``) and the matches (``regexp_extract_all``) take turns in
a text, so that their lengths give every match's place in code points. A text with many
matches becomes rows, and one window per text and kind adds the lengths up.

The patterns must not match the empty string. Where the wording of a rule would try every
place of a long run (or nest a group once per repetition), the pattern used here starts only at
the head of a run or right after the previous match (``\\G``) and repeats without
going back; it finds the same matches in time that grows with the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR = 24


@dataclass(frozen=True)
class Kind:
    """A kind of span. ``hint`` is a cheap test that texts with a match pass."""

    name: str
    pattern: str
    hint: str
    group: int = 0
    base: bool = True


def with_matches(docs: DataFrame, text: str, kinds: list[Kind]) -> DataFrame:
    """Adds ``m_<kind>``: an array of (gap, value, match, before, after); null where none is."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def found(kind: Kind) -> Column:
        gaps = F.split(whole, kind.pattern, -1)
        each = F.arrays_zip(
            F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0)).alias("match"),
            F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(kind.group)).alias("value"),
        )
        pieces = F.transform(
            each, lambda m, i: F.struct(
                F.length(F.get(gaps, i)).cast("long").alias("gap"), m["value"].alias("value"), m["match"].alias("match"),
                F.right(F.get(gaps, i), F.lit(NEAR)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(NEAR)).alias("after"),
            )
        )
        return F.when(F.regexp(whole, F.lit(kind.hint)), pieces)

    return docs.withColumns({f"m_{kind.name}": found(kind) for kind in kinds})


def match_rows(found: DataFrame, kinds: list[Kind], keys: list[str]) -> DataFrame:
    """One row per match: keys, kind, ord, start, end, value, match, before, after."""
    rows = None
    for order, kind in enumerate(kinds):
        one = (
            found.filter(F.col(f"m_{kind.name}").isNotNull())
            .select(*keys, F.posexplode(f"m_{kind.name}").alias("i", "m"))
            .select(*keys, F.lit(kind.name).alias("kind"), F.lit(order).alias("ord"), "i", "m.*")
        )
        rows = one if rows is None else rows.unionByName(one)
    so_far = Window.partitionBy("row_no", "ord").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match").cast("long")
    end = F.sum(F.col("gap") + size).over(so_far)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - size).drop("i", "gap")


def label(kind: str = "kind", start: str = "start", end: str = "end") -> Column:
    return F.concat_ws(":", F.col(kind), F.col(start), F.col(end))
