"""One spelling per VM.

The original tables compare names without regard to case, and an event's name refers to a reservation. Events are
given their reservation's spelling once, when they are taken in; from then on names are compared, grouped and sorted
by their exact text. Names without a reservation are put in lower case, so that they are one VM too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spellings(reservations: DataFrame) -> DataFrame:
    """(folded_name, shown_name): the first spelling, by code points, of each reserved name."""
    return reservations.select("vm_name").dropna().groupBy(F.lower("vm_name").alias("folded_name")).agg(
        F.min("vm_name").alias("shown_name")
    )


def conform_names(events: DataFrame, reservations: DataFrame) -> DataFrame:
    """Events, a table or a stream, with `vm_name` as the reservation spells it. Other columns pass; NULL stays NULL."""
    folded = events.withColumn("folded_name", F.lower("vm_name"))
    shown = F.coalesce("shown_name", "folded_name").alias("vm_name")
    return folded.join(spellings(reservations), "folded_name", "left").select(
        *[shown if c == "vm_name" else F.col(c) for c in events.columns]
    )
