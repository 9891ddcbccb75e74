"""Codes, states and the parameterised filters of the reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import moment, moment_of_epoch
from labmeter.functions.names import mail_owner

Clock = Column | datetime | str

# Operation names by procedure code, and display codes by operation.
OPERATION_OF_OP = {0: "Powered-On", 1: "Suspended", 2: "Deleted"}
POWER_ON, SUSPEND, DELETE, CREATED = 0, 1, 2, 3
OPENING_OPERATIONS = ("powered-on", "created")
LOGIN_CODE, LOGOUT_CODE, OTHER_CODE = 0, 1, 5
CODE_OF_OPERATION = {"created": 2, "powered-on": 3, "suspended": 4}


def power_action(operation: Column) -> Column:
    return F.when(F.lower(operation).isin(*OPENING_OPERATIONS), "in").otherwise("out")


def op_code(operation: Column) -> Column:
    """Display code of a power operation; anything unknown, NULL too, is 5."""
    code = F
    for name, value in CODE_OF_OPERATION.items():
        code = code.when(F.lower(operation) == name, value)
    return code.otherwise(OTHER_CODE)


def op_name(op: Column) -> Column:
    """Operation name of a procedure code; NULL for codes that write nothing."""
    name = F
    for code, value in OPERATION_OF_OP.items():
        name = name.when(op == code, value)
    return name


def is_active(end: Column, now: Clock) -> Column:
    return end >= moment(now)


def lab_status(
    end: Column, now: Clock, labels: tuple[str, str] = ("Active", "Deleted")
) -> Column:
    return F.when(is_active(end, now), labels[0]).otherwise(labels[1])


def yes_no(flag: Column) -> Column:
    return F.when(flag, "YES").otherwise("NO")


def covers(start: Column, end: Column, at: Clock) -> Column:
    return moment(at).between(start, end)


def started_between(start: Column, low: int, high: int) -> Column:
    """Inclusive range given in epoch seconds, against a bare column so scans can prune."""
    return start.between(moment_of_epoch(low), moment_of_epoch(high))


def flag_filter(flag: Column, mode: int) -> Column:
    """0 keeps false, 1 keeps true, 2 keeps every row whose flag is known."""
    if mode == 0:
        return ~flag
    if mode == 1:
        return flag
    return flag.isNotNull()


def _any_of(column: Column, wanted: Sequence[str]) -> Column:
    return F.lower(column).isin(*[w.lower() for w in wanted]) if wanted else F.lit(False)


def report_filter(
    df: DataFrame,
    labs: Sequence[str] | None = None,
    owners: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    managers: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """Keep rows whose columns lie in the given lists; None leaves a column free.

    Matching ignores case, as the collation of the original tables does.
    """
    wanted = [
        (lambda: F.col("lab"), labs),
        (lambda: mail_owner(F.col("email")), owners),
        (lambda: F.col("region"), regions),
        (lambda: F.col("manager"), managers),
        (lambda: F.col("state"), states),
        (lambda: F.col("kind"), kinds),
    ]
    for column, values in wanted:
        if values is not None:
            df = df.filter(_any_of(column(), values))
    return df
