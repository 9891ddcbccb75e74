"""Fields carried inside a VM name, a mail address or a line of text.

A VM name reads `<lab>[-Persistent]-(<owner>)-YYYY-MM-DD-HH:MM:SS:<micros>`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal what the collectors and reports use.
PERSISTENT_MARK = "-persistent-"
CREATED_FORMAT = "yyyy-MM-dd-HH:mm:ss"
ADDRESS_PATTERN = r"IPv4.+\s(10.24\d{1}\.\d{1,3}\.\d{1,3})"
GATEWAY_PATTERN = r"Default Gateway . . . . . . . . . :+\s(1\d{1,2}\.\d{1,3}.\d{1,3}.\d{1,3})"
ADDRESS_MARK = "10.24"
ADDRESS_TAIL_LENGTH = 9


def vm_owner(vm: Column) -> Column:
    return F.substring_index(F.substring_index(vm, "-(", -1), ")-", 1)


def vm_lab_prefix(vm: Column) -> Column:
    """Text before the first dash. A lab whose own name holds a dash is cut there."""
    return F.substring_index(vm, "-", 1)


def vm_created_text(vm: Column) -> Column:
    return F.substring_index(vm, "-", -4)


def _lenient_datetime(text: Column) -> Column:
    clock = F.substring_index(text, ":", 3)
    return F.try_to_timestamp(clock, F.lit(CREATED_FORMAT)).cast("timestamp_ntz")


def vm_created_ts(vm: Column) -> Column:
    """Creation time from the last four dash parts; NULL when they are no date."""
    return _lenient_datetime(vm_created_text(vm))


def vm_reserved_ts(vm: Column) -> Column:
    """Creation time from the text after the last `)-`; NULL when that is no date."""
    return _lenient_datetime(F.substring_index(vm, ")-", -1))


def is_persistent(vm: Column) -> Column:
    return F.lower(vm).contains(PERSISTENT_MARK)


def lab_kind(vm: Column) -> Column:
    return F.when(is_persistent(vm), "Customized").otherwise("On-Demand")


def mail_owner(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def extract_address(text: Column, pattern: str = ADDRESS_PATTERN) -> Column:
    """First group of the last line of `text` that matches `pattern`, else NULL."""
    per_line = F.transform(
        F.split(text, r"\r?\n"), lambda line: F.regexp_extract(line, f"(?i){pattern}", 1)
    )
    return F.try_element_at(F.filter(per_line, lambda hit: hit != ""), F.lit(-1))


def after_marker(
    text: Column, marker: str = ADDRESS_MARK, length: int = ADDRESS_TAIL_LENGTH
) -> Column:
    """`marker` and the `length` characters that follow its first place in `text`.

    The marker is a pattern, as in the collector. NULL when it is missing or
    too little text follows.
    """
    tail = F.substring(F.get(F.split(text, f"(?i){marker}", 2), F.lit(1)), 1, length)
    return F.when(F.length(tail) == length, F.concat(F.lit(marker), tail))
