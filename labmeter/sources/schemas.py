"""Table schemas. Event and reservation times are TIMESTAMP_NTZ in UTC, whole seconds."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _table(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_TEXT, _TIME = StringType(), TimestampNTZType()

RESERVATIONS = _table(
    ("vm_name", _TEXT), ("rdp", _TEXT), ("start_ts", _TIME), ("end_ts", _TIME),
    ("lab", _TEXT), ("email", _TEXT),
)
LOGINS = _table(("vm_name", _TEXT), ("login_ts", _TIME))
LOGOUTS = _table(("vm_name", _TEXT), ("logout_ts", _TIME))
POWER_LOG = _table(("vm_name", _TEXT), ("log_ts", _TIME), ("operation", _TEXT))
POWER_OPS = _table(("vm_name", _TEXT), ("ts", _TIME), ("op", IntegerType()))
INTERVALS = _table(("vm_name", _TEXT), ("power_on", _TIME), ("power_off", _TIME))
EMPLOYEES = _table(
    ("email", _TEXT), ("full_name", _TEXT), ("region", _TEXT), ("location", _TEXT),
    ("manager", _TEXT), ("business_unit", _TEXT), ("department", _TEXT),
    ("business_title", _TEXT), ("ase", BooleanType()),
)

EVENT_TABLES = {
    "logins": LOGINS, "logouts": LOGOUTS, "power_log": POWER_LOG, "power_ops": POWER_OPS,
}
