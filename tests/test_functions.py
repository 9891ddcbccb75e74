"""Golden cases of the column functions."""

from datetime import datetime

from pyspark.sql import functions as F

from labmeter.functions import clock, names, status, text
from tests.helpers import NOW, at


def values(spark, column, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_vm_fields(spark):
    vm = F.col("vm")
    data = [("Lab 0-Persistent-(user0)-2024-01-01-03:30:04:000001",), ("A - B-(x)-nonsense",),
            ("none",), (None,)]
    df = spark.createDataFrame(data, "vm string").select(
        names.vm_owner(vm), names.vm_lab_prefix(vm), names.vm_created_text(vm),
        names.vm_created_ts(vm), names.vm_reserved_ts(vm), names.lab_kind(vm),
    )
    made = datetime(2024, 1, 1, 3, 30, 4)
    assert [tuple(r) for r in df.collect()] == [
        ("user0", "Lab 0", "2024-01-01-03:30:04:000001", made, made, "Customized"),
        ("x", "A ", "A - B-(x)-nonsense", None, None, "On-Demand"),
        ("none", "none", "none", None, None, "On-Demand"),
        (None, None, None, None, None, "On-Demand"),
    ]


def test_persistent_ignores_case(spark):
    data = [("a-PERSISTENT-(x)",), ("a-persistent",)]
    assert values(spark, names.is_persistent(F.col("v")), data, "v string") == [True, False]


def test_addresses(spark):
    data = [
        ("Host : x\r\nIPv4 Address. . . : 10.241.7.15\r\nIPv4 Address : 10.249.1.2\nend",),
        ("ipv4 address : 10.240.1.1234",), ("IPv4 Address\n: 10.240.1.1",), ("nothing",), (None,),
    ]
    assert values(spark, names.extract_address(F.col("t")), data, "t string") == [
        "10.249.1.2", "10.240.1.123", None, None, None,
    ]
    routed = [("eth 10.240.5.77/24 10.249.1.1/24",), ("10.24",), ("eth 10.240.1",), (None,)]
    assert values(spark, names.after_marker(F.col("t")), routed, "t string") == [
        "10.240.5.77/24"[:14], None, None, None,
    ]
    gateway = [("   Default Gateway . . . . . . . . . : 172.16.0.254",)]
    found = names.extract_address(F.col("t"), names.GATEWAY_PATTERN)
    assert values(spark, found, gateway, "t string") == ["172.16.0.254"]


def test_durations(spark):
    data = [(90_061,), (0,), (-90_061,), (None,)]
    assert values(spark, text.duration_text(F.col("s")), data, "s bigint") == [
        "1 days 1 hours 1 minutes 1 seconds", "0 days 0 hours 0 minutes 0 seconds",
        "-2 days -2 hours -2 minutes -1 seconds", None,
    ]
    compact = text.duration_text(F.col("s"), compact=True)
    assert values(spark, compact, data[:1], "s bigint") == ["1 days 1 hours 1 minutes 1seconds"]


def test_elapsed(spark):
    data = [(datetime(2023, 12, 31, 10, 59, 58),), (at("12:00:05"),)]
    assert values(spark, text.elapsed_text(F.col("t"), NOW), data, "t timestamp_ntz") == [
        "1:1:0:2", "0:0:0:5",
    ]


def test_percentages(spark):
    data = [(12_345, 100_000), (1, 3), (1, 2000), (1, 2001), (5, 0), (None, 5), (5, None),
            (-1, 3), (-1, 100_000), (7, 7)]
    assert values(spark, text.pct_text(F.col("x"), F.col("y")), data, "x bigint, y bigint") == [
        "12.3%", "33.3%", "0.1%", "0.0%", None, None, None, "-33.3%", "0.0%", "100.0%",
    ]


def test_codes(spark):
    data = [("Powered-On",), ("powered-on",), ("Created",), ("SUSPENDED",), ("Deleted",), ("x",),
            (None,)]
    op = F.col("o")
    assert values(spark, status.op_code(op), data, "o string") == [3, 3, 2, 4, 5, 5, 5]
    assert values(spark, status.power_action(op), data, "o string") == [
        "in", "in", "in", "out", "out", "out", "out",
    ]


def test_status_and_clock(spark):
    data = [(at("12:00"),), (at("11:59"),), (None,)]
    end = F.col("e")
    assert values(spark, status.lab_status(end, NOW), data, "e timestamp_ntz") == [
        "Active", "Deleted", "Deleted",
    ]
    assert values(spark, clock.clipped_end(end, at("11:59:30")), data, "e timestamp_ntz") == [
        at("11:59:30"), at("11:59"), None,
    ]
    inside = status.covers(F.lit("2024-01-01 11:59:00").cast("timestamp_ntz"), end, NOW)
    assert values(spark, inside, data, "e timestamp_ntz") == [True, False, None]
    low, high = 1_704_110_340, 1_704_110_400  # 11:59 and 12:00
    ranged = status.started_between(end, low, high)
    assert values(spark, ranged, data, "e timestamp_ntz") == [True, True, None]


def test_filters(spark):
    data = [("Lab 1", "Ann@x", "R", "M", True), ("lab 2", "bob@x", "r", "N", False),
            ("Lab 3", None, None, "M", None)]
    df = spark.createDataFrame(
        data, "lab string, email string, region string, manager string, ase boolean"
    )

    def labs(filtered):
        return [r.lab for r in filtered.collect()]

    assert labs(status.report_filter(df)) == ["Lab 1", "lab 2", "Lab 3"]
    assert labs(status.report_filter(df, labs=["lab 1", "LAB 2"], regions=["r"])) == ["Lab 1", "lab 2"]
    assert labs(status.report_filter(df, owners=["ann"], managers=["M"])) == ["Lab 1"]
    assert labs(status.report_filter(df, labs=[])) == []
    flagged = [labs(df.filter(status.flag_filter(F.col("ase"), mode))) for mode in (0, 1, 2)]
    assert flagged == [["lab 2"], ["Lab 1"], ["Lab 1", "lab 2"]]
    assert values(spark, status.yes_no(F.col("f")), [(True,), (False,), (None,)], "f boolean") == [
        "YES", "NO", "NO",
    ]
