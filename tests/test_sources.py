"""Readers and sinks on written tables."""

from datetime import datetime

import pytest

from labmeter.sources import conform, readers, schemas, sinks
from tests.helpers import at, employees, reservations, rows


def test_readers(spark, tmp_path):
    res = [{"vm_name": "v", "rdp": "10.1", "start_ts": at("08:00"), "email": "Ann@X"}]
    reservations(spark, res).write.parquet(f"{tmp_path}/res")
    read = readers.read_reservations(spark, f"{tmp_path}/res")
    assert read.schema.fieldNames() == schemas.RESERVATIONS.fieldNames()
    assert read.first().email == "ann@x"
    employees(spark, [{"email": "Ann@X", "ase": True}]).write.parquet(f"{tmp_path}/emp")
    assert readers.read_employees(spark, f"{tmp_path}/emp").first().email == "ann@x"
    for kind, schema in schemas.EVENT_TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{kind}")
        assert readers.read_events(spark, f"{tmp_path}/{kind}", kind).schema == schema
    spark.createDataFrame([("v", at("08:00"), None)], schemas.INTERVALS).write.parquet(
        f"{tmp_path}/intervals")
    assert readers.read_intervals(spark, f"{tmp_path}/intervals").count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("v", "in"), ("w", "out"), ("x", "other")],
                               "vm_name string, action string")
    for _ in range(2):
        sinks.route_events(df, f"{tmp_path}/routed")
        sinks.append_events(df, f"{tmp_path}/log")
    routed = spark.read.parquet(f"{tmp_path}/routed").select("vm_name", "target")
    assert rows(routed) == {("v", "Logins"): 2, ("w", "Logouts"): 2}
    assert spark.read.parquet(f"{tmp_path}/routed/target=Logins").count() == 2
    stored = spark.read.parquet(f"{tmp_path}/log")
    assert stored.count() == 6
    assert stored.filter("arrived > timestamp_ntz'2024-01-01'").count() == 6


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "vm_name string, ts timestamp_ntz, note string"
    first = [("a", at("08:00"), "x"), ("a", at("08:00"), "x"), ("a", at("09:00"), "x"), (None, None, None)]
    second = [*first, ("b", at("08:00"), "x"), ("a", at("08:00", "2024-03-01"), "x")]
    assert sinks.append_once(spark.createDataFrame(first, schema), path, ["vm_name", "ts"]) == 3
    files = {f.name for f in (tmp_path / "log").rglob("*.parquet")}
    assert sinks.append_once(spark.createDataFrame(first, schema), path, ["vm_name", "ts"]) == 0
    assert {f.name for f in (tmp_path / "log").rglob("*.parquet")} == files
    assert sinks.append_once(spark.createDataFrame(second, schema), path, ["vm_name", "ts"]) == 2
    stored = spark.read.parquet(path)
    assert rows(stored.select("vm_name", "ts")) == {(v, t): 1 for v, t, _ in second} and stored.filter("arrived is null").isEmpty()


def test_upserts_touch_only_the_buckets_of_their_names(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "changes"), "vm_name string, state string, modified timestamp_ntz"
    old = [(f"vm{i}", "old", at("08:00")) for i in range(40)]
    sinks.upsert_changes(spark.createDataFrame(old, schema), path, buckets=8)

    def files():
        return {f for f in (tmp_path / "changes/rows").rglob("*.parquet")}

    before = files()
    for _ in range(2):  # the second is a repeat
        sinks.upsert_changes(spark.createDataFrame([("vm1", "new", at("09:00")), ("vm1", "older", at("07:00"))], schema), path, buckets=8)
    assert len({f.parent for f in before - files()}) == 1
    wanted = {(v, "new" if v == "vm1" else s, at("09:00") if v == "vm1" else t): 1 for v, s, t in old}
    assert rows(sinks.stored_changes(spark, path).select("vm_name", "state", "modified")) == wanted
    with monkeypatch.context() as lost:  # the driver is lost when the new buckets lie aside
        put, calls = sinks._put_in_place, []
        lost.setattr(sinks, "_put_in_place", lambda *a: calls.append(1) or (put(*a) if len(calls) == 1 else 1 / 0))
        with pytest.raises(ZeroDivisionError):
            sinks.upsert_changes(spark.createDataFrame([("vm2", "new", at("09:00"))], schema), path, buckets=8)
    wanted.pop(("vm2", "old", at("08:00")))
    wanted["vm2", "new", at("09:00")] = 1
    sinks.upsert_changes(spark.createDataFrame([], schema), path, buckets=8)
    assert rows(sinks.stored_changes(spark, path).select("vm_name", "state", "modified")) == wanted


def test_readers_cut_times_to_whole_seconds(spark, tmp_path):
    path = str(tmp_path / "logins")
    rows = [("vm", datetime(2024, 1, 1, 9, 0, 0, 100_000)), ("vm", datetime(2024, 1, 1, 9, 0, 0, 900_000))]
    spark.createDataFrame(rows, "vm_name string, login_ts timestamp_ntz").write.parquet(path)
    read = readers.read_events(spark, path, "logins")
    assert {r.login_ts for r in read.collect()} == {datetime(2024, 1, 1, 9)}


def test_names_in_any_case_are_one_vm(spark, tmp_path):
    labs = reservations(spark, [{"vm_name": "Lab-1"}, {"vm_name": "LAB-2"}, {"vm_name": "lab-2"}, {}])
    logins = [("LAB-1", at("08:00")), ("lab-1", at("09:00")), ("Lab-2", at("08:00")), ("Gone", None), ("GONE", None), (None, at("07:00"))]
    wanted = {("Lab-1", at("08:00")): 1, ("Lab-1", at("09:00")): 1, ("LAB-2", at("08:00")): 1, ("gone", None): 2, (None, at("07:00")): 1}
    batch = spark.createDataFrame(logins, schemas.LOGINS)
    assert rows(conform.conform_names(batch, labs)) == wanted
    batch.write.parquet(f"{tmp_path}/in")
    stream = conform.conform_names(spark.readStream.schema(schemas.LOGINS).parquet(f"{tmp_path}/in"), labs)
    stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == wanted
