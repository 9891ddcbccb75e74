"""Streams give the rows of their batch forms, across restarts and late events."""

import random
from datetime import datetime, timedelta

from labmeter.operators import attribution, changes, sessions, uptime
from labmeter.sources import schemas
from labmeter.streaming import ingest, pull, state
from tests.helpers import NOW, at, employees, reservations, rows

SESSION_EVENTS = "vm_name string, dt timestamp_ntz, action string"
OPS = "vm_name string, ts timestamp_ntz, op int"
FAR = datetime(2030, 1, 1)


def drain(stream, path, mode="append"):
    """Run a stream over what lies in its source, then end it."""
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def feed(spark, path, schema, batches, build):
    """Each batch arrives as files of its own and meets a restarted stream."""
    for batch in batches:
        spark.createDataFrame(batch, schema).repartition(3).write.mode("append").parquet(
            f"{path}/in")
        drain(build(spark.readStream.schema(schema).parquet(f"{path}/in")), path)
    return spark.read.parquet(f"{path}/out")


def random_times(seed, size):
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    return rng, [start + timedelta(seconds=30 * i + rng.randrange(3)) for i in range(size)]


def shuffled_batches(rng, log, size, delay):
    """Batches in time order whose rows come up to `delay` late, then one far-off second
    that moves the watermark past everything."""
    late = sorted(log, key=lambda r: r[1] + timedelta(seconds=rng.randrange(delay)))
    cuts = [late[i:i + size] for i in range(0, len(late), size)]
    return cuts


def test_sessions_equal_batch(spark, tmp_path):
    rng, times = random_times(1, 240)
    log = [(rng.choice("abb"), t, rng.choice(["in", "out"])) for t in times]
    log += [("b", times[100], "in")] * 5
    batches = shuffled_batches(rng, log, 100, 240)
    batches.append([("end", FAR, "in")])
    out = feed(spark, tmp_path, SESSION_EVENTS, batches, state.stream_sessions)
    batch = sessions.session_pairs(spark.createDataFrame(log, SESSION_EVENTS))
    latest = state.latest_rows(out, "login_ts", "logout_ts")
    assert rows(latest) == rows(batch)
    assert any(logout is None for _, _, logout in rows(latest))


def test_uptime_equals_batch(spark, tmp_path):
    rng, times = random_times(2, 240)
    log = [(rng.choice("abb"), t, rng.choice([0, 0, 1, 2, 3])) for t in times]
    log += [("b", times[80], op) for op in (0, 0, 1, 1, 2)]
    batches = shuffled_batches(rng, log, 100, 240)
    batches.append([("end", FAR, 0)])
    out = feed(spark, tmp_path, OPS, batches, state.stream_uptime)
    batch = uptime.uptime_intervals(spark.createDataFrame(log, OPS))
    latest = state.latest_rows(out, "power_on", "power_off")
    assert rows(latest) == rows(batch)
    assert any(off is None for _, _, off in rows(latest))


def test_events_past_the_watermark_are_dropped(spark, tmp_path):
    batches = [[("a", at("09:00"), "in")], [("a", at("11:00"), "out")], [("a", at("11:30"), "in")],
               [("a", at("09:30"), "out")], [("end", FAR, "in")], [("end", FAR, "in")]]
    out = feed(spark, tmp_path, SESSION_EVENTS, batches, state.stream_sessions)
    assert rows(state.latest_rows(out, "login_ts", "logout_ts")) == {
        ("a", at("09:00"), at("11:00")): 1, ("a", at("11:30"), None): 1}


def test_attribution_routes_and_keeps_rejects(spark, tmp_path):
    labs = reservations(spark, [
        {"vm_name": "one", "rdp": "10.240.1.1", "start_ts": at("08:00"), "end_ts": at("10:00")}])
    schema = "event_id bigint, ts timestamp_ntz, action string, address string"
    data = [(1, at("09:00"), "in", "10.240.1.1"), (2, at("09:30"), "out", "10.240.1.1"),
            (3, at("09:30"), "in", "10.9.9.9"), (4, at("11:00"), "out", "10.240.1.1")]
    for half in (data[:2], data[2:]):
        spark.createDataFrame(half, schema).write.mode("append").parquet(f"{tmp_path}/in")
        query = ingest.stream_attribute(
            spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), labs,
            f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True)
        query.awaitTermination(120)
    stored = {t: {r.event_id: r.vm_name for r in
                  ingest.stored_events(spark, f"{tmp_path}/out", t).collect()}
              for t in ("Logins", "Logouts", "Rejected")}
    assert stored == {"Logins": {1: "one"}, "Logouts": {2: "one"}, "Rejected": {3: None, 4: None}}
    batch = attribution.attribute_events(spark.createDataFrame(data, schema), labs)
    assert {r.event_id: r.vm_name for r in batch.collect()} == {
        **stored["Logins"], **stored["Logouts"], **stored["Rejected"]}


MADE = "2024-01-01-08:00:00:000001"
P, R = f"L-Persistent-(u)-{MADE}", f"L-(u)-{MADE}"


def change_tables(spark):
    labs = reservations(spark, [{"vm_name": P, "email": "ann@x"}, {"vm_name": R}])
    return labs, employees(spark, [{"email": "ann@x", "full_name": "Ann"}])


def test_change_streams_equal_the_feed(spark, tmp_path):
    labs, staff = change_tables(spark)
    log = [(P, at("09:00"), "Deleted"), (P, at("10:00"), "Suspended"), (P, at("11:00"), "deleted")]
    out = feed(spark, tmp_path / "log", schemas.POWER_LOG, [log[:2], log[2:]],
               lambda s: ingest.stream_changes(s, labs, staff))
    new = feed(spark, tmp_path / "new", schemas.RESERVATIONS, [labs.collect()],
               lambda s: ingest.stream_new_reservations(s, staff))
    power = spark.createDataFrame(log, schemas.POWER_LOG)
    batch = changes.extract_changes(labs, staff, power, at("00:00"), NOW, "deleted")
    assert out.columns == new.columns == batch.columns
    assert rows(out.unionByName(new.filter(new.vm_name == R))) == rows(batch)
    newest = changes.latest_changes(out.unionByName(new))
    assert {r.vm_name: r.modified for r in newest.collect()} == {P: at("11:00"), R: at("08:00")}


def test_creation_ops_stream(spark, tmp_path):
    labs, _ = change_tables(spark)
    out = feed(spark, tmp_path, schemas.RESERVATIONS, [labs.collect()], uptime.creation_ops)
    assert [tuple(r) for r in out.collect()] == [(P, None, 3)]


def test_pulls_advance_their_mark(spark, tmp_path):
    labs, staff = change_tables(spark)
    log = [(P, at("09:00"), "Deleted"), (P, at("11:00"), "Deleted")]
    store = str(tmp_path / "store")

    def pulled(now, size):
        power = spark.createDataFrame(log[:size], schemas.POWER_LOG)
        new = pull.pull_changes(labs, staff, power, store, at(now), at("00:00"))
        return sorted((r.vm_name == P, r.modified) for r in new.collect())

    assert pull.last_mark(spark, store) == (-1, None)
    assert pulled("10:00", 1) == [(False, at("08:00")), (True, at("09:00"))]
    assert pull.last_mark(spark, store) == (0, at("09:00"))
    assert pulled("10:30", 1) == []
    assert pulled("12:00", 2) == [(True, at("11:00"))]
    assert pull.last_mark(spark, store) == (2, at("11:00"))
    assert spark.read.parquet(f"{store}/changes").count() == 3
