"""Any split of a log into batches, on time or late, gives the table that the whole log gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from labmeter.operators import fold_store, sessions, uptime
from labmeter.operators.fold_store import FoldStore
from labmeter.streaming import ingest, state
from tests.helpers import rows
from tests.test_streaming import FAR, OPS, SESSION_EVENTS, drain

START = datetime(2024, 1, 1)


def random_log(seed, size, kinds, days=60):
    """Few VMs over many weeks, with many events in one second."""
    rng = random.Random(seed)
    times = [START + timedelta(seconds=rng.randrange(days * 86_400)) for _ in range(size // 2)]
    return [(rng.choice(["a", "b", "b", "c"]), rng.choice(times), rng.choice(kinds)) for _ in range(size)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kind", ["sessions", "uptime"])
def test_every_split_gives_the_same_table(spark, tmp_path, seed, kind):
    fold, schema, whole = {
        "sessions": (fold_store.SESSIONS, SESSION_EVENTS, sessions.session_pairs),
        "uptime": (fold_store.UPTIME, OPS, uptime.uptime_intervals),
    }[kind]
    log = random_log(seed, 70, ["in", "out"] if kind == "sessions" else [0, 1, 2])
    if kind == "uptime":
        log = [r for r in log if r[0] != "c" or r[2]] + [("c", START, 0)] + [("d", r[1], 1) for r in log[:5]]
    store, seen = FoldStore(spark, str(tmp_path / "fold"), fold, buckets=3), []
    assert rows(store.table()) == {}
    rng = random.Random(seed)
    rng.shuffle(log)
    for batch, low in enumerate(range(0, len(log), 25)):
        part = log[low:low + 25]
        seen += part
        assert store.merge(spark.createDataFrame(part, schema), batch)
        assert not store.merge(spark.createDataFrame(part, schema), batch)
    assert rows(store.table()) == rows(whole(spark.createDataFrame(seen, schema)))


def test_a_merge_folds_only_the_slices_it_changes(spark, tmp_path):
    log = [("a", START + timedelta(days=7 * i), "in" if i % 2 else "out") for i in range(20)]
    log += [("other", r[1], r[2]) for r in log]
    store = FoldStore(spark, str(tmp_path / "fold"), fold_store.SESSIONS, buckets=2)
    store.merge(spark.createDataFrame(log, SESSION_EVENTS), 0)
    late = [("a", START + timedelta(days=70, hours=1), "in")]
    store.merge(spark.createDataFrame(late, SESSION_EVENTS), 1)
    changed = store._read("changed").filter("batch = 1").select("vm_name", "slice").collect()
    assert len(changed) == 3 and {r.vm_name for r in changed} == {"a"}
    assert rows(store.table()) == rows(sessions.session_pairs(spark.createDataFrame(log + late, SESSION_EVENTS)))


def test_an_unfinished_merge_does_not_count(spark, tmp_path, monkeypatch):
    store = FoldStore(spark, str(tmp_path / "fold"), fold_store.SESSIONS)
    first, second = [("a", START, "in")], [("a", START + timedelta(days=1), "out")]
    store.merge(spark.createDataFrame(first, SESSION_EVENTS), 0)
    write = FoldStore._write
    monkeypatch.setattr(FoldStore, "_write", lambda self, r, name, b: 1 / 0 if name == "rows" else write(self, r, name, b))
    with pytest.raises(ZeroDivisionError):
        store.merge(spark.createDataFrame(second, SESSION_EVENTS), 1)
    monkeypatch.undo()
    assert rows(store.table()) == {("a", START, None): 1}
    store.merge(spark.createDataFrame(second, SESSION_EVENTS), 1)
    assert rows(store.table()) == {("a", START, second[0][1]): 1}


def test_a_stream_with_rows_behind_its_watermark_equals_the_batch(spark, tmp_path):
    """What the watermarked stream drops, the store takes in."""
    log = random_log(5, 60, ["in", "out"], days=30)
    log.sort(key=lambda r: r[1])
    batches = [log[20:], [("end", FAR, "in")], log[:20]]  # the last one lies far behind the watermark
    store = FoldStore(spark, str(tmp_path / "fold"), fold_store.SESSIONS)
    source = spark.readStream.schema(SESSION_EVENTS)
    for part in batches:
        spark.createDataFrame(part, SESSION_EVENTS).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.stream_fold(source.parquet(f"{tmp_path}/in"), store, f"{tmp_path}/checkpoint", available_now=True).awaitTermination(120)
        drain(state.stream_sessions(source.parquet(f"{tmp_path}/in")), tmp_path / "marked")
    whole = sessions.session_pairs(spark.createDataFrame(sum(batches, []), SESSION_EVENTS))
    assert rows(store.table()) == rows(whole)
    dropped = state.latest_rows(spark.read.parquet(f"{tmp_path}/marked/out"), "login_ts", "logout_ts")
    assert rows(dropped.filter(F.col("vm_name") != "end")) != rows(whole.filter(F.col("vm_name") != "end"))
