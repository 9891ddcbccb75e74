"""The stored index and the q-gram lookup against brute force."""

import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from labmeter.operators import attribution, contains
from labmeter.operators.cell_index import CellIndex
from labmeter.sources import schemas
from labmeter.streaming import ingest
from tests.helpers import at, plan_of, reservations, rows
from tests.test_attribution import EVENTS, brute_force, lab

LATE = timedelta(days=40)


def random_labs(seed, size):
    rng = random.Random(seed)
    texts = ["10.1.1.1", "10.1.1.12", "10.240.1.1", "10.240.1.15", "10", "", "a-long-host-name.example", None]
    made = []
    for i in range(size):
        start = at("08:00") + timedelta(seconds=rng.randrange(200_000))
        made.append(lab(f"vm{seed}-{i:03}", rng.choice(texts), start, start + timedelta(seconds=rng.choice([-1, 0, 59, 7300, 400_000]))))
    return made


def random_events(size):
    rng = random.Random(9)
    texts = ["10.1.1.12", "10.240.1.1", "10.240.1.15", "A-Long-Host-Name.example:22", "99", "", None]
    return [(i, at("08:00") + timedelta(seconds=rng.randrange(400_000)), rng.choice(texts)) for i in range(size)]


def folded_brute(events, labs, exact=False):
    return brute_force([(i, ts, a and a.lower()) for i, ts, a in events], labs, exact)


def found(df):
    return {r.event_id: (r.vm_name, r.match_count) for r in df.collect()}


@pytest.mark.parametrize("exact", [False, True])
def test_index_equals_brute_force_after_merges_and_compaction(spark, tmp_path, exact):
    labs, events = [random_labs(s, 60) for s in range(3)], random_events(200)
    index, df = CellIndex(spark, str(tmp_path / "index"), buckets=8), spark.createDataFrame(events, EVENTS)
    assert set(found(index.attribute(df, exact=exact)).values()) == {(None, 0)}
    for batch, part in enumerate(labs):
        assert index.merge(reservations(spark, part), batch)
        assert not index.merge(reservations(spark, part), batch)  # a repeated batch changes nothing
    wanted = folded_brute(events, sum(labs, []), exact)
    assert found(index.attribute(df, exact=exact)) == wanted
    index.compact()
    assert found(index.attribute(df, exact=exact)) == wanted
    assert not index.merge(reservations(spark, labs[2]), 2)
    assert index.merge(reservations(spark, random_labs(7, 30)), 3)
    assert found(index.attribute(df, exact=exact)) == folded_brute(events, sum(labs, random_labs(7, 30)), exact)


def test_changed_reservations_replace_what_was_known(spark, tmp_path):
    events = random_events(150)
    first, second = random_labs(1, 80), [x for x in random_labs(2, 80) if x["rdp"] in ("10.240.1.1", "")]
    index = CellIndex(spark, str(tmp_path / "index"), buckets=4)
    index.merge(reservations(spark, first), 0)
    index.merge(reservations(spark, second), 5, changed=True)
    kept = [x for x in first if x["rdp"] not in ("10.240.1.1", "")] + second
    df = spark.createDataFrame(events, EVENTS)
    assert found(index.attribute(df)) == folded_brute(events, kept)
    index.compact()
    assert found(index.attribute(df)) == folded_brute(events, kept)


def test_a_batch_that_was_not_finished_does_not_count(spark, tmp_path, monkeypatch):
    index, df = CellIndex(spark, str(tmp_path / "index")), spark.createDataFrame([(1, at("09:00"), "10.1.1.1")], EVENTS)
    one = reservations(spark, [lab("one", "10.1.1.1", at("08:00"), at("10:00"))])
    monkeypatch.setattr(CellIndex, "_mark", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.merge(one, 0)
    monkeypatch.undo()
    assert found(index.attribute(df)) == {1: (None, 0)}
    assert index.merge(one, 0) and found(index.attribute(df)) == {1: ("one", 1)}


def test_a_lookup_reads_the_buckets_of_its_addresses_only(spark, tmp_path):
    labs = [lab(f"vm{i}", f"10.240.{i % 7}.{i}", at("08:00"), at("10:00")) for i in range(300)]
    reservations(spark, labs).write.parquet(str(tmp_path / "reservations"))
    index = CellIndex(spark, str(tmp_path / "index"))
    index.merge(spark.read.parquet(str(tmp_path / "reservations")), 0)
    located = index.attribute(spark.createDataFrame([(1, at("09:00"), "10.240.5.299")], EVENTS))
    assert found(located) == {1: ("vm299", 1)}
    assert not any("/reservations/" in f for f in located.inputFiles())
    scans = [line for line in plan_of(located).splitlines() if "FileScan" in line]
    pruned = [re.search(r"PartitionFilters: \[[^\]]*bucket", line) is not None for line in scans]
    assert scans and all(pruned), scans
    asked = index._located(attribution.distinct_moments(located.select("address", "ts")), "g0", [0], 10, False)
    assert [r.rdp for r in asked.collect()] == ["10.240.5.299"]  # 1 of 64 buckets of cells is read


def test_streams_keep_and_use_the_index(spark, tmp_path):
    schema = "event_id bigint, ts timestamp_ntz, action string, address string"
    index = CellIndex(spark, str(tmp_path / "index"))
    for i in range(2):
        part = [lab(f"vm{i}", f"10.240.1.{i}", at("08:00"), at("10:00"))]
        reservations(spark, part).write.mode("append").parquet(f"{tmp_path}/res")
        ingest.stream_index(
            spark.readStream.schema(schemas.RESERVATIONS).parquet(f"{tmp_path}/res"), index, f"{tmp_path}/c1", available_now=True,
        ).awaitTermination(120)
        events = [(10 * i, at("09:00"), "in", "10.240.1.0"), (10 * i + 1, at("09:00"), "out", "10.240.1.1")]
        spark.createDataFrame(events, schema).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.stream_attribute(
            spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), index, f"{tmp_path}/out", f"{tmp_path}/c2", available_now=True,
        ).awaitTermination(120)
    stored = {t: rows(ingest.stored_events(spark, f"{tmp_path}/out", t).select("event_id", "vm_name")) for t in ("Logins", "Logouts", "Rejected")}
    assert stored == {"Logins": {(0, "vm0"): 1, (10, "vm0"): 1}, "Logouts": {(11, "vm1"): 1}, "Rejected": {(1, None): 1}}


def test_parts_equal_plain_containment(spark):
    rng = random.Random(2)
    parts = ["".join(rng.choice("ab.") for _ in range(rng.randint(0, 20))) for _ in range(150)]
    texts = ["".join(rng.choice("abB.") for _ in range(rng.randint(0, 40))) for _ in range(150)] + [p.upper() + "x" for p in parts[:20]]
    texts.append(None)
    one, many = (spark.createDataFrame([(x,) for x in v], f"{n} string") for v, n in ((texts, "address"), (parts, "rdp")))
    wanted = {(t, p) for t in texts if t is not None for p in parts if p in t.lower()}
    assert set(map(tuple, contains.containing(one, "address", many).collect())) == wanted
    assert contains.containing(one, "address", many.filter("false")).count() == 0


def test_each_part_stands_once_under_its_rarest_gram(spark):
    """A third of all parts share a frequent beginning; it is nobody's entry, and rows grow with the text's length only."""
    parts = [f"10.240.1.{i}" for i in range(100)] + [f"host-{i:05}.lab" for i in range(200)]
    df = spark.createDataFrame([(p,) for p in parts], "rdp string")
    entered = contains.rare_grams(df)
    assert entered.count() == len(parts)
    most = entered.groupBy("gram").count().agg(F.max("count")).first()[0]
    assert most <= 15
    asked = contains.lookup_grams(spark.createDataFrame([("10.240.1.77",)], "address string"), "address", F.lit(8))
    assert asked.count() <= 3 * len("10.240.1.77")
    again = contains.rare_grams(df, taken=entered.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    assert again.count() == len(parts)


def test_the_time_range_and_the_moments_are_read_once_each(spark, tmp_path):
    spark.createDataFrame([(1, at("09:00"), "10.240.1.1")], EVENTS).write.parquet(f"{tmp_path}/e")
    labs = reservations(spark, [lab("one", "10.240.1.1", at("08:00"), at("10:00"))])
    found_first = attribution.lookup_first(spark.read.parquet(f"{tmp_path}/e"), [labs, labs])
    assert found_first.first().match_count == 1
    final = found_first._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(address") <= 6


def test_a_stored_lookup_reads_events_once_for_the_texts_and_few_cells(spark, tmp_path):
    labs = [lab(f"vm{i}", f"10.240.{i % 7}.{i}", at("08:00:01") + LATE * i, at("10:00:07") + LATE * (i + 1)) for i in range(30)]
    index = CellIndex(spark, str(tmp_path / "index"), buckets=4)
    index.merge(reservations(spark, labs), 0)
    index.merge(reservations(spark, [lab("new", "10.240.1.1", at("08:00"), at("09:00"))]), 1, changed=True)
    assert spark.read.parquet(str(tmp_path / "index" / "g0" / "cells")).count() < 80 * len(labs)  # 40 days each
    events = [(i, at("08:30") + LATE * (i // 2), f"10.240.{i % 7}.{i}") for i in range(30)]
    spark.createDataFrame(events, EVENTS).write.parquet(str(tmp_path / "events"))
    df = spark.read.parquet(str(tmp_path / "events"))
    stored = index.attribute(df, scratch=str(tmp_path / "lookup"))
    assert found(stored) == found(index.attribute(df)) and found(stored)[1] == ("new", 1)
    final = plan_of(stored).split("== Initial Plan ==")[0]
    assert sum("/events]" in line for line in final.splitlines() if "FileScan" in line) == 1
