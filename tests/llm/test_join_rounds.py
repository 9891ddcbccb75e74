"""The n-gram join's large groups: few rounds, and no link lost in blocks."""

import collections
import random

import pytest

from labmeter.llm import ngram_join
from tests.llm import brute


@pytest.fixture
def rows():
    """30 clusters of 4 near copies. Texts of different clusters have 62 to 64 of 76 shingles in common, meet in large groups and do not
    link, as 66 would do."""
    rng = random.Random(6)
    made = []
    for i in range(30):
        base = [f"own{i}", *[f"w{j}" for j in range(1, 80)]]
        base[rng.randrange(8, 70)] = f"inner{i}"
        made += [(4 * i + copy, " ".join([*base[:-1], f"copy{i}-{copy}"])) for copy in range(4)]
    return made


def counted(monkeypatch):
    made, keep = collections.Counter(), ngram_join.keep

    def counting(df, name):
        made[name] += 1
        return keep(df, name)

    monkeypatch.setattr(ngram_join, "keep", counting)
    return made


def components(spark, rows):
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def test_large_groups_take_few_rounds(spark, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "GROWTH", 2)
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 4)
    made = counted(monkeypatch)
    found = components(spark, rows)
    assert found == brute.components(rows)
    assert 1 < len({c for _, c in found.values()}) < len(rows)
    assert made["open-groups"] <= 2 and made["index"] == 1, made


@pytest.mark.parametrize("apart, block", [(64, 2), (8, 3), (1, 1)])
def test_blocks_lose_no_link(spark, monkeypatch, rows, apart, block):
    monkeypatch.setattr(ngram_join, "GROWTH", 2)
    monkeypatch.setattr(ngram_join, "MOST_APART", apart)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    assert components(spark, rows) == brute.components(rows)


def test_blocks_hold_each_pair_once_or_in_one_component(spark):
    """All pairs of members of different components that sizes, reaches and sketches allow, whatever the block."""
    groups = [(s, r, 100, 100, True, [0] * ngram_join.SKETCH_WORDS) for s in (1, 2) for r in range(20 * s)]
    labels = spark.createDataFrame([(r, r % 7 if r % 3 else 0) for r in range(40)], "ref long, label long")
    label = {r.ref: r.label for r in labels.collect()}
    groups = spark.createDataFrame(groups, "sig long, ref long, size long, reach int, own boolean, sketch array<long>")
    opened = ngram_join._open(groups, labels)
    found = [(r.a, r.b) for r in ngram_join._pairs_apart(groups, opened, labels, 75).collect()]
    wanted = {(a, b) for a in range(40) for b in range(a + 1, 40) if label[a] != label[b]}
    assert len(found) == len(set(found)) and set(found) == wanted
