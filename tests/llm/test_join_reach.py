"""Where sets of the n-gram join meet: linked ones always, sets that merely share a passage in no group that grows with their number."""

import collections
import random

import numpy as np

from labmeter.llm import ngram_join
from tests.llm import brute


def test_linked_sets_reach_each_other_in_a_common_combination():
    draw = np.random.default_rng(4)
    for size in (1, 2, 3, 5, 9, 30, 120):
        for _ in range(15):
            x = np.unique(draw.integers(1, 2**63, size, np.uint64))
            lost, added = int(draw.integers(0, size // 3 + 1)), int(draw.integers(0, size // 3 + 1))
            y = np.union1d(x[lost:], draw.integers(1, 2**63, added, np.uint64))
            both = len(np.intersect1d(x, y))
            if 100 * both < 75 * (len(x) + len(y) - both):
                continue
            for k in (2, 3):
                found = []
                for s in (x, y):
                    keys, reach, own = ngram_join.reaching(s, (s % 3 > 0).astype(int), np.isin(s, x) & np.isin(s, y), 75, k)
                    found.append({key: (r, o) for key, r, o in zip(keys.tolist(), reach.tolist(), own.tolist())})
                a, b = found
                assert any(
                    75 * (len(x) + len(y)) <= 175 * min(a[key][0], b[key][0]) and (a[key][1] or b[key][1]) for key in a.keys() & b.keys()
                ), (size, k)


def test_sets_that_share_a_passage_do_not_meet(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(120):  # two words changed: two such sets have at most 0.7 in common, and differ by 10 shingles of their own each
        words = [f"w{j}" for j in range(60)]
        for place in (rng.randrange(8, 28), rng.randrange(34, 52)):
            words[place] = f"own{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"v{j}" if j != i else "x" for j in range(60))) for i in (0, 59)]
    made, keep = collections.Counter(), ngram_join.keep

    def counting(df, name):
        kept = keep(df, name)
        made[name] += kept.count()
        return kept

    monkeypatch.setattr(ngram_join, "keep", counting)
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows)
    assert sum(r.component_id != r.doc_id for r in found) == 1
    assert made["index"] > 120 and made["groups"] + made["open-groups"] + made["leaders"] < 60, made
