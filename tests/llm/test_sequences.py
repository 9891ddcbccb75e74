"""Packing, periodic runs and alignment against plain versions, over nulls, empty and long texts, repeats and odd columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from labmeter.llm import alignment, bytepairs, packing, periods

SCHEMA = "doc_id long, text string, runs int, collapsed int, a_ids int, groups int, piece int, sequence_id string, block int, key int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["ab", "cd", "the", "Über", "𝒳", "中文", "x1", "don't", "A", "a"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    made += ["".join(rng.choice(["a", "é", " ", "  ", "\n", "\t", "\x0b", "▁", "\x00", "'s", "9"]) for _ in range(40)) for _ in range(40)]
    made += [" ".join(rng.choice("pq") for _ in range(rng.randint(5, 60))) for _ in range(60)]
    made += [" ".join(["one", "two", "three"] * rng.randint(1, 9) + ["end"]) for _ in range(10)]
    return [None, "", " \t", "é▁x", "<|endoftext|> <s>", "word " * 9000, "x" * 4000, "same text", "same text", *made]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names the operators use themselves, a repeated id and a null id."""
    rows = [(i if i not in (8, 20) else (7 if i == 8 else None), t, 1, 2, 3, 4, 5, "s", 6, 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bytepairs.MODEL)


def test_ids_equal_the_library_for_every_kind_of_code_point(texts, library):
    model = bytepairs.read()
    points = [chr(c) for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    probes = [f"a{c}b1{c}2 {c} .{c}.  {c}\n{c}{c}" for c in points] + [t or "" for t in texts]
    for low in range(0, len(probes), 20000):
        part = probes[low:low + 20000]
        for text, found in zip(part, library.encode_batch(part, add_special_tokens=False)):
            assert model.marked(text).tolist() == found.ids, text
    assert 50256 in model.marked("<|endoftext|>") and 50256 not in model.plain("<|endoftext|>")


def test_packing_keeps_every_token_in_order_without_gaps(docs, texts, library):
    packed = packing.pack(docs)
    assert packed.columns == ["doc_id", "piece", "start", "length", "tokens", "sequence_id", "offset"]
    rows = packed.collect()
    wanted = collections.Counter()
    for i, text in enumerate(texts):
        name = 7 if i == 8 else None if i == 20 else i
        wanted[name, tuple(library.encode(text or "", add_special_tokens=False).ids + [0])] += 1
    found = collections.defaultdict(dict)
    by_sequence = collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.tokens, "<u4").tolist()
        assert len(ids) == r.length <= 2048 and (r.piece == 0) == (r.start == 0) and (r.piece == 0 or r.length == 2048)
        by_sequence[r.sequence_id].append((r.offset, r.length, bytes(r.tokens)))
        if r.doc_id not in (7, None):
            found[r.doc_id][r.piece] = (r.start, ids)
    for name, parts in found.items():
        whole = [x for k in sorted(parts) for x in parts[k][1]]
        assert wanted[name, tuple(whole)] == 1
        assert [parts[k][0] for k in sorted(parts)] == np.cumsum([0, *[len(parts[k][1]) for k in sorted(parts)]])[:-1].tolist()
    assert len([r for r in rows if r.doc_id == 7]) == 2 and len([r for r in rows if r.doc_id is None]) == 1
    for parts in by_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0, *[p[1] for p in parts]])[:-1].tolist()
        assert sum(p[1] for p in parts) <= 2048
    total = sum(r.length for r in rows)
    assert -(-total // 2048) <= len(by_sequence) <= -(-total // 2048) + 1
    joined = {r.sequence_id: (r.length, bytes(r.tokens)) for r in packing.sequences(packed).collect()}
    assert joined == {k: (sum(p[1] for p in v), b"".join(p[2] for p in v)) for k, v in by_sequence.items()}


@pytest.mark.parametrize("shape", packing.SHAPES)
def test_plans_use_each_rank_once(shape):
    rng = random.Random(5)
    for most, number in ((2048, 3000), (700, 3000), (2048, 5), (3, 4000), (2048, 0)):
        histogram = collections.Counter(rng.randint(1, most) for _ in range(number))
        histogram[2048] += 40
        plan = packing.make_plan(histogram, shapes=(shape,))
        seen, used = collections.Counter(), collections.defaultdict(list)
        for length, rank, n, first, per, offset in plan.table().tolist():
            assert rank == seen[length]
            seen[length] += n
            for i in range(n):
                used[first + i // per].append((offset + i % per * length, length))
        assert seen == histogram and sorted(used) == list(range(plan.n_sequences))
        for parts in used.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= 2048


def test_grouping_beats_plain_best_fit_where_small_pieces_are_rare():
    rng = random.Random(7)
    histogram = collections.Counter(rng.randint(400, 1000) for _ in range(20000))
    plain = packing.Plan(2048)
    packing._best_fit(plain, [[n, 0, c] for n, c in histogram.items()], {})
    least = sum(n * c for n, c in histogram.items()) / 2048
    assert packing.make_plan(histogram).n_sequences < least * 1.02 < plain.n_sequences


def plain_runs(words, times=4, least=6):
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 2 * q:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(least, times * q))


def test_catchers_find_all_runs_however_words_arrive():
    rng = random.Random(5)
    for _ in range(400):
        words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 110))]
        for _ in range(rng.randint(0, 3)):
            if len(words) > 8:
                p, a = rng.randint(1, len(words) // 4), rng.randrange(len(words))
                for i in range(a, min(len(words), a + p * rng.randint(2, 7) + rng.randint(0, 3))):
                    words[i] = words[a + (i - a) % p]
        times, least = rng.choice([(4, 6), (4, 6), (2, 2), (3, 6)])
        catchers, step = periods.Catchers(len(words) // times, times, least), rng.choice([1, 3, 17, 200])
        for i in range(0, len(words), step):
            catchers.append(np.array(words[i:i + step], np.uint64) + np.uint64(99))
        assert [tuple(r) for r in catchers.runs().tolist()] == plain_runs(words, times, least), (words, times, step)


def test_one_word_over_and_over_stays_one_run():
    catchers = periods.Catchers(50_000)
    for _ in range(2):
        catchers.append(np.zeros(100_000, np.uint64))
    assert catchers.runs().tolist() == [[0, 200_000, 1]] and len(catchers.found) == 1


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_runs_and_what_they_leave_equal_the_plain_version(docs, texts):
    few = docs.filter("length(text) < 20000 or text is null")
    found = collections.Counter(map(tuple, periods.run_digest(periods.find_runs(periods.plant_repeats(few))).collect()))
    wanted, n_planted = collections.Counter(), 0
    for i, text in enumerate(texts):
        if text and len(text) >= 20000:
            continue
        name = 7 if i == 8 else None if i == 20 else i
        words = planted(name, text)
        n_planted += words != (text or "").encode().split()
        own = plain_runs(words)
        gone = {x for s, n, q in own for x in range(s + q, s + n)}
        top = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else None
        wanted[(
            name, len(own), *(top if top else (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()), sha(b" ".join(w for x, w in enumerate(words) if x not in gone)),
        )] += 1
    assert found == wanted and n_planted > 3
    kept = periods.find_runs(docs)
    assert kept.columns == [c for c in docs.columns if c not in ("runs", "collapsed")] + ["n_words", "runs", "collapsed"]
    assert kept.filter("text like 'word word%'").select("collapsed", "n_words").first() == ("word", 9000)


def plain_alignment(text, first, second):
    """Ids, groups and links of one text, by comparing all byte ranges."""
    if not text:
        return [], [], "", []
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    vocabulary = {i: bytes(bytepairs._letters()[c] for c in t) for t, i in first.get_vocab().items() if i in set(a)}
    bytes_a = [vocabulary[i] for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [second.id_to_piece(i)]]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], "", []
    ends = [np.cumsum([len(x) for x in part]).tolist() for part in (bytes_a, bytes_b)]
    starts = [[0, *e[:-1]] for e in ends]
    groups, low = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append("|".join(",".join(str(i) for i, e in zip(ids, own) if low < e <= cut) for ids, own in zip((a, b), ends)))
        low = cut
    links = [
        (x, y) for i, x in enumerate(a) for j, y in enumerate(b)
        if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])
    ]
    return a, b, ";".join(groups), links


def test_alignment_equals_the_plain_version(docs, texts):
    first, second = tokenizers.Tokenizer.from_file(bytepairs.MODEL), sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    first.encode_special_tokens = True
    few = docs.filter("length(text) < 1000 or text is null")
    plain, holders = [], collections.Counter()
    for i, text in enumerate(texts):
        if text is None or len(text) < 1000:
            own = plain_alignment(text, first, second)
            plain.append((7 if i == 8 else None if i == 20 else i, own))
            holders.update(set(own[3]))
    highest = collections.Counter()
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    wanted = collections.Counter(
        (name, len(a), len(b), groups.count("|"), len(links), sha(groups.encode()) if groups else "",
         sum(holders[x] == highest[x[0]] for x in links), sum(holders[x] for x in links))
        for name, (a, b, groups, links) in plain
    )
    for rows in (4096, 3):
        assert collections.Counter(map(tuple, alignment.count_links(few, block_rows=rows).collect())) == wanted
    assert sum(not r[1] for _, r in plain) >= 3
    spans = alignment.align(docs)
    assert spans.columns == [c for c in docs.columns if c not in ("a_ids", "groups")] + ["a_ids", "b_ids", "groups"]
    of = {name: own for name, own in plain}
    for r in spans.filter("doc_id is not null and doc_id <> 7 and (length(text) < 1000 or text is null)").collect():
        a, b, groups, _ = of[r.doc_id]
        assert (r.a_ids, r.b_ids) == (a, b)
        x = y = 0
        told = []
        for g in r.groups:
            told.append(",".join(map(str, a[x:g.a_end])) + "|" + ",".join(map(str, b[y:g.b_end])))
            x, y = g.a_end, g.b_end
        assert ";".join(told) == groups and (not a or r.groups[-1].byte_end == len((" " + r.text).encode()))


def test_empty_tables_stay_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).count() == 0
    assert periods.run_digest(periods.find_runs(periods.plant_repeats(none))).count() == 0
    assert alignment.count_links(none).count() == 0 and alignment.align(none).count() == 0


def test_text_ids_pass(spark):
    one = spark.createDataFrame([("k", "a b a b a b a b a b")], "name string, body string")
    assert packing.pack(one, ids="name", text="body").first()["name"] == "k"
    assert alignment.count_links(one, ids="name", text="body").first()["name"] == "k"
    assert periods.find_runs(one.withColumnRenamed("body", "text")).first()["collapsed"] == "a b"
    assert periods.run_digest(periods.find_runs(periods.plant_repeats(one, "name", "body")), "name").first()["name"] == "k"
    assert packing.cut(one, ids="name", text="body").select(F.sum("length")).first()[0] > 1
