"""Toxicity by multiple-instance learning.

Only documents have labels. A sentence's score rises with its words' weights: 0 where they sum up to none, else the part of a logistic
function above its value without words. A document's is the noisy-or of its sentences, 1 - prod(1 - p), so that length alone makes
no text toxic. Weights are fitted to the documents' labels through that noisy-or (with a small leak of the whole document), so
that they tell which sentences make a document toxic, and those are reported.

The fit uses a bounded sample: at most ``SAMPLE`` labelled documents of either label, the first by a hash of the id, that
have ``SAMPLE_WORDS`` words together (one of more than a hundredth of these comes last), and the features that MIN_DOCS of
them have (more, where otherwise more than ``MOST_FEATURES`` would stay). Features are counted and numbered by Spark; the
driver gets numbers of those that stay. After the first WARM steps only features with a weight or with a pull
above the shrinking go on; every REVIEW steps all others may come back. Scoring reads whole texts of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labmeter.llm.scratch import keep
from labmeter.llm.shingles import _BYTE, _POWER, buffers, lean, mix, runs, slices

SAMPLE = 4096
SAMPLE_WORDS = 3_000_000
MIN_DOCS = 5
MOST_FEATURES = 1 << 16
WARM, REVIEW, STEPS = 40, 200, 800
LEAK = 0.05
CLEAN_PART = 0.75
RATE = 1.0
SHRINK = 0.0002
START = -5.0
STEMS = (4, 5, 6, 7, 8)

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[128:] = False
_NOT_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Sentences:
    """Features of a column's sentences: hashes, first feature of each sentence, sentence counts and places by text."""

    words: np.ndarray
    first: np.ndarray
    at: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def sentences(column: pa.Array) -> Sentences:
    """A sentence ends at ``.``, ``!``, ``?`` or a line end; words are runs of letters, A-Z as a-z.

    The features of a word are the word and its first 4 to 8 bytes, as far as it is longer. ``begin`` and ``end`` count code points from the text's beginning.
    """
    data, at = buffers(column)
    start, size, total = runs(data, at, _NOT_LETTER)
    words = np.zeros((len(start), 1 + len(STEMS)), np.uint64)
    words[:, 0] = mix(total + size.astype(np.uint64))
    so_far = np.zeros(len(start), np.uint64)
    longer = np.arange(len(start))
    for i in range(STEMS[-1]):
        longer = longer[size[longer] > i + 1]  # a stem as long as the word adds nothing
        so_far[longer] += _BYTE[data[start[longer] + i]] * _POWER[i]
        if i + 1 in STEMS:
            words[longer, 1 + STEMS.index(i + 1)] = mix(so_far[longer] ^ np.uint64(i + 1))
    text = np.searchsorted(at, start, "right") - 1
    stop = np.searchsorted(np.flatnonzero(_STOP[data]), start)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (stop[1:] != stop[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    owner = text[first]
    base = points[at[owner]]
    return Sentences(
        words, first, np.searchsorted(owner, np.arange(len(at))),
        points[start[first]] - base, points[start[last] + size[last]] - base,
    )


@dataclass
class Model:
    """Sorted hashes of the words that count, their weights, and the bias of every sentence."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.marks = np.zeros(1 << 22, bool)  # most features are none of the words: one look tells
        self.marks[(self.words & np.uint64(len(self.marks) - 1)).astype(np.int64)] = True

    def sentence_scores(self, found: Sentences) -> np.ndarray:
        if not len(found.first):
            return np.zeros(0)
        each = np.zeros(found.words.size)
        flat = found.words.ravel()
        maybe = np.flatnonzero(self.marks[(flat & np.uint64(len(self.marks) - 1)).astype(np.int64)])
        if len(maybe):
            place = np.minimum(np.searchsorted(self.words, flat[maybe]), len(self.words) - 1)
            each[maybe] = np.where(self.words[place] == flat[maybe], self.weights[place], 0.0)
        return above(np.add.reduceat(each, found.first * found.words.shape[1]), self.bias)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def above(sums: np.ndarray, bias: float) -> np.ndarray:
    """What a sentence adds to having no words that count: (p - p0) / (1 - p0), never below 0."""
    least = logistic(np.array([bias]))[0]
    return np.maximum(0.0, (logistic(sums + bias) - least) / (1 - least))


def noisy_or(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) over the sentences of each text; 0 without sentences."""
    sums = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(scores, 1 - 1e-12)))])
    return -np.expm1(sums[at[1:]] - sums[at[:-1]])


def held_out(ids: Column) -> Column:
    return F.crc32(ids.cast("string").cast("binary")) % 5 == 0


def packed(found: Sentences, ends: np.ndarray, a: int, b: int) -> tuple[bytes, bytes]:
    """Distinct features of the sentences a to b, one sentence after the other, and their numbers."""
    each = [np.unique(found.words[ends[i]:ends[i + 1]]) for i in range(a, b)]
    each = [x[x != 0] for x in each]
    return b"".join(x.tobytes() for x in each), np.array([len(x) for x in each], np.int64).tobytes()


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch["text"]):
            found = sentences(batch["text"][low:high])
            ends = np.append(found.first, len(found.words))
            rows = []
            for a, b in zip(found.at[:-1], found.at[1:]):
                rows.append(packed(found, ends, a, b))
            yield pa.RecordBatch.from_arrays([
                batch["h"][low:high], batch["toxic"][low:high], pa.array([ends[b] - ends[a] for a, b in zip(found.at[:-1], found.at[1:])], pa.int64()),
                pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
            ], names=["h", "toxic", "n", "words", "sizes"])


def sample(docs: DataFrame, labels: DataFrame, ids: str, text: str, most: int, most_words: int) -> DataFrame:
    """(h, toxic, n, words, sizes) of the training documents. Several labels of one id: toxic if one says so."""
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col(ids).isNotNull() & ~held_out(F.col(ids)))
        .groupBy(ids).agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64(ids))
    )
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy("h").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = keep(chosen, "chosen")  # at most 2 * most rows of two numbers
    read = docs.select(F.col(ids), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), ids)
    packed = keep(
        read.select("h", "toxic", "text").mapInArrow(
            lean(_sampled), "h bigint, toxic int, n bigint, words binary, sizes binary"
        ), "sample",
    )
    first = Window.orderBy("late", "h").rowsBetween(Window.unboundedPreceding, 0)
    each = packed.groupBy("h").agg(F.min("n").alias("n")).withColumn("late", F.col("n") > most_words // 100)
    few = each.withColumn("sum", F.sum("n").over(first)).filter(F.col("sum") <= most_words).select("h")
    return packed.join(F.broadcast(few), "h").dropDuplicates(["h"])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each feature once a document."""
    for batch in batches:
        for row in batch.column("words"):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(row.as_py(), np.int64)))], names=["word"])


def features(sampled: DataFrame) -> np.ndarray:
    """Sorted hashes of the features to learn: those of MIN_DOCS documents, or of so many that at most MOST_FEATURES stay."""
    counted = keep(
        sampled.select("words").mapInArrow(lean(_distinct), "word bigint").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= MIN_DOCS), "features",
    )
    least, left = MIN_DOCS, 0
    for n, number in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):  # one row for each number of documents
        left += number
        if left > MOST_FEATURES:
            least = n + 1
            break
    words = counted.filter(F.col("n") >= least).select("word").toPandas()["word"].to_numpy()
    return np.sort(words.astype(np.int64).view(np.uint64))


def numbered_features(sampled: DataFrame, words: np.ndarray) -> DataFrame:
    """(h, toxic, places, sizes): numbers of the features of each sentence that has any, as 16 bits each, and how many each has."""
    shared = sampled.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = []
            for data, sizes in zip(batch.column("words"), batch.column("sizes")):
                own, sizes = np.frombuffer(data.as_py(), np.uint64), np.frombuffer(sizes.as_py(), np.int64)
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                held = known[place] == own
                number = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[held], minlength=len(sizes))
                rows.append((place[held].astype(np.uint16).tobytes(), number[number > 0].astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([
                batch.column("h"), batch.column("toxic"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
            ], names=["h", "toxic", "places", "sizes"])

    return sampled.select("h", "toxic", "words", "sizes").mapInArrow(lean(run), "h bigint, toxic int, places binary, sizes binary")


@dataclass
class Sample:
    """Labels of documents, numbers of the features of all their sentences in order, how many each sentence has, and the n + 1 places
    where each document's sentences begin."""

    labels: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    at: np.ndarray

    def only(self, kept: np.ndarray) -> Sample:
        """With those features only, numbered anew; sentences left without one go."""
        inside = kept[self.places]
        number = np.add.reduceat(inside, np.cumsum(self.sizes) - self.sizes, dtype=np.int32) if len(self.sizes) else self.sizes
        at = np.concatenate([[0], np.cumsum(number > 0)])[self.at]
        return Sample(self.labels, (np.cumsum(kept, dtype=np.int32) - 1)[self.places[inside]], number[number > 0], at)

    def pulls(self, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float, float]:
        """Slope of the loss by each weight and by the bias, and the loss: the log loss of the leaky noisy-or, clean documents weighing
        CLEAN_PART of all."""
        share = np.where(
            self.labels == 1, (1 - CLEAN_PART) / max(1, self.labels.sum()), CLEAN_PART / max(1, (1 - self.labels).sum())
        )
        if len(self.sizes):
            sums = np.add.reduceat(weights[self.places], np.cumsum(self.sizes) - self.sizes)
        else:
            sums = np.zeros(0)
        rises = sums >= 0
        p, least = logistic(sums + bias), float(logistic(np.array([bias]))[0])
        missed = (1 - LEAK) * (1 - noisy_or(above(sums, bias), self.at))
        pull = np.where(self.labels == 1, -missed / (1 - missed), 1.0) * share
        loss = float((share * np.where(self.labels == 1, -np.log(1 - missed), -np.log(np.maximum(missed, 1e-300)))).sum())
        each = np.repeat(pull, np.diff(self.at)) * rises
        slope = np.bincount(self.places, np.repeat(each * p, self.sizes), len(weights))
        return slope, float((each * (p - least)).sum()), loss


def fit(sample: Sample, n_features: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by proximal gradient steps with momentum; small weights shrink to none."""
    weights, bias, drift = np.zeros(n_features), START, 0.0
    speed = np.zeros(n_features)
    pace = RATE / (0.02 + np.bincount(sample.places, minlength=n_features) / max(1, len(sample.labels)))
    active, part = np.arange(n_features), sample
    for step in range(steps):
        if step == WARM or step and step % REVIEW == 0:
            slope, _, _ = sample.pulls(weights, bias)
            kept = (weights != 0) | (np.abs(slope) > SHRINK)
            speed[~kept] = 0
            active, part = np.flatnonzero(kept), sample.only(kept)
        slope, change, _ = part.pulls(weights[active], bias)
        speed[active] = 0.9 * speed[active] - 0.1 * slope
        drift = 0.9 * drift - 0.1 * change
        own = weights[active] + pace[active] * speed[active]
        weights[active] = np.sign(own) * np.maximum(0, np.abs(own) - pace[active] * SHRINK)
        bias = min(bias + drift, -3.0)
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, ids: str = "doc_id", text: str = "text", most: int = SAMPLE, most_words: int = SAMPLE_WORDS) -> Model:
    """Fit on the bounded sample; numbers of its features are all that reaches the driver. Without labels every text scores 0."""
    sampled = sample(docs, labels, ids, text, most, most_words)
    words = features(sampled)
    if not len(words):
        return Model(words, np.zeros(0), START)
    found = numbered_features(sampled, words).toPandas().sort_values("h")
    sizes = [np.frombuffer(x, np.int32) for x in found["sizes"]]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sizes])])
    places = np.frombuffer(b"".join(found["places"]), np.uint16).astype(np.int32)
    taken = Sample(found["toxic"].to_numpy(), places, np.concatenate(sizes), at)
    del found, sizes
    weights, bias = fit(taken, len(words))
    some = np.abs(weights) > 1e-3
    return Model(words[some], weights[some], bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score`` and ``offending``: (begin, end, score) of sentences of 0.5 or more; other columns pass.

    Null, empty and wordless texts score 0. Rows are scored one by one, so that repeated rows agree; an empty
    table stays empty. A column named like an added one is replaced.
    """
    docs = docs.drop("score", "offending")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            for low, high in slices(column):
                found = sentences(column[low:high])
                p = shared.value.sentence_scores(found)
                bad = np.flatnonzero(p >= 0.5)
                spans = [[] for _ in range(high - low)]
                for i, row in zip(bad.tolist(), (np.searchsorted(found.at, bad, "right") - 1).tolist()):
                    spans[row].append({"begin": int(found.begin[i]), "end": int(found.end[i]), "score": float(p[i])})
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(noisy_or(p, found.at)), pa.array(spans, kind)],
                    names=[*part.schema.names, "score", "offending"],
                )

    added = "score double, offending array<struct<begin:bigint,end:bigint,score:double>>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(added).fields])
    return docs.mapInArrow(lean(run), schema)
