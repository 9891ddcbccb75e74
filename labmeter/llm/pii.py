"""Personal data by weak supervision, in DataFrame functions.

Labelers vote on every candidate span: its form (a checksum, digit groups), a gazetteer (reserved and
well-known names), and the context before and after it. Each vote is -1 (against), 0 (none) or 1. Spark
counts how often each pattern of votes and features occurs, per kind of candidate: there are at most
3 ** 5 * 8 patterns a kind, however large the corpus. Over these counts, expectation-maximisation
estimates each labeler's reliability and each pattern's probability, and a logistic classifier is
fitted to these soft labels on votes and features. Both run over the counted patterns; scoring is
one expression.

The base kinds keep all their spans. Candidates of the added kinds (``tel``: telephone numbers without a
plus sign; ``account``: other long numbers in groups) become spans where the classifier says so.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.llm.scratch import keep, numbered
from labmeter.llm.spans import Kind, match_rows, with_matches

_LOCAL = "A-Za-z0-9._%+-"
KINDS = [
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@[A-Za-z0-9-]"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Kind(
        "card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        r"[0-9](?:[\x20-]?[0-9]){15}",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Kind(
        "tel", r"(?<![0-9+])(?<![0-9][\x20().-])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[.-])[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])",
        r"[0-9]{3}[\x20.-][0-9]{4}", base=False,
    ),
    Kind("account", r"(?<![0-9])(?<![0-9][\x20-])[0-9]{4}(?:[\x20-][0-9]{4}){2,4}(?![\x20-]?[0-9])", r"[0-9]{4}[\x20-][0-9]{4}", base=False),
]
ADDED = [k.name for k in KINDS if not k.base]
#: Names that are never personal, words that come before personal data.
RESERVED = ("example.com", "example.org", "localhost", "invalid", "0.0.0.0", "127.0.0.1", "255.255.255.255")
CUES = {
    "email": "mail|contact|write|from|to", "ip": "ip|host|addr|server|client", "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|mobile|fax", "tel": "phone|tel|call|mobile|fax", "account": "account|iban|card|bank|pay",
}
AGAINST = r"(?i)(version|build|order|isbn|total|figure|page|serial)\W*$"
VOTES = ["v_form", "v_gazetteer", "v_before", "v_after", "v_layout"]
FEATURES = ["f_long", "f_grouped", "f_tail"]
ROUNDS = 30
FIT_ROUNDS = 200


def luhn(value: Column) -> Column:
    """Whether the digits of the value pass the checksum of card numbers."""
    digits = F.reverse(F.split(F.regexp_replace(value, "[^0-9]", ""), ""))
    places = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
    ))
    return F.aggregate(places, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def holds(kind: Column, value: Column) -> Column:
    """The rules that a match must keep to be a span."""
    low_parts = F.forall(F.split(value, r"\."), lambda p: F.regexp(p, F.lit("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    return (
        F.when(kind == "ip", low_parts).when(kind == "card", _digits(value).between(16, 19) & luhn(value))
        .when(kind == "phone", _digits(value).between(8, 15)).otherwise(True)
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def votes(rows: DataFrame) -> DataFrame:
    """Adds a column for every labeler and feature."""
    kind, value = F.col("kind"), F.col("match")
    cue = F.lit(False)
    for name, words in CUES.items():
        cue = F.when(kind == name, F.col("before").rlike(rf"(?i)\b(?:{words})\b\W*$")).otherwise(cue)
    reserved = F.lit(False)
    for name in RESERVED:
        reserved = reserved | F.endswith(F.lower(value), F.lit(name))
    known = F.when(kind == "email", F.lower(value).rlike(r"\.(?:com|org|net|edu|gov|de|fr|es|uk|io)$")).when(
        kind.isin("phone", "tel"), value.rlike(r"(?:\+1\b|\b[2-9][0-9]{2}\b)")).when(kind == "account", value.rlike("^[3-6]")).otherwise(False)
    form = F.when(kind == "account", luhn(value)).when(kind == "email", value.rlike(r"^[A-Za-z]")).when(
        kind == "ip", ~value.rlike(r"(?:^|\.)0[0-9]")).otherwise(True)
    malformed = F.when(kind == "account", ~luhn(value)).when(kind == "ip", value.rlike(r"(?:^|\.)0[0-9]")).otherwise(False)
    return rows.withColumns({
        "v_form": _vote(form, malformed), "v_gazetteer": _vote(known & ~reserved, reserved),
        "v_before": _vote(cue | F.col("before").rlike(r"[A-Za-z]\W{1,3}$"), F.col("before").rlike(AGAINST)),
        "v_after": _vote(F.col("after").rlike(r"^[\s.,;:)\]]|^$"), F.col("after").rlike(r"^[A-Za-z0-9_/]")),
        "v_layout": _vote(F.col("before").rlike(r"(?:^|\s|[(\[])$"), F.col("before").rlike(r"[0-9A-Za-z_/]$")),
        "f_long": (F.length(value) > 15).cast("int"), "f_grouped": value.rlike(r"[\x20().-]").cast("int"),
        "f_tail": value.rlike("[0-9]$").cast("int"),
    })


@dataclass
class Model:
    """Per kind: the prior, each labeler's (rate of 1 | of -1) for both classes, the classifier's weights."""

    prior: dict[str, float]
    rates: dict[str, list[dict[tuple[int, int], float]]]
    weights: dict[str, list[float]]


def expectation_maximisation(patterns: list[tuple[list[int], int]], rounds: int = ROUNDS):
    """Prior, reliabilities and each pattern's probability, from counted vote patterns.

    Starts from the majority; every rate keeps one pseudo-count, so that no vote is certain.
    """
    belief = [1 / (1 + math.exp(-sum(v))) for v, _ in patterns]
    prior, rates = 0.5, []
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        yes = sum(b * n for b, (_, n) in zip(belief, patterns))
        prior = min(0.99, max(0.01, (yes + 1) / (total + 2)))
        rates = []
        for j in range(len(VOTES)):
            held = {}
            for y, mass in ((1, yes), (0, total - yes)):
                for v in (-1, 0, 1):
                    seen = sum(n * (b if y else 1 - b) for b, (p, n) in zip(belief, patterns) if p[j] == v)
                    held[y, v] = (seen + (2 if (v == 1) == (y == 1) and v else 1)) / (mass + 4)
            rates.append(held)
        belief = []
        for p, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(r[1, v] / r[0, v]) for r, v in zip(rates, p) if v)
            belief.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return prior, rates, belief


def fit_logistic(rows: list[tuple[list[int], int, float]], rounds: int = FIT_ROUNDS) -> list[float]:
    """Weights (bias first) by gradient steps on counted patterns with soft labels."""
    total = sum(n for _, n, _ in rows) or 1
    weights = [0.0] * (1 + len(VOTES) + len(FEATURES))
    for _ in range(rounds):
        slope = [0.01 * w for w in weights]
        for x, n, y in rows:
            z = sum(w * v for w, v in zip(weights, [1, *x]))
            off = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) * n / total
            for i, v in enumerate([1, *x]):
                slope[i] += off * v
        weights = [w - s for w, s in zip(weights, slope)]
    return weights


def train(candidates: DataFrame) -> Model:
    """Reliabilities and classifier of every kind, from the counted patterns (at most 3 ** 5 * 8 a kind)."""
    counted = candidates.groupBy("kind", *VOTES, *FEATURES).agg(F.count("*").alias("n")).collect()
    model = Model({}, {}, {})
    for kind in [k.name for k in KINDS]:
        own = sorted([r[c] for c in VOTES + FEATURES] + [r["n"]] for r in counted if r["kind"] == kind)
        if not own:
            continue
        prior, rates, belief = expectation_maximisation([(r[:len(VOTES)], r[-1]) for r in own])
        weights = fit_logistic([(r[:-1], r[-1], b) for r, b in zip(own, belief)])
        model.prior[kind], model.rates[kind], model.weights[kind] = prior, rates, weights
    return model


def classifier(model: Model) -> Column:
    """The fitted classifiers as one expression over the columns of ``votes``."""
    found = F.lit(0.0)
    for kind, weights in model.weights.items():
        z = F.lit(weights[0])
        for weight, name in zip(weights[1:], VOTES + FEATURES):
            z = z + F.lit(weight) * F.col(name)
        found = F.when(F.col("kind") == kind, 1 / (1 + F.exp(-z))).otherwise(found)
    return found


def find_pii(docs: DataFrame, ids: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: ids, carried columns, found: array of (ord, start, end, kind, probability).

    Null text: empty, no spans. Repeated rows are scanned each. Base spans are all there whatever their
    probability; spans of added kinds have at least 0.5 and overlap no base span. An empty table gives no rows.
    """
    carry = carry or []
    narrow = docs.select(F.col(ids).alias("id"), F.col(text).alias("text"), *[F.col(c).alias(f"c_{c}") for c in carry])
    found = numbered(with_matches(narrow, "text", KINDS).drop("text"), "pii-matches")
    own = ["row_no", "id", *[f"c_{c}" for c in carry]]
    some = F.greatest(*[F.coalesce(F.size(f"m_{k.name}"), F.lit(0)) for k in KINDS]) > 0
    rows = match_rows(found.filter(some), KINDS, ["row_no"]).filter(holds(F.col("kind"), F.col("match")))
    rows = keep(votes(rows).drop("match", "value", "before", "after"), "pii-votes")
    probability = classifier(train(rows))
    span = F.struct("ord", "start", "end", "kind", "probability")
    each = (
        rows.withColumn("probability", probability).groupBy("row_no")
        .agg(F.array_sort(F.collect_list(span)).alias("spans"))
    )
    each = each.withColumn("base", F.filter("spans", lambda s: ~s["kind"].isin(ADDED)))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    first = lambda s: ~F.exists("spans", lambda o: (o["kind"] == "tel") & (s["kind"] == "account") & (o["start"] < s["end"]) & (s["start"] < o["end"]))
    each = each.withColumn("found", F.filter("spans", lambda s: ~s["kind"].isin(ADDED) | ((s["probability"] >= 0.5) & free(s) & first(s))))
    none = F.array().cast(each.schema["found"].dataType)
    shown = [F.col("id").alias(ids), *[F.col(f"c_{c}").alias(c) for c in carry]]
    with_some = found.filter(some).select(*own).join(each.select("row_no", "found"), "row_no", "left")
    return with_some.select(*shown, F.coalesce("found", none).alias("found")).unionByName(
        found.filter(~some).select(*shown, none.alias("found"))
    )


def pii_digest(found: DataFrame, ids: str = "doc_id") -> DataFrame:
    """The counts, the digest of the base spans, all spans as text, and the number of added ones."""
    base = F.filter("found", lambda s: ~s["kind"].isin(ADDED))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    is_kind = lambda k: lambda s: s["kind"] == k
    number = lambda test: F.size(F.filter("found", test)).cast("long")
    return found.select(
        ids, *[number(is_kind(k.name)).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", text), ",").alias("spans"),
        number(lambda s: s["kind"].isin(ADDED)).alias("n_added"),
    )


def mask_pii(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by [KIND]; overlapping spans are replaced together. Other columns pass, whatever their names."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    whole = docs.select(F.col(ids).alias("own_id"), F.col(text).alias("own_text"), others.alias("own"))
    found = find_pii(whole, "own_id", "own_text", carry=["own_text", "own"])
    spans = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.col("own_text")

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(whole, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), F.concat(state["out"], F.array(gap, mark)).alias("out"))

    masked = F.aggregate(
        spans, start, step,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(whole, (state["at"] + 1).cast("int"), F.length(whole))),
    )
    shown = F.when(F.size("found") > 0, masked).otherwise(whole)
    return found.select(*[shown.alias(c) if c == text else F.col(f"own.`{c}`") for c in docs.columns])
