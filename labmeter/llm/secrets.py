"""Secret scan with corpus-wide ownership frequency, in DataFrame functions.

Every candidate's value is hashed; values never leave as text. A first aggregation counts the
distinct repositories and owners of each hash (repeats are combined before they move). Values that
several owners have are examples (documentation, templates); a value that one owner has in at most ``most_repositories``
repositories and that looks random is live; the rest is shared.
Long tokens that no base kind covers are candidates too: those that are live
become spans of the kind ``live``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.llm.scratch import numbered
from labmeter.llm.spans import Kind, label, match_rows, with_matches

KINDS = [
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
        r"(?i:passw|secret|token|api_?key)", group=2,
    ),
    Kind("access", r"AKIA[A-Z0-9]++", r"AKIA[A-Z0-9]{16}"),
    Kind("hex", r"[0-9a-f]{24,}+", r"[0-9a-f]{24}"),
    Kind("live", r"(?:(?<![A-Za-z0-9+/_=-])|\G)[A-Za-z0-9+/_=-]{20,}+", r"[A-Za-z0-9+/_=-]{20}", base=False),
]
LEAST = {"assign": 6, "access": 20, "hex": 24, "live": 20}
MANY_OWNERS = 3
MOST_REPOSITORIES = 2
RANDOM_CHARACTERS = 10


def looks_random(value: Column) -> Column:
    """Letters and digits, and many different characters."""
    letters = F.array_distinct(F.split(value, ""))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(letters) >= RANDOM_CHARACTERS)


def scan_secrets(
    docs: DataFrame, ids: str = "doc_id", text: str = "text", owner: str = "source", repository: Column | None = None,
    many_owners: int = MANY_OWNERS, most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """One row per document: ids, found: array of (start, ord, end, kind, class, owners, repositories).

    Null text: empty, no spans. A null owner or repository counts as one of its own. Repeated rows
    are scanned each; the same value in them has the same owners. An empty table gives no rows.
    """
    repository = F.struct(F.col(owner)) if repository is None else repository
    narrow = docs.select(
        F.col(ids).alias("id"), F.col(text).alias("text"),
        F.coalesce(F.sha2(F.col(owner).cast("string"), 256), F.lit("")).alias("owner"),
        F.sha2(F.to_json(F.struct(repository.alias("r"))), 256).alias("repository"),
    )
    found = numbered(with_matches(narrow, "text", KINDS).drop("text"), "secret-matches")
    some = F.greatest(*[F.coalesce(F.size(f"m_{k.name}"), F.lit(0)) for k in KINDS]) > 0
    least = F.lit(None)
    for kind, size in LEAST.items():
        least = F.when(F.col("kind") == kind, size).otherwise(least)
    rows = match_rows(found.filter(some), KINDS, ["row_no", "owner", "repository"])
    rows = (
        rows.filter(F.length("value") >= least)
        .withColumn("random", looks_random(F.col("value")))
        .filter((F.col("kind") != "live") | F.col("random"))
        .withColumn("digest", F.sha2("value", 256))
        .select("row_no", "owner", "repository", "kind", "ord", "start", "end", "random", "digest")
    )
    owned = (
        rows.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
        .groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    kind_of = (
        F.when(F.col("owners") >= many_owners, "example")
        .when((F.col("owners") == 1) & (F.col("repositories") <= most_repositories) & F.col("random"), "live")
        .otherwise("shared")
    )
    span = F.struct("start", "ord", "end", "kind", kind_of.alias("class"), "owners", "repositories")
    each = rows.join(owned, "digest").groupBy("row_no").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    covered = lambda s: F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    each = each.withColumn("base", F.filter("spans", lambda s: s["kind"] != "live")).withColumn(
        "found", F.filter("spans", lambda s: (s["kind"] != "live") | ((s["class"] == "live") & ~covered(s)))
    )
    none = F.array().cast(each.schema["found"].dataType)
    with_some = found.filter(some).select("row_no", "id").join(each.select("row_no", "found"), "row_no", "left")
    return with_some.select(F.col("id").alias(ids), F.coalesce("found", none).alias("found")).unionByName(
        found.filter(~some).select(F.col("id").alias(ids), none.alias("found"))
    )


def secret_digest(found: DataFrame, ids: str = "doc_id") -> DataFrame:
    """The counts, the digest of the base spans, all spans as text, and counts by class."""
    base = F.filter("found", lambda s: s["kind"] != "live")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    is_kind = lambda k: lambda s: s["kind"] == k
    number = lambda test: F.size(F.filter("found", test)).cast("long")
    return found.select(
        ids, *[number(is_kind(k)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", text), ",").alias("spans"),
        number(lambda s: s["class"] == "live").alias("n_live"),
        number(lambda s: s["class"] == "example").alias("n_example"),
    )
