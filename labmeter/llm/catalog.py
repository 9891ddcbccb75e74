"""One query for each operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.llm import (
    alignment, chat, fingerprints, mixing, neighbours, ngram_join, packing, periods, pieces, pii, secrets, sharding, toxicity,
)
from labmeter.llm.scratch import table

Query = Callable[[SparkSession, str], DataFrame]
MARKED = "\\### Assistant: </turn> ok"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a session: they need not see the repository.

    Rows hold whole texts and sets, and a task holds several batches of them on either side: batches of 8 MB do, where
    the session leaves Spark's 64 MB.
    """
    if spark.conf.get(BATCH_BYTES) in ("64MB", "67108864", "67108864b"):
        spark.conf.set(BATCH_BYTES, "8m")
    context = spark.sparkContext
    if getattr(context, "_labmeter_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="labmeter-code-")) / "labmeter_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "labmeter").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    context._labmeter_shipped = True


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_digest(secrets.scan_secrets(docs, repository=F.struct("source", "lang")))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.count_links(table(spark, sf_dir, "documents"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(table(spark, sf_dir, "documents")))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"),
    )
    return chat.read_back(chat.format_conversations(turns.unionByName(one), stateless=True))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_of = packing.cut(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")
    return packing.place(pieces_of)


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periods.plant_repeats(table(spark, sf_dir, "documents"))
    return periods.run_digest(periods.find_runs(planted))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.count_links(table(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _shipped(query) for name, query in {
        "op1_mix_sources": mix, "op2_secret_scan": secret_scan, "op3_toxicity": toxic, "op4_ngram_join": join,
        "op5_neighbours": search, "op6_personal_data": personal, "op7_shards": shards, "op8_fingerprints": edits,
        "op9_pieces": encoded, "op10_chat": conversations,
        "op11_packing": packed, "op12_periods": periodic, "op13_alignment": aligned,
        "op4_ngram_links": links,
    }.items()
}

_WORD = r"[^\x20\x09-\x0D]+"

MIX_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
           md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM sources
), ordered AS (
    SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())
                - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
           sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM weighed
), clamped AS (
    SELECT *, budget * weight / open > source_size * 2.0 AS clamped FROM ordered
), level AS (
    SELECT 1.5::DOUBLE * sum(source_size) - coalesce(sum(source_size * 2.0::DOUBLE) FILTER (clamped), 0) AS budget,
           sum(weight) FILTER (NOT clamped) AS open FROM clamped
), targets AS (
    SELECT source, source_size,
           CASE WHEN clamped THEN source_size * 2.0::DOUBLE ELSE level.budget * weight / coalesce(level.open, 1.0) END AS target
    FROM clamped, level
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), running AS (
    SELECT s.*, sum(size) OVER (PARTITION BY source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                - sum(size) OVER (PARTITION BY source, key) / 2.0 AS middle
    FROM sized s
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN middle <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running JOIN rates ON running.source IS NOT DISTINCT FROM rates.source
"""

_TURN = r"replace(replace(replace({}, '\', '\\'), '#', '\#'), '<', '\<')"

CHAT_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{MARKED}'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || replace({_TURN.format("role")}, chr(10), '\\n') || chr(10)) + length({_TURN.format("text")})
           + length(chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

JOIN_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(x, y) AS (
    SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, least(sets.doc_id, coalesce(min(y), sets.doc_id)) AS component_id
FROM sets LEFT JOIN reach ON reach.x = sets.doc_id GROUP BY sets.doc_id, s
"""

LINKS_SQL = JOIN_SQL[:JOIN_SQL.index(", reach(x, y)")] + """
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, count(y)::BIGINT AS n_links
FROM sets LEFT JOIN links ON links.x = sets.doc_id GROUP BY sets.doc_id, s
"""

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans(kind: str, order: int, pattern: str, group: int) -> str:
    return f"""
    SELECT doc_id, source, lang, '{kind}' AS kind, {order} AS ord, regexp_extract_all(t, '{pattern}', {group}) AS v,
           regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM texts"""


SECRET_SQL = f"""
WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents), found AS (
    {" UNION ALL ".join([
        _spans("assign", 0, _ASSIGN, 2), _spans("access", 1, "AKIA[A-Z0-9]+", 0), _spans("hex", 2, "[0-9a-f]{24,}", 0),
        _spans("live", 3, "[A-Za-z0-9+/_=-]{20,}", 0),
    ])}
), rows AS (
    SELECT doc_id, source, lang, kind, ord, v[i] AS value, m[i] AS match,
           (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)
), spans AS (
    SELECT *, start + length(match) AS stop, sha256(value) AS digest,
           regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 10 AS random
    FROM rows WHERE length(value) >= CASE kind WHEN 'assign' THEN 6 WHEN 'hex' THEN 24 ELSE 20 END
), candidates AS (
    SELECT * FROM spans WHERE kind <> 'live' OR random
), owned AS (
    SELECT digest, count(DISTINCT coalesce(source, '')) AS owners,
           count(DISTINCT coalesce(source, '') || chr(1) || coalesce(lang, '')) AS repositories
    FROM candidates GROUP BY digest
), told AS (
    SELECT c.*, CASE WHEN owners >= 3 THEN 'example' WHEN owners = 1 AND repositories <= 2 AND random THEN 'live' ELSE 'shared' END AS class
    FROM candidates c JOIN owned USING (digest)
), kept AS (
    SELECT * FROM told a WHERE kind <> 'live' OR (class = 'live' AND NOT EXISTS (
        SELECT 1 FROM told b WHERE b.doc_id = a.doc_id AND b.kind <> 'live' AND b.start < a.stop AND a.start < b.stop))
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign')::BIGINT AS n_assign, count(*) FILTER (kind = 'access')::BIGINT AS n_access,
       count(*) FILTER (kind = 'hex')::BIGINT AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (kind <> 'live'), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (kind IS NOT NULL), '') AS spans,
       count(*) FILTER (class = 'live')::BIGINT AS n_live, count(*) FILTER (class = 'example')::BIGINT AS n_example
FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""

ORACLES = {"op1_mix_sources": MIX_SQL, "op2_secret_scan": SECRET_SQL, "op4_ngram_join": JOIN_SQL, "op10_chat": CHAT_SQL, "op4_ngram_links": LINKS_SQL}
