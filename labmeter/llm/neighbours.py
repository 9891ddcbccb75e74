"""Approximate nearest neighbours on robust-pruned directed graphs, one graph per shard.

Inner products become distances by one more component: with m the largest norm of the shard, x is
extended by sqrt(m * m - |x| * |x|) and a query by 0; the nearest vector then has the largest inner product. A graph is
built in growing batches: greedy searches from ENTRIES nodes propose neighbours, robust pruning keeps a
candidate unless a kept one is ``alpha`` times closer to it than the vector is, and edges get their reverse. Queries
run a beam search on the graph of every shard, in blocks of queries; results of the shards are merged by rank.

Equal vectors are one node with its smallest ids: copies add no nodes and no rows to a search. Shards have about
SHARD_ROWS nodes whatever the table, and every vector is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmeter.llm.scratch import keep

SHARD_ROWS = 4096
QUERY_ROWS = 2048
DEGREE = 24
BEAM = 64
BUILD_BEAM = 48
ALPHA = 1.2
ENTRIES = 64
BATCH = 512


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and one at least not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def beam_search(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes (-1: none) and squared distances of the final beam, nearest first."""
    count = len(queries)
    ids = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf, np.float32)
    done = np.ones((count, beam), bool)
    first = ((queries[:, None, :] - points[entries][None, :, :]) ** 2).sum(2)
    order = np.argsort(first, 1, kind="stable")[:, :beam]
    begun = order.shape[1]
    ids[:, :begun] = entries[order]
    far[:, :begun] = np.take_along_axis(first, order, 1)
    done[:, :begun] = False
    live = np.arange(count)
    while len(live):
        open_far = np.where(done[live], np.inf, far[live])
        best = open_far.argmin(1)
        some = np.isfinite(open_far[np.arange(len(live)), best])
        live, best = live[some], best[some]
        if not len(live):
            break
        done[live, best] = True
        fresh = edges[ids[live, best]]
        known = (fresh[:, :, None] == ids[live][:, None, :]).any(2) | (fresh < 0)
        d = ((points[fresh] - queries[live][:, None, :]) ** 2).sum(2)
        d = np.where(known, np.inf, d).astype(np.float32)
        all_ids = np.concatenate([ids[live], fresh], 1)
        all_far = np.concatenate([far[live], d], 1)
        all_done = np.concatenate([done[live], known], 1)
        order = np.argsort(all_far, 1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, order, 1)
        far[live] = np.take_along_axis(all_far, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1) | ~np.isfinite(far[live])
    ids[~np.isfinite(far)] = -1
    return ids, far


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours for each node out of its candidates (-1: none)."""
    ordered = np.sort(candidates, 1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    ordered[ordered == nodes[:, None]] = -1
    vectors = points[ordered]
    own = ((vectors - points[nodes][:, None, :]) ** 2).sum(2)
    own = np.where(ordered < 0, np.inf, own)
    found = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    left = own.copy()
    for slot in range(degree):
        best = left.argmin(1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        found[some, slot] = ordered[rows[some], best[some]]
        between = ((vectors - vectors[rows, best][:, None, :]) ** 2).sum(2)
        drop = (alpha * alpha * between <= own) & some[:, None]
        left[drop] = np.inf
        left[rows[some], best[some]] = np.inf
    return found


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Edges (nodes x degree, -1: none) and the entries: a seeded choice of nodes where searches begin.

    A second pass over all nodes lets early nodes see late ones.
    """
    count = len(points)
    edges = np.full((count, degree), -1, np.int64)
    order = np.random.default_rng(7).permutation(count)
    entry = order[:ENTRIES]
    edges[entry] = robust_prune(points, entry, np.tile(entry, (len(entry), 1)), degree, alpha)
    steps, size, at = [], ENTRIES, ENTRIES
    while at < count:
        steps.append(order[at:at + size])
        at += size
        size = min(BATCH, 2 * size)
    steps += [order[i:i + BATCH] for i in range(0, count, BATCH)] if count > BATCH else []
    for batch in steps:
        near, _ = beam_search(points, edges, entry, points[batch], beam)
        edges[batch] = robust_prune(points, batch, np.concatenate([near, edges[batch]], 1), degree, alpha)
        source, target = np.repeat(batch, degree), edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, number = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(nodes), BATCH):
            some, start, size_of = nodes[low:low + BATCH], first[low:low + BATCH], np.minimum(number[low:low + BATCH], 2 * degree)
            added = np.full((len(some), size_of.max()), -1, np.int64)
            cells = np.repeat(np.arange(len(some)), size_of)
            within = np.arange(size_of.sum()) - np.repeat(np.cumsum(size_of) - size_of, size_of)
            added[cells, within] = source[np.repeat(start, size_of) + within]
            edges[some] = robust_prune(points, some, np.concatenate([edges[some], added], 1), degree, alpha)
    return edges, entry


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the shard's vectors, the ids of each, and its graph."""
    rows = rows.sort_values("least")
    vectors = np.array(rows["vector"].tolist(), np.float64)
    norms = (vectors * vectors).sum(1)
    extended = np.concatenate([vectors, np.sqrt(np.maximum(0, norms.max() - norms))[:, None]], 1).astype(np.float32)
    edges, entry = build_graph(extended)
    number = rows["ids"].map(len).to_numpy(np.int64)
    return pd.DataFrame([{
        "dim": int(rows["dim"].iloc[0]), "shard": int(rows["shard"].iloc[0]), "n": len(rows), "entry": entry.astype(np.int64).tobytes(), "vectors": vectors.tobytes(),
        "edges": edges.astype(np.int32).tobytes(), "number": number.tobytes(), "ids": np.concatenate(rows["ids"].to_list()).astype(np.int64).tobytes(),
    }])


def _searched(top: int, beam: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                vectors = np.frombuffer(row.vectors, np.float64).reshape(row.n, -1)
                edges = np.frombuffer(row.edges, np.int32).reshape(row.n, -1)
                number = np.frombuffer(row.number, np.int64)
                ids, first = np.frombuffer(row.ids, np.int64), np.cumsum(number) - number
                own = np.frombuffer(row.q_ids, np.int64)
                queries = np.frombuffer(row.q_vectors, np.float64).reshape(len(own), -1)
                norms = (vectors * vectors).sum(1)
                points = np.concatenate([vectors, np.sqrt(np.maximum(0, norms.max() - norms))[:, None]], 1).astype(np.float32)
                for low in range(0, len(own), BATCH):
                    some = queries[low:low + BATCH]
                    extended = np.concatenate([some, np.zeros((len(some), 1))], 1).astype(np.float32)
                    near, _ = beam_search(points, edges, np.frombuffer(row.entry, np.int64), extended, beam)
                    which, slot = np.nonzero(near >= 0)
                    node = near[which, slot]
                    score = (vectors[node] * some[which]).sum(1)
                    size = number[node]
                    cell = np.repeat(np.arange(len(node)), size)
                    member = ids[np.repeat(first[node], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
                    query = own[low:low + BATCH][which[cell]]
                    kept = member != query
                    query, member, score = query[kept], member[kept], score[cell][kept]
                    best = np.lexsort((member, -score, query))
                    query, member, score = query[best], member[best], score[best]
                    begin = np.searchsorted(query, query)
                    keep_rows = np.arange(len(query)) - begin < top
                    yield pd.DataFrame({"query_id": query[keep_rows], "vec_id": member[keep_rows], "score": score[keep_rows]})

    return run


def _blocks(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id")
    return pd.DataFrame([{
        "dim": int(rows["dim"].iloc[0]), "block": int(rows["block"].iloc[0]), "q_ids": rows["id"].to_numpy(np.int64).tobytes(),
        "q_vectors": np.array(rows["vector"].tolist(), np.float64).tobytes(),
    }])


def nearest(
    table: DataFrame, is_query: Column, top: int = 20, ids: str = "vec_id", vector: str = "embedding", beam: int = BEAM,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's largest inner products, ties to smaller ids.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without id. Vectors meet only
    those of equal length. Rows with the query's own id are never its neighbours; repeated rows count once. An empty table gives no rows.
    """
    wide = table.select(F.col(ids).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("q"))
    wide = wide.filter(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    wide = keep(wide.withColumn("key", F.md5(F.array_join(F.col("vector").cast("array<string>"), ",").cast("binary"))), "vectors")
    narrow = wide.select("key", "id").distinct().withColumn(
        "place", F.row_number().over(Window.partitionBy("key").orderBy("id"))
    ).filter(F.col("place") <= top + 1)  # a query's own id may be among them
    members = narrow.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = keep(
        wide.groupBy("key").agg(F.first("vector").alias("vector"), F.first("dim").alias("dim")).join(members, "key")
        .withColumn("least", F.get("ids", F.lit(0))), "nodes",
    )
    sizes = nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()  # a row per vector length
    shards, spread = F.lit(1), F.lit(1)
    asked = {r["dim"]: r["n"] for r in wide.filter("q").groupBy("dim").agg(F.count("*").alias("n")).collect()}
    for r in sizes:
        shards = F.when(F.col("dim") == r["dim"], math.ceil(r["n"] / shard_rows)).otherwise(shards)
        spread = F.when(F.col("dim") == r["dim"], math.ceil(asked.get(r["dim"], 0) / query_rows) or 1).otherwise(spread)
    graphs = keep(
        nodes.withColumn("shard", F.pmod(F.xxhash64("key"), shards).cast("int")).groupBy("dim", "shard").applyInPandas(
            _built, "dim int, shard int, n int, entry binary, vectors binary, edges binary, number binary, ids binary"
        ), "graphs",
    )
    queries = wide.filter("q").select("dim", "id", "vector").distinct()
    blocks = keep(
        queries.withColumn("block", F.pmod(F.xxhash64("id"), spread).cast("int")).groupBy("dim", "block")
        .applyInPandas(_blocks, "dim int, block int, q_ids binary, q_vectors binary"), "query-blocks",
    )
    work = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1))).join(graphs, ["dim", "shard"])
    parts = max(1, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = work.repartition(parts, "block", "shard").mapInPandas(_searched(top, beam), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = keep(found, "found").distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return found.select("query_id", "rank", "vec_id", "score")
