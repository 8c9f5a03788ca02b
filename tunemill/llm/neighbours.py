"""Approximate nearest neighbours by cosine on pruned directed graphs, one per shard.

Equal vectors are one node, which remembers its smallest ids; so a vector that
a third of all rows share is no burden, and ties go to the smallest ids exactly.
Nodes are dealt by a hash over shards of about ``shard_rows``.  Within a shard
nodes join the graph in growing batches: a greedy search from the entry node
proposes neighbours, relaxed distance pruning (a neighbour is dropped if a
chosen one is ``alpha`` times nearer to it than the node is) keeps edges that
lead in different directions, and each new edge is added backwards too, pruned
again where a node has too many.  A query runs a beam search in every shard.

The index is a table with a row per node, which may be stored.  Queries meet
shards in blocks of bounded size.  The scores that are returned are computed
from the original vectors in double precision.

Vectors that are NULL, all zero, empty, or hold NULL or non-finite components
take no part, nor do rows without an id.  Vectors of different lengths are
different spaces: a query sees those of its own length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import grouped_batches, stored

DEGREE, BEAM, ALPHA = 32, 64, 1.2
SHARD_ROWS = 8_192
QUERY_BLOCK = 4_096
SALTS = 32


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``_id`` and ``_vector`` (doubles) of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(values, lambda x: x == 0)
    rows = vectors.select(F.col(key).cast("bigint").alias("_id"), values.alias("_vector"))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad & ~zero)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """One row per vector: ``node`` (its smallest id), ``_vector``, ``ids`` (the ``keep`` smallest).

    Ranked within salted parts first, so that copies without number meet only
    as ``keep`` rows a part.
    """
    salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS))
    parts = Window.partitionBy("_vector", "_salt").orderBy("_id")
    few = rows.withColumn("_salt", salt).withColumn("_n", F.row_number().over(parts)).where(F.col("_n") <= keep)
    ids = F.slice(F.array_sort(F.collect_list("_id")), 1, keep)
    return few.groupBy("_vector").agg(ids.alias("ids")).select(F.get("ids", F.lit(0)).alias("node"), "_vector", "ids")


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # so that no square overflows
    scaled = vectors / largest
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(
    data: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``beam`` nearest nodes found for each query, nearest first (-1: none).

    All queries move together: in each round every query expands the nearest
    node of its beam that it has not yet expanded.
    """
    n = len(queries)
    ids = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    ids[:, 0] = entry
    far[:, 0] = 1 - queries @ data[entry]
    active = np.arange(n)
    while len(active):
        open_far = np.where(done[active] | (ids[active] < 0), np.inf, far[active])
        at = open_far.argmin(axis=1)
        more = np.isfinite(open_far[np.arange(len(active)), at])
        active, at = active[more], at[more]
        if not len(active):
            break
        done[active, at] = True
        new = graph[ids[active, at]]
        known = (new[:, :, None] == ids[active][:, None, :]).any(axis=2)
        new_far = 1 - np.einsum("qrd,qd->qr", data[new], queries[active])
        new_far[(new < 0) | known] = np.inf
        every = np.concatenate([far[active], new_far], axis=1)
        order = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        order = np.take_along_axis(order, np.take_along_axis(every, order, 1).argsort(axis=1, kind="stable"), 1)
        far[active] = np.take_along_axis(every, order, 1)
        all_ids = np.concatenate([ids[active], new], axis=1)
        all_done = np.concatenate([done[active], np.zeros(new.shape, bool)], axis=1)
        ids[active] = np.where(np.isfinite(far[active]), np.take_along_axis(all_ids, order, 1), -1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return ids, far


def prune(data: np.ndarray, node: np.ndarray, ids: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of each node's proposed neighbours (-1: none) at most ``degree`` in different directions."""
    far = 1 - np.einsum("qcd,qd->qc", data[ids], data[node])
    far[(ids < 0) | (ids == node[:, None])] = np.inf
    order = far.argsort(axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    repeated = np.zeros(ids.shape, bool)
    by_id = ids.argsort(axis=1, kind="stable")
    sorted_ids = np.take_along_axis(ids, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
    far[repeated] = np.inf
    chosen = np.full((len(node), degree), -1, np.int64)
    rows = np.arange(len(node))
    vectors = data[ids]
    for k in range(degree):
        at = far.argmin(axis=1)
        good = np.isfinite(far[rows, at])
        if not good.any():
            break
        chosen[good, k] = ids[rows, at][good]
        between = 1 - np.einsum("qcd,qd->qc", vectors, vectors[rows, at])
        far[good[:, None] & (alpha * between <= far)] = np.inf
        far[rows, at] = np.inf
    return chosen


def build_graph(data: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours of each node, -1 where there are fewer; node 0 is the entry."""
    n = len(data)
    graph = np.full((n, degree), -1, np.int64)
    start = 1
    while start < n:
        end = min(n, start + max(8, min(512, start // 2)))
        batch = np.arange(start, end)
        found, _ = beam_search(data, graph, 0, data[batch], beam)
        # Nodes of one batch cannot find each other in the graph; the nearest of them are proposed too.
        near = data[batch] @ data[batch].T
        np.fill_diagonal(near, -np.inf)
        k = min(8, len(batch) - 1)
        peers = batch[np.argpartition(-near, k - 1, axis=1)[:, :k]] if k > 0 else np.zeros((len(batch), 0), np.int64)
        graph[batch] = prune(data, batch, np.concatenate([found, peers], axis=1), degree, alpha)
        source = np.repeat(batch, degree)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = target.argsort(kind="stable")
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        width = int(counts.max(initial=0))
        back = np.full((len(nodes), width), -1, np.int64)
        back[np.repeat(np.arange(len(nodes)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
        for part in range(0, len(nodes), 256):
            some = nodes[part : part + 256]
            graph[some] = prune(data, some, np.concatenate([graph[some], back[part : part + 256]], axis=1), degree, alpha)
        start = end
    return graph


def build_index(vectors: DataFrame, key: str, vector: str, keep: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard``, ``at``, ``node``, ``ids``, ``_vector`` and ``edges`` of every vector."""
    nodes = stored(distinct_vectors(usable(vectors, key, vector), keep))
    sizes = nodes.groupBy(F.size("_vector").alias("dim")).count().collect()  # a row for each vector length
    shards = {r["dim"]: -(-r["count"] // shard_rows) for r in sizes}
    if not shards:
        shards = {0: 1}
    number = F.element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), F.size("_vector"))
    shard = F.concat_ws("-", F.size("_vector"), F.pmod(F.xxhash64("node"), number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_batches(batches, ["shard"]):
            data = unit(np.array(rows.column("_vector").to_pylist(), float))
            graph = build_graph(data)
            rows = rows.append_column("at", pa.array(np.arange(len(data), dtype=np.int32)))
            rows = rows.append_column("edges", pa.array(graph.astype(np.int32).tolist(), pa.list_(pa.int32())))
            yield from rows.select(["shard", "at", "node", "ids", "_vector", "edges"]).to_batches()

    dealt = nodes.withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard", F.xxhash64("node"), "node")
    return dealt.mapInArrow(
        run, "shard string, at int, node bigint, ids array<bigint>, _vector array<double>, edges array<int>"
    )


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, query_block: int = QUERY_BLOCK) -> DataFrame:
    """For queries ``_id`` and ``_vector``: ``query_id``, ``rank``, ``vec_id``, ``score``, ``k`` rows at most each.

    ``index`` is a stored table that kept ``k + 1`` ids or more per vector.
    """
    shards = stored(index.select("shard", F.size("_vector").alias("dim")).distinct())
    queries = stored(queries)
    blocks = max(1, -(-queries.count() // query_block))
    block = F.pmod(F.xxhash64("_id", F.lit("block")), F.lit(blocks)).cast("int")
    # Shards are few (rows / shard_rows), so their list is small; each has all blocks of queries of its length.
    asked = queries.select("_id", "_vector", F.size("_vector").alias("dim"), block.alias("block")).join(shards, "dim")
    asked = asked.select(
        "shard",
        "block",
        F.lit(-1).alias("at"),
        F.col("_id").alias("node"),
        F.array().cast("array<bigint>").alias("ids"),
        "_vector",
        F.array().cast("array<int>").alias("edges"),
    )
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    given = index.select("shard", every_block, "at", "node", "ids", "_vector", "edges")
    both = given.unionByName(asked).repartition("shard", "block").sortWithinPartitions("shard", "block", "at", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_batches(batches, ["shard", "block"]):
            at = rows.column("at").to_numpy()
            m = int((at < 0).sum())
            if m in (0, len(at)):
                continue
            values = np.array(rows.column("_vector").to_pylist(), float)
            node = rows.column("node").to_numpy()
            original, asking = values[m:], values[:m]
            data = unit(original)
            graph = np.array(rows.column("edges").slice(m).to_pylist(), np.int64)
            members = rows.column("ids").slice(m).to_pylist()
            out: list[tuple] = []
            for part in range(0, m, 256):
                wanted = asking[part : part + 256]
                found, _ = beam_search(data, graph, 0, unit(wanted), max(beam, k + 1))
                for i, ids in enumerate(found):
                    own = int(node[part + i])
                    ids = ids[ids >= 0]
                    scores = cosine(original[ids], wanted[i])
                    hits = [(-s, v) for s, j in zip(scores.tolist(), ids.tolist()) for v in members[j] if v != own]
                    out += [(own, v, -s) for s, v in sorted(hits)[:k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["query_id", "vec_id", "score"],
            )

    found = both.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.dropDuplicates(["query_id", "vec_id"])
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def cosine(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision; equal rows get equal values.

    Powers of two bring the largest components near 1, which changes no digit
    and keeps squares from overflowing.
    """
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))[1])
    query = np.ldexp(query, -np.frexp(np.abs(query).max())[1])
    dot = (rows * query).sum(axis=1)
    return dot / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest others of each row whose id is divisible by ``every``."""
    index = stored(build_index(vectors, key, vector, k + 1, shard_rows))
    queries = usable(vectors, key, vector).where(F.col("_id") % every == 0).dropDuplicates(["_id"])
    return search(index, queries, k)
