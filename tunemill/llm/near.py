"""MinHash near-dedup by bottom-k sketches, each from the same one hash function.

A document's set holds the hashes of its distinct shingles of ``words`` words
(64 bits; the words in lower case, A-Z only).  Equal sets are joined first and
stand for one member.  A member's sketch is its ``SKETCH`` smallest hashes.
Inverted lists of the retained values bring members together: in each list,
members join the group of the list's smallest member.  Within a group the union
of two sketches estimates the similarity, and pairs far below the threshold
fall away; the rest are verified by exact Jaccard on the full sets.

Which lists count: two sets at similarity 0.8 share about 25 of 32 retained
values and at least ``SHARED`` but for one pair in 40 million.  So it is
enough to look at each sketch's rarest values, all but ``SHARED - 1`` of them;
any such pair meets in one of these lists, while a passage that many documents
hold is among the common values that are left out.

Groups are cut into blocks of about ``BLOCK`` members (fewer if their sets are
large: ``BLOCK_VALUES`` values in all), and each pair of blocks is a task, so no task holds more than two blocks.  A task gives back a
spanning forest of the links it has found, one row a member, and the pairs
themselves never become rows.  A group of n members compares n * n / 2 pairs
by matrix products inside tasks: all links count, so nothing is skipped.

NULL ids: the row keeps NULL as its component and is kept.  NULL or empty
texts: an empty set, linked with nothing.  Repeated ids: a row each, linked by
their texts; the component is the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import grouped_batches, keep_rows, stored
from tunemill.llm.components import components

WORDS, SIMILARITY = 5, 0.8
SKETCH, SHARED = 32, 12
LEAST_ESTIMATE = 0.4
"""Estimates at a true 0.8 are below this but for one pair in ten million."""
BLOCK, BLOCK_VALUES = 1_024, 4_000_000
FEW, SHORT = 12, 64
"""Groups of so few short sets, of which there are very many, are compared without arrays."""
CELLS = 1 << 21
"""Numbers in a block of shared values (8 MB), by which a crowd's members are compared."""
MAX_KNOWN = 80_000
"""Words that a worker remembers the hashes of; 400,000 took 40 to 60 MB more in each worker and were no faster."""
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15 * (2 * i + 1) * (2 * i + 1) & 0xFFFFFFFFFFFFFFFF | 1 for i in range(64)], dtype=np.uint64
)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(33)


class Hasher:
    """Hashes words, which it remembers, and shingles from their words' hashes."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > MAX_KNOWN:
            self.known = {}
        try:
            return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words).difference(self.known):
                self.known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def shingles(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """The hash of each run of ``n`` words; fewer words make one run."""
        n = min(n, len(hashes))
        if not n:
            return hashes
        size = len(hashes) - n + 1
        total = np.full(size, n, np.uint64)
        for i in range(n):
            total += hashes[i : i + size] * MULTIPLIERS[i]
        return mixed(total)

    def of_text(self, text: str | None, n: int) -> np.ndarray:
        """The sorted set of a text's shingle hashes."""
        return np.unique(self.shingles(self.word_hashes(words_of(text)), n))


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: of bytes, ``lower`` changes A-Z and ``split`` cuts at ASCII white space, no more."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def signed(values: np.ndarray) -> np.ndarray:
    """As Spark's numbers, in the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_hash`` (NULL for an empty set) and ``sketch``; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            n, key, sketch = [], [], []
            for i in range(batch.num_rows):
                values = hasher.of_text(batch.column(1)[i].as_py(), words)
                n.append(len(values))
                key.append(xxhash.xxh128_hexdigest(values.tobytes()) if len(values) else None)
                sketch.append(signed(values[:SKETCH]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.string()), pa.array(sketch, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_hash string, sketch array<bigint>"
    )


def full_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``node`` and ``values``, the whole sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            made = [signed(hasher.of_text(batch.column(1)[i].as_py(), words)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], names=["node", "values"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "node bigint, values array<bigint>"
    )


def list_groups(members: DataFrame, shared: int = SHARED, size: int = SKETCH) -> DataFrame:
    """Distinct ``group`` and ``node`` from the inverted lists of each sketch's rarest values.

    ``members`` has ``node`` and ``sketch``.  Sizes and smallest members of the
    lists are aggregated before the shuffle; the values come back to their
    member by an equality join, which adaptive execution splits if a list is hot.
    """
    values = members.select("node", F.size("sketch").alias("n"), F.explode("sketch").alias("value"))
    lists = values.groupBy("value").agg(F.count("*").alias("df"), F.min("node").alias("group")).where(F.col("df") > 1)
    common = values.join(lists, "value").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value", "group"))).alias("lists")  # at most SKETCH
    )
    # Values that no other member has are the rarest of all; they take up part of the prefix.
    needed = F.greatest(F.lit(1), F.floor(F.col("n") * shared / size)).cast("int")
    prefix = F.greatest(F.lit(0), F.size("lists") - needed + 1)
    groups = F.array_distinct(F.transform(F.slice("lists", 1, prefix), lambda x: x["group"]))
    return common.select("node", F.explode(groups).alias("group")).select("group", "node")


def tasks(memberships: DataFrame) -> DataFrame:
    """``memberships`` (``group``, ``node``, ``size``) with the pair of blocks ``i``, ``j`` of each task they belong to."""
    sizes = memberships.groupBy("group").agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    blocks = F.ceil(F.greatest(F.col("_n") / BLOCK, F.col("_size") / BLOCK_VALUES)).cast("int")
    own = F.pmod(F.xxhash64("node", "group"), blocks).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    return memberships.join(sizes.where(F.col("_n") > 1), "group").select("group", "node", own.alias("own"), F.inline(pair))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets."""
    n = len(sets)
    if n <= FEW and max(map(len, sets), default=0) <= SHORT:
        plain = [set(s.tolist()) for s in sets]
        return np.array([[len(a & b) for b in plain] for a in plain], np.float32).reshape(n, n)
    values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    counted = np.zeros((n, n), np.float32)
    kept = counts[column] > 1
    owner, column = owner[kept], column[kept]
    _, column = np.unique(column, return_inverse=True)
    order = column.argsort(kind="stable")
    owner, column = owner[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    step = max(256, min(4_096, CELLS // n)) if n else 4_096
    for start in range(0, width, step):  # a block of shared values at a time
        low, high = np.searchsorted(column, [start, start + step])
        used, place = np.unique(owner[low:high], return_inverse=True)
        block = np.zeros((len(used), min(step, width - start)), np.float32)
        block[place, column[low:high] - start] = 1
        if len(used) == n:
            counted += block @ block.T
        else:
            counted[np.ix_(used, used)] += block @ block.T
    return counted


def by_rows(n: int, rule) -> np.ndarray:
    """The pairs of ``n`` members for which ``rule`` of a slice of rows holds, some pairs at a time."""
    made, step = np.zeros((n, n), bool), max(1, CELLS // 8 // max(1, n))
    for start in range(0, n, step):
        rows = slice(start, start + step)
        made[rows] = rule(rows)
    return made


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs have 100 * intersection >= percent * union."""
    sizes = np.array([len(s) for s in sets], np.float64)
    both = overlaps(sets)

    def rule(rows: slice) -> np.ndarray:
        shared = both[rows].astype(np.float64)
        return 100 * shared >= percent * (sizes[rows, None] + sizes[None, :] - shared)

    return by_rows(len(sets), rule)


def estimated(parts: list[np.ndarray], least: float = LEAST_ESTIMATE) -> np.ndarray:
    """Which pairs' sketches estimate a similarity of ``least`` or more.

    Of the smallest values of the union of two sketches, as many as the
    shorter complete one allows, the share that both hold.
    """
    n = len(parts)
    if n <= 64:
        made = np.zeros((n, n), bool)
        for a in range(n):
            for b in range(a + 1, n):
                union = np.union1d(parts[a], parts[b])[:SKETCH]
                shared = np.isin(union, parts[a], assume_unique=True) & np.isin(union, parts[b], assume_unique=True)
                made[a, b] = made[b, a] = shared.sum() >= least * len(union)
        return made
    # In a crowd: shared values against the larger sketch, never less than the share above.
    sizes = np.array([len(p) for p in parts])
    both = overlaps(parts)
    return by_rows(n, lambda rows: both[rows] >= least * np.minimum(SKETCH, np.maximum(sizes[rows, None], sizes[None, :])))


def forest(linked: np.ndarray) -> np.ndarray:
    """The smallest index each index is linked with, by any path."""
    n = len(linked)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        edge = np.zeros(n, bool)
        edge[start] = True
        while edge.any():
            edge = linked[edge].any(axis=0) & (root < 0)
            root[edge] = start
    return root


def _by_task(rows: DataFrame, column: str, work, schema: str) -> DataFrame:
    """Run ``work(nodes, own, sets, i, j)`` on each task's members, which come in order of node."""
    keys = ["group", "i", "j"]
    ordered = rows.select(*keys, "node", "own", column).repartition(*keys).sortWithinPartitions(*keys, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, i, j), part in grouped_batches(batches, keys):
            if part.num_rows < 2:
                continue
            lists = part.column(column).combine_chunks()
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            sets = [np.sort(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            made = work(group, part.column("node").to_numpy(), part.column("own").to_numpy(), sets, i, j)
            if made is not None:
                yield made

    return ordered.mapInArrow(run, schema)


def likely(members: DataFrame, memberships: DataFrame) -> DataFrame:
    """Those memberships (``group``, ``node``) with a partner whose sketch looks alike."""
    dealt = tasks(memberships.withColumn("size", F.lit(SKETCH))).join(members.select("node", "sketch"), "node")

    def work(group, nodes, own, sets, i, j):
        alike = estimated(sets)
        if i != j:
            alike &= own[:, None] != own[None, :]
        kept = nodes[alike.any(axis=1) if len(nodes) <= 64 else (alike & ~np.eye(len(nodes), dtype=bool)).any(axis=1)]
        if not len(kept):
            return None
        return pa.RecordBatch.from_arrays([pa.array([group] * len(kept), pa.int64()), pa.array(kept)], names=["group", "node"])

    return _by_task(dealt, "sketch", work, "group bigint, node bigint").distinct()


def links(memberships: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that join all members of a group whose exact similarity reaches ``percent``.

    ``sets`` has ``node`` and ``values``.
    """
    sized = memberships.join(sets.groupBy("node").agg(F.sum(F.size("values")).alias("size")), "node")
    dealt = tasks(sized).join(sets, "node")

    def work(group, nodes, own, values, i, j):
        root = forest(similar(values, percent))
        moved = root != np.arange(len(root))
        if not moved.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["a", "b"])

    return _by_task(dealt, "values", work, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    The lists are tuned for ``percent`` of 80 or more.
    """
    if percent < 80:
        raise ValueError("the sketch lists are made for similarities of 80 % and more")
    made = stored(sketches(docs, words))
    sets = made.where(F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull())
    members = stored(sets.groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.any_value("sketch").alias("sketch")))
    # Two different texts under one id are one node: both sketches and sets count as that node's.
    found = stored(list_groups(members))
    pairs = stored(likely(members, found))
    wanted = pairs.select(F.col("node").alias("doc_id")).distinct()
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    exact = stored(full_sets(keep_rows(known, stored(wanted), "doc_id"), words))
    joined = components(links(pairs, exact, percent))
    labels = members.select("set_hash", "node").join(joined, "node", "left")
    labels = labels.select("set_hash", F.coalesce("component", "node").alias("_component"))
    out = made.select("doc_id", "n_shingles", "set_hash").join(labels, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


ORACLE_SQL = r"""WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ), lambda w: w <> '') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM split
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
), classes AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN classes c USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""
"""Exact sets and links for words=4, all pairs that share a shingle; for tables small enough for that."""
