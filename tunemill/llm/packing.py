"""Best-fit packing of documents into bins, without two of one source or duplicate cluster in a bin.

Bins are ordered by what is left in them.  A piece goes to the tightest bin
that takes it: the search starts at the first bin with enough room and moves on
to its successors until one has none of the piece's conflicts; else a bin is
opened.  Each bin carries one bitmap per kind of conflict (source, cluster), so
a test is a single ``and``.

Documents are spread by a hash of their ids over groups of about
``group_rows`` pieces, whatever their source or cluster; a group is packed in
one task, largest pieces first, ties by id and piece.  Only ids and lengths
move.  A document longer than a bin is cut into pieces of a bin's length and a
rest, each with its place; pieces of one document never share a bin with its
copies, so a third of all rows in one source means more bins, not larger tasks.

A NULL or empty text has no tokens and takes no room: it goes into a bin as a
piece of length 0, in the duplicate cluster of none.  A NULL source or cluster
conflicts with nothing.  Clusters are those of equal texts unless the caller
names another column.  Repeated rows are packed each; an empty table gives no
pieces.  Very long texts are cut into pieces.  Other columns are not read and may have any names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import grouped_batches, text_or_empty

CAPACITY = 2_048
GROUP_ROWS = 4_096


def best_fit(sizes: list[int], conflicts: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """Bin number and offset of each item, in the order given.

    ``conflicts`` has a tuple of keys per item, one for each kind; items that
    agree in a key that is not None must not meet.
    """
    kinds = len(conflicts[0]) if conflicts else 0
    bits: list[dict] = [{} for _ in range(kinds)]
    masks = [
        tuple(
            0 if key is None else 1 << bits[k].setdefault(key, len(bits[k])) for k, key in enumerate(item)
        )
        for item in conflicts
    ]
    residuals: list[tuple[int, int]] = []  # what is left, number of the bin; sorted
    carried: list[list[int]] = []
    placed = []
    for size, mask in zip(sizes, masks):
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals) and any(c & m for c, m in zip(carried[residuals[at][1]], mask)):
            at += 1
        if at < len(residuals):
            left, number = residuals.pop(at)
        else:
            left, number = capacity, len(carried)
            carried.append([0] * kinds)
        placed.append((number, capacity - left))
        for k, m in enumerate(mask):
            carried[number][k] |= m
        insort(residuals, (left - size, number))
    return placed


def pack_documents(
    docs: DataFrame,
    n_tokens: Column,
    conflicts: list[Column],
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``first_token``, ``n_tokens``, ``bin_group``, ``bin``, ``bin_offset``.

    A bin is named by ``bin_group`` and ``bin``.  ``conflicts`` are columns of
    strings or numbers.
    """
    if capacity < 1:
        raise ValueError("capacity must be 1 or more")
    keys = [c.cast("string").alias(f"_c{i}") for i, c in enumerate(conflicts)]
    names = [f"_c{i}" for i in range(len(conflicts))]
    n = F.col("_n")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0)), F.lit(capacity).cast("bigint"))
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n_tokens.cast("bigint").alias("_n"), *keys)
    counted = whole.agg(F.sum(F.greatest(F.lit(1), F.ceil(n / capacity)))).first()[0] or 0
    groups = max(1, -(-int(counted) // group_rows))
    pieces = whole.select("doc_id", "_n", *names, F.posexplode(starts).alias("piece", "first_token")).select(
        F.pmod(F.xxhash64("doc_id", "piece", *names), F.lit(groups)).cast("int").alias("bin_group"),
        (F.least(n - F.col("first_token"), F.lit(capacity))).alias("n_tokens"),
        "doc_id",
        "piece",
        "first_token",
        *names,
    )
    ordered = pieces.repartition("bin_group").sortWithinPartitions(
        "bin_group", F.desc("n_tokens"), "doc_id", "piece", *names
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_batches(batches, ["bin_group"]):
            columns = [rows.column(c).to_pylist() for c in names]
            conflict = list(zip(*columns)) if columns else [()] * rows.num_rows
            placed = best_fit(rows.column("n_tokens").to_pylist(), conflict, capacity)
            out = rows.select(["doc_id", "piece", "first_token", "n_tokens", "bin_group"])
            out = out.append_column("bin", pa.array([p[0] for p in placed], pa.int32()))
            out = out.append_column("bin_offset", pa.array([p[1] for p in placed], pa.int64()))
            yield from out.to_batches()

    return ordered.mapInArrow(
        run, "doc_id bigint, piece int, first_token bigint, n_tokens bigint, bin_group int, bin int, bin_offset bigint"
    )


def word_count(text: str = "text") -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]++")).cast("bigint")


def copy_cluster(text: str = "text") -> Column:
    """The same for equal texts; NULL, which conflicts with nothing, for texts without a word."""
    whole = text_or_empty(text)
    return F.when(whole.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(F.md5(whole)))


def pack_by_source(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Documents by number of words, with conflicts by ``source`` and by equal text."""
    return pack_documents(docs, word_count(), [F.col("source"), copy_cluster()], capacity, group_rows)
