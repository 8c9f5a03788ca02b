"""Document fingerprints: a digest of bucket quartiles that near texts share for the most part.

The bytes of a text are read through a window of five; three triplets of each
window are hashed into 128 buckets.  The digest has, in hex, a length code, two
ratios of the buckets' quartiles, and for each bucket two bits: the quarter of
all buckets its count falls into.  The difference of two digests is bounded, so
their likeness is a number from 0 to 1.

An empty or NULL text has the digest of no triplets; so has one under three
bytes, but for its length code.  Equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 128
BOUND = 256
"""Differences count up to here; unrelated texts are some 200 apart."""
LENGTH_BOUND, RATIO_WEIGHT = 64, 2
BLOCK = 1 << 20
MIX = np.uint32(2654435761)
OUTER = np.array([0, 1, 2, 6])


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets fall into each bucket; ``BLOCK`` bytes are looked at together."""
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(1, len(data)), BLOCK):
        part = np.frombuffer(data[start : start + BLOCK + 4], np.uint8).astype(np.uint32)
        for salt, (second, third) in enumerate(((1, 2), (2, 3), (3, 4))):
            n = min(BLOCK, len(part) - third)
            if n > 0:
                key = part[:n] | part[second : second + n] << 8 | part[third : third + n] << 16
                key = (key + np.uint32(salt << 24)) * MIX >> np.uint32(25)
                total += np.bincount(key, minlength=BUCKETS)
    return total


def digest(text: str) -> str:
    data = text.encode("utf-8")
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]
    length = min(255, int(8 * np.log2(len(data) + 1)))
    ratios = (int(16 * q1 // (q3 + 1)) & 15) << 4 | (int(16 * q2 // (q3 + 1)) & 15)
    return bytes([length, ratios]).hex() + body.astype(np.uint8).tobytes().hex()


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 for a difference of ``BOUND`` or more."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8).astype(np.int64) for x in (one, other))
    score = min(LENGTH_BOUND, abs(a[0] - b[0]))
    score += RATIO_WEIGHT * (abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15)))
    for shift in (0, 2, 4, 6):
        score += OUTER[np.abs((a[2:] >> shift & 3) - (b[2:] >> shift & 3))].sum()
    return 1.0 - min(BOUND, int(score)) / BOUND


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint``, row by row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [digest(batch.column(1)[i].as_py() or "") for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=[key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to the first as many of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _numbers(values: list[int]) -> Column:
    """A list of numbers as one literal, however long."""
    text = F.lit(",".join(map(str, values)))
    return F.split(text, ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _range_number(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most the value: first among every ``step``-th cut, then among those between."""
    step = max(1, math.isqrt(len(cuts)))
    passed = step * F.size(F.filter(_numbers(cuts[step - 1 :: step]), lambda cut: cut <= value))
    return passed + F.size(F.filter(F.slice(_numbers(cuts), passed + 1, step), lambda cut: cut <= value))


def with_following(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likenesses.

    The following document is the next in descending ``doc_id`` (NULL last;
    equal ids by descending text), after the last the first; a lone document
    follows itself.  The texts move once, into ``ranges`` ranges of ids (four
    for each shuffle partition if not given).  A range also gets, as its last
    rows, the highest document of the range below it, so no range waits for
    another and no task sees more than its own.

    Gives ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    ids = docs.select(lowest.alias("_id"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted({int(c) for c in ids.approxQuantile("_id", shares, 0.2 / ranges)}) if shares else []
    number = _range_number(F.col("_id"), cuts)
    tops = ids.groupBy(number.alias("_range")).agg(F.max("_id").alias("top")).collect()  # one row a range
    tops = sorted((r["_range"], r["top"]) for r in tops)
    # By number of range: its highest id, and the next range above that has rows, which needs it.
    highest, above = [0] * ranges, [0] * ranges
    for i, (at, top) in enumerate(tops):
        highest[at], above[at] = top, tops[(i + 1) % len(tops)][0]
    goes = F.when(F.get(_numbers(highest), number) == F.col("_id"), F.get(_numbers(above), number).cast("int"))
    place = lambda where, last: F.struct(where.alias("_range"), F.lit(last).alias("_last"))
    placed = docs.select("doc_id", text_of(docs), lowest.alias("_id")).select(
        "doc_id",
        "_text",
        "_id",
        F.inline(
            F.when(goes.isNull(), F.array(place(number, False))).otherwise(
                F.array(place(number, False), place(goes, True))
            )
        ),
    )
    ordered = placed.repartition("_range").sortWithinPartitions(
        "_range", "_last", F.desc("_id"), F.desc("_text")
    )
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return ordered.select(F.col("doc_id").cast("bigint"), "_text", "_range", "_last").mapInArrow(_follow, schema)


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit("")).alias("_text")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    before: tuple | None = None  # id, text, digest, range of the row whose follower comes next
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            key, text, part, last = (batch.column(c)[i].as_py() for c in range(4))
            if last and (before is None or before[3] != part):
                continue  # a second border row of the same id
            own = digest(text)
            if before is not None and before[3] == part:
                changed = edited(before[1], text)
                new = digest(changed)
                sha = hashlib.sha256(changed.encode("utf-8")).hexdigest()
                rows.append((
                    before[0], len(before[1]), sha, before[2], new,
                    likeness(before[2], new), likeness(before[2], own),
                ))
            before = None if last else (key, text, own, part)
        if rows:
            yield out()
            rows = []
