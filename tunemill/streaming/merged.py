"""Aggregates of a stream, as tables that each micro-batch adds to.

A batch is summed up by itself and written to a folder named by its number.
Sums, minima and maxima of the batches merge to those of all rows, whatever
the order in which rows arrive, so the stream keeps no state, waits for no
watermark and drops no late row.  A batch that is run again after a failure
writes its folder again, with the same rows: every row counts once.

``<out>/batch=<n>`` holds what batch ``n`` adds.  :func:`compact` merges all
batches up to one into ``<out>/base=<n>``; readers take the newest base and
the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tunemill.operators import logs, scoring, voting
from tunemill.sources.publish import Folders, publish


@dataclass(frozen=True)
class Merging:
    """``partial`` sums up rows, ``merge`` sums up such sums; both give the same columns."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def votes(item: str, response: str, position: str) -> Merging:
    """Votes per item and answer, as :func:`tunemill.operators.voting.vote_counts`."""

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(item, response).agg(F.sum("votes").alias("votes"), F.min("first_pos").alias("first_pos"))

    return Merging(lambda rows: voting.vote_counts(rows, item, response, position), merge)


def versions(key: str, name: str, prefix: str = logs.VERSION_PREFIX) -> Merging:
    """The latest version per key; the latest of the latest ones is that of all."""
    latest = lambda rows: logs.latest_version(rows, key, name, prefix)
    return Merging(latest, latest)


def scores(*by: str) -> Merging:
    """Exact matches and items per group, as :func:`tunemill.operators.scoring.exact_match_score`."""

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*by).agg(F.sum("score").alias("score"), F.sum("n_items").alias("n_items"))

    return Merging(lambda rows: scoring.exact_match_score(rows, *by), merge)


def _numbers(folders: Folders, out: str, name: str) -> list[int]:
    return sorted(int(f.removeprefix(f"{name}=")) for f in folders.names(out) if f.startswith(f"{name}="))


def _newest_base(folders: Folders, out: str) -> int:
    return max(_numbers(folders, out, "base"), default=-1)


def add_batch(rows: DataFrame, number: int, merging: Merging, out: str) -> None:
    """Add a batch; one that is in already is written anew, or skipped if a base holds it."""
    out, spark = out.rstrip("/"), rows.sparkSession
    if number > _newest_base(Folders(spark), out):
        publish(spark, f"{out}/batch={number}", lambda folder: merging.partial(rows).write.parquet(folder))


def merged(spark: SparkSession, merging: Merging, out: str) -> DataFrame:
    """The aggregate of all rows that have arrived."""
    out, folders = out.rstrip("/"), Folders(spark)
    base = _newest_base(folders, out)
    paths = [f"{out}/batch={n}" for n in _numbers(folders, out, "batch") if n > base]
    if base >= 0:
        paths.append(f"{out}/base={base}")
    if not paths:
        raise ValueError(f"no batch has arrived in {out}")
    return merging.merge(spark.read.parquet(*paths))


def compact(spark: SparkSession, merging: Merging, out: str) -> None:
    """Merge all batches into one base; if it dies half-way, the next call goes on.

    The new base appears by a rename, when it is whole; from then on readers
    ignore what it was made of, which is deleted last.
    """
    out, folders = out.rstrip("/"), Folders(spark)
    numbers = _numbers(folders, out, "batch")
    if numbers and numbers[-1] > _newest_base(folders, out):
        publish(spark, f"{out}/base={numbers[-1]}", lambda folder: merged(spark, merging, out).write.parquet(folder))
    base = _newest_base(folders, out)
    for name, limit in (("batch", base + 1), ("base", base)):
        for number in _numbers(folders, out, name):
            if number < limit:
                folders.delete(f"{out}/{name}={number}")


def stream_merged(source: DataFrame, merging: Merging, out: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived to ``out``, batch by batch, and stop."""
    return (
        source.writeStream.foreachBatch(lambda rows, number: add_batch(rows, number, merging, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
