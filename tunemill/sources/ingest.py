"""Read many sources where some are broken: good rows go on, bad ones are kept aside."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.sources.datasets import FAILURES, Library, reason, scan
from tunemill.sources.publish import Folders, publish, replace, restore, staging

BAD = "_corrupt_record"
WORKERS = 8
"""Sources that are read at a time."""


@dataclass
class Loaded:
    """What came of a bulk load; ``failed`` maps a data set to the reason."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    def rows(self) -> DataFrame:
        """All sources in one table; columns a source lacks are NULL in its rows."""
        tagged = [df.withColumn("dataset_id", F.lit(name)) for name, df in self.frames.items()]
        if not tagged:
            raise ValueError("no source could be read")
        return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)


def load_all(
    spark: SparkSession,
    library: Library,
    dataset_ids: Iterable[str],
    schemas: Mapping[str, T.StructType] | None = None,
    out: str | None = None,
    workers: int = WORKERS,
    seconds: float | None = None,
) -> Loaded:
    """Open every source; one that cannot be opened does not stop the others.

    With ``out`` each source is also read in full and stored by itself in
    ``<out>/<id>``, so that one that breaks off half-way is told from the others;
    what is returned then is read from there.  ``schemas`` are declared ones by
    id: nothing is read to guess them.  JSON lines with a schema keep their bad
    lines apart, in ``<out>/<id>.bad``, or marked in ``_corrupt_record`` if
    nothing is stored.

    ``workers`` sources are read side by side, each in a scheduler pool of its
    own.  One that fails is tried once more; one that takes more than
    ``seconds`` is ended and has failed.  Results are in the order of the ids.
    """
    names = list(dict.fromkeys(dataset_ids))

    def load(dataset_id: str) -> DataFrame:
        schema = (schemas or {}).get(dataset_id)
        if library.file_format == "json" and schema is not None:
            df = scan_json_lines(spark, library, dataset_id, schema)
        else:
            df = scan(spark, library, dataset_id, schema=schema)
        return _store(df, f"{out.rstrip('/')}/{dataset_id}") if out is not None else df

    attempt = inheritable_thread_target(spark)(lambda name: _attempted(spark, lambda: load(name), f"load-{name}", seconds))
    result = Loaded()
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        for name, made in zip(names, pool.map(attempt, names)):
            if isinstance(made, DataFrame):
                result.frames[name] = made
            else:
                result.failed[name] = made
    return result


def _attempted(spark: SparkSession, work: Callable[[], DataFrame], pool: str, seconds: float | None, tries: int = 2) -> DataFrame | str:
    """What ``work`` gives, or the reason why it failed every time; its jobs end when the time is over."""
    context, tag = spark.sparkContext, f"load-{uuid.uuid4().hex}"
    context.setLocalProperty("spark.scheduler.pool", pool)
    context.addJobTag(tag)
    late = threading.Event()

    def end() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, end) if seconds is not None else None
    if timer is not None:
        timer.start()
    try:
        for left in reversed(range(tries)):
            try:
                return work()
            except FAILURES as error:
                if late.is_set():
                    return f"took more than {seconds:g} seconds"
                if not left:
                    return reason(error)
        raise ValueError("no tries")
    finally:
        if timer is not None:
            timer.cancel()
        context.removeJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", None)


def _store(df: DataFrame, path: str) -> DataFrame:
    """Write a source and read it back; bad rows go to a folder of their own, from the same pass."""
    spark = df.sparkSession
    if BAD not in df.columns:
        publish(spark, path, lambda folder: df.write.parquet(folder))
        return spark.read.schema(df.schema).parquet(path)
    good = good_rows(df)
    targets = {"false": path, "true": f"{path}.bad"}
    for target in targets.values():
        restore(spark, target)
    with staging(spark, path.rpartition("/")[0]) as folder:
        df.withColumn("_bad", F.col(BAD).isNotNull()).write.partitionBy("_bad").parquet(folder)
        for bad, target in targets.items():
            part = f"{folder}/_bad={bad}"
            if not Folders(spark).exists(part):
                df.limit(0).write.parquet(part)
            replace(spark, part, target)
    return spark.read.schema(good.schema).parquet(path)


def parse_json(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON column into ``parsed``; a row that fails keeps its text in ``_corrupt_record``."""
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json(
        F.col(raw), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    )
    keep: list[Column] = [F.col(f"_json.{f.name}").alias(f.name) for f in schema.fields]
    return df.withColumn("_json", parsed).select(
        *df.columns, *keep, F.col(f"_json.{BAD}").alias(BAD)
    )


def scan_json_lines(
    spark: SparkSession, library: Library, dataset_id: str, schema: T.StructType
) -> DataFrame:
    """A data set of JSON lines, one row per line, with the bad lines marked."""
    return parse_json(spark.read.text(library.path(dataset_id)), "value", schema).drop("value")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD).isNull()).drop(BAD)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD).isNotNull())
