"""Helpers the operators share: tables, intermediate results, streams of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
"""Rows of a few numbers each that may be sent to every executor (some 16 MB); above, a shuffle."""
BATCH_BYTES, BATCH_SETTING = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
"""Bytes of an Arrow batch on its way to a worker, or one row."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where nothing is shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tunemill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs in here send Arrow batches of ``BATCH_BYTES``, unless the session names a size of its own.

    Spark's own are of 10,000 rows or 64 MB.  The JVM and the workers keep most
    of what their largest batch took, so a long run of jobs adds up.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def _written(df: DataFrame, path: str) -> DataFrame:
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read it back: the lineage ends there.

    What is read later survives the loss of any executor and is computed once.
    """
    return _written(df, f"{work_folder(df.sparkSession)}/{uuid.uuid4().hex}")


class Shelf:
    """Stored tables of one operator, which it deletes when their last reader is done."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame) -> DataFrame:
        """As :func:`stored`."""
        path = f"{work_folder(self.spark)}/{uuid.uuid4().hex}"
        made = _written(df, path)
        self.paths[id(made)] = (made, path)
        return made

    def drop(self, *tables: DataFrame) -> None:
        """Delete these tables, or all."""
        for key in [id(t) for t in tables] if tables else list(self.paths):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(key)[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def keep_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among ``ids``, a stored table of distinct keys.

    Up to ``BROADCAST_ROWS`` counted keys go to every executor, so that wide
    rows are not moved; more are joined by shuffle, with the same result.
    """
    few = ids.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def grouped_batches(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows with equal keys from a stream that is sorted by them.

    Holds one group at a time and the batch it ends in.
    """
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        values = list(zip(*columns))
        start = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[start]:
                continue
            if current is not None and values[start] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = values[start]
            held.append(batch.slice(start, i - start))
            start = i
    if current is not None:
        yield current, pa.Table.from_batches(held)
