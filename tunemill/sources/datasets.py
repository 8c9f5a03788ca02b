"""Scan data sets by id, config and split, and write training sets."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.operators.positions import file_index, files_of_slice, listed_files
from tunemill.operators.sampling import rows_between
from tunemill.sources.publish import Folders, publish, publish_partitions

SLICE = re.compile(r"(?P<split>[^\[\]]+)(\[(?P<start>\d*):(?P<stop>\d*)\])?")


@dataclass(frozen=True)
class Library:
    """A folder of data sets: ``root/<id><suffix>``, in one file format.

    A data set with configs and splits has them as partition folders
    (``config=.../split=...``), so choosing one never opens the files of
    another.  ``index`` is a folder for tables of how many rows each file has;
    with them a slice opens only the files that its rows are in.
    """

    root: str
    file_format: str = "parquet"
    suffix: str = ""
    index: str | None = None

    def path(self, dataset_id: str) -> str:
        return f"{self.root.rstrip('/')}/{dataset_id}{self.suffix}"


def scan(
    spark: SparkSession,
    library: Library,
    dataset_id: str,
    config: str | None = None,
    split: str = "train",
    schema: T.StructType | None = None,
    line_csv: bool = False,
) -> DataFrame:
    """One data set as a lazy DataFrame.

    ``split`` can name a slice by row positions, as in ``train[:10]``, in any
    format (with :class:`Library`'s ``index``, from the files it needs alone).
    Without one the result is still a plain scan: file positions
    (``_metadata``) can be asked of it.

    Splits and configs are partition folders; a data column that happens to be
    called ``split`` or ``config`` chooses nothing.  CSV values may hold line
    breaks and doubled quotes; ``line_csv`` says that none has a line break, so
    that large files can be cut.
    """
    named = SLICE.fullmatch(split)
    if named is None:
        raise ValueError(f"not a split: {split}")
    split, start, stop = named["split"], named["start"], named["stop"]
    reader = spark.read.format(library.file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if library.file_format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", not line_csv)
    path = library.path(dataset_id)
    folders = partition_columns(spark, path)
    if config is not None and "config" not in folders:
        raise ValueError(f"{dataset_id} has no configs")

    def chosen(df: DataFrame) -> DataFrame:
        if config is not None:
            df = df.filter(F.col("config") == config)
        return df.filter(F.col("split") == split) if "split" in folders else df

    if not (start or stop):
        return chosen(reader.load(path))
    first, last = int(start or 0), int(stop) if stop else None
    if library.index is None:
        return rows_between(chosen(reader.load(path)), first, last)

    def opened(paths: Sequence[str] | None) -> DataFrame:
        # The folder of the whole set says which parts of a path are columns.
        named = reader.option("basePath", path) if folders else reader
        return named.load(list(paths)) if paths is not None else reader.load(path)

    index = file_index(chosen(listed_files(spark, path)), f"{library.index.rstrip('/')}/{dataset_id}", opened)
    found = files_of_slice(index, first, last)
    if found is None:
        return rows_between(chosen(reader.load(path)), first, last)
    paths, before = found
    if not paths:
        return reader.load(path).filter(F.lit(False))
    return rows_between(chosen(opened(paths)), max(0, first - before), None if last is None else max(0, last - before))


def partition_columns(spark: SparkSession, path: str) -> set[str]:
    """The columns that a scan takes from folder names: ``name=value``, level below level."""
    folders, names = Folders(spark), set()
    while True:
        below = [name for name in folders.names(path) if "=" in name and name[0] not in "._"]
        if not below:
            return names
        names.add(below[0].partition("=")[0])
        path = f"{path}/{below[0]}"


FAILURES = (PySparkException, Py4JError, ValueError, OSError)
"""What a source or a job can fail with, whether Spark names the reason or only the JVM does."""


def reason(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


def write_splits(df: DataFrame, path: str) -> None:
    """Write a training set, a folder for each split, in place of what is there; until it is whole, that stays."""
    publish(df.sparkSession, path, lambda folder: df.write.partitionBy("split").parquet(folder))


def write_parts(df: DataFrame, path: str, column: str, values: Sequence[str], even_files: bool = False) -> None:
    """As :func:`write_splits` for the parts ``values`` of ``column``, each with a folder of its own below ``path``.

    Without ``even_files`` each task writes a file for every part it has rows
    of, so there are up to tasks times parts files.  With it, rows move once:
    those of a part come together, in as many tasks as the part has times
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, however large it is,
    and small parts share a task.
    """
    if even_files:
        df = df.hint("rebalance", column, "split")
    publish_partitions(
        df.sparkSession, path, column, values, lambda folder: df.write.partitionBy(column, "split").parquet(folder)
    )
