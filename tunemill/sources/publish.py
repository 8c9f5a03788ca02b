"""Replace folders of a data set without a time at which it is neither the old nor the new one.

A job writes below ``_staging``, which readers skip.  Only when it has ended
well are its folders moved to their places: the old folder is set aside in
``_replaced``, the new one renamed, the old one deleted.  If a process dies
between the two renames, :func:`restore` brings the old folder back; every
publication into the same place begins with it.  Until then the old data stays readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession

STAGING, REPLACED = "_staging", "_replaced"


class Folders:
    """The few operations on a file system that Spark can reach."""

    def __init__(self, spark: SparkSession) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, folder: str) -> tuple[Any, Any]:
        path = self.path(folder)
        return path.getFileSystem(self.conf), path

    def exists(self, folder: str) -> bool:
        system, path = self._at(folder)
        return system.exists(path)

    def names(self, folder: str) -> list[str]:
        """Of the folders in a folder; none if it is a file or does not exist."""
        system, path = self._at(folder)
        if not system.exists(path) or not system.getFileStatus(path).isDirectory():
            return []
        return [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()]

    def delete(self, folder: str) -> None:
        system, path = self._at(folder)
        system.delete(path, True)

    def rename(self, source: str, target: str) -> None:
        system, path = self._at(target)
        system.mkdirs(path.getParent())
        if not system.rename(self.path(source), path):
            raise OSError(f"{source} could not be moved to {target}")


def _aside(target: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/{REPLACED}/{name}"


def restore(spark: SparkSession, target: str) -> None:
    """Bring back what a publication that died between its two renames has set aside."""
    folders = Folders(spark)
    if folders.exists(_aside(target)):
        if folders.exists(target):
            folders.delete(_aside(target))
        else:
            folders.rename(_aside(target), target)


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder ``staged`` in the place of ``target``; without it, an empty result, ``target`` goes."""
    folders = Folders(spark)
    restore(spark, target)
    if folders.exists(target):
        folders.rename(target, _aside(target))
    if folders.exists(staged):
        try:
            folders.rename(staged, target)
        except Exception:
            restore(spark, target)
            raise
    folders.delete(_aside(target))
    # The folder of what is set aside goes with the last one in it.
    parent = _aside(target).rpartition("/")[0]
    if not folders.names(parent):
        folders.delete(parent)


@contextmanager
def staging(spark: SparkSession, parent: str) -> Iterator[str]:
    """A folder below ``parent`` that readers skip; it goes in the end, whether the job went well or not."""
    folders, top = Folders(spark), f"{parent.rstrip('/')}/{STAGING}"
    folder = f"{top}/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        folders.delete(folder)
        if folders.exists(top) and not folders.names(top):
            folders.delete(top)


def publish(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Replace the folder ``target`` by what ``write`` writes to the folder it is given."""
    target = target.rstrip("/")
    restore(spark, target)
    with staging(spark, target.rpartition("/")[0]) as folder:
        write(folder)
        replace(spark, folder, target)


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(value)}"


def publish_partitions(
    spark: SparkSession, target: str, column: str, values: Sequence[str], write: Callable[[str], None]
) -> None:
    """Replace the folders ``column=value`` below ``target``, of all ``values``; others stay.

    ``write`` writes folders of these names; a value without one has no rows
    any more.  Each folder changes by itself, after the whole job has ended.
    """
    names = [partition_folder(spark, column, value) for value in values]
    target = target.rstrip("/")
    for name in names:
        restore(spark, f"{target}/{name}")
    with staging(spark, target) as folder:
        write(folder)
        for name in names:
            replace(spark, f"{folder}/{name}", f"{target}/{name}")
