"""Bulk load: read the descriptors, choose by size, open what was chosen."""

from __future__ import annotations

from glob import glob

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.sources.catalog import catalog, declared_schema, fields, read_descriptor, with_load_decision
from tunemill.sources.datasets import Library
from tunemill.sources.ingest import Loaded, load_all


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """All descriptors below a folder; a few hundred small files, read by the driver."""
    paths = sorted(glob(f"{folder}/**/*.yaml", recursive=True))
    return catalog(spark, map(read_descriptor, paths))


def load_catalog(
    spark: SparkSession,
    folder: str,
    library: Library,
    limit_gb: float = 10.0,
    strict_units: bool = True,
    out: str | None = None,
) -> Loaded:
    """Open every data set that is small enough; see :func:`load_all` for ``out`` and failures."""
    chosen = with_load_decision(read_catalog(spark, folder), limit_gb, strict_units).filter("load")
    # As many rows as there are descriptor files.
    ids = [row.id for row in chosen.select("id").distinct().orderBy(F.col("id")).collect()]
    return load_all(spark, library, ids, declared_schemas(folder), out)


def declared_schemas(folder: str) -> dict[str, T.StructType]:
    """The columns that the descriptors below a folder declare, by data set id."""
    made = {}
    for path in sorted(glob(f"{folder}/**/*.yaml", recursive=True)):
        descriptor = read_descriptor(path)
        if fields(descriptor):
            made[descriptor["id"]] = declared_schema(descriptor)
    return made
