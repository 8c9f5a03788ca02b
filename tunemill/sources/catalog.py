"""Descriptors of data sets: what there is, how large it is, which columns it has."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions.values import size_allowed, size_bytes

# The type names that descriptors use.
FIELD_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "dict": T.MapType(T.StringType(), T.StringType()),
    "list": T.ArrayType(T.StructType().add("role", "string").add("content", "string")),
    "sequence": T.ArrayType(T.StringType()),
    "Label": T.IntegerType(),
}

FIELD = "struct<id: string, type: string, description: string, optional: boolean>"
CATALOG_SCHEMA = (
    "path string, type string, id string, url string, converted_size string, license string, "
    f"lang string, langs array<string>, description string, structure array<{FIELD}>"
)


def read_descriptor(path: str | Path) -> dict[str, Any]:
    """A descriptor file with every value as text, so ``no`` is a language."""
    import yaml

    with open(path, encoding="utf8") as file:
        return {**yaml.load(file, Loader=yaml.BaseLoader), "path": str(path)}


def fields(descriptor: Mapping[str, Any]) -> list[dict[str, Any]]:
    """The declared columns, whether listed flat or below the name of a config."""
    structure = descriptor.get("structure") or []
    lists = structure.values() if isinstance(structure, Mapping) else [structure]
    return [dict(entry) for listed in lists for entry in listed]


def declared_schema(descriptor: Mapping[str, Any]) -> T.StructType:
    """The schema to read the data set with; ``optional`` is kept in a column's metadata.

    Files promise nothing, so every column may be NULL whatever is declared.
    """
    declared = {field["id"]: field for field in fields(descriptor)}

    def column(field: Mapping[str, Any]) -> T.StructField:
        optional = str(field.get("optional", "")).lower() == "true"
        metadata = {"optional": True} if optional else {}
        return T.StructField(field["id"], FIELD_TYPES[field["type"]], metadata=metadata)

    return T.StructType([column(field) for field in declared.values()])


def catalog(spark: SparkSession, descriptors: Iterable[Mapping[str, Any]]) -> DataFrame:
    """One row per descriptor.  Ids are not unique; ``path`` is the key."""
    names = [f.name for f in T._parse_datatype_string(CATALOG_SCHEMA).fields]
    rows = []
    for descriptor in descriptors:
        structure = [
            (f.get("id"), f.get("type"), f.get("description"), str(f.get("optional", "")).lower() == "true")
            for f in fields(descriptor)
        ]
        rows.append(tuple((descriptor | {"structure": structure}).get(name) for name in names))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def with_load_decision(df: DataFrame, limit_gb: float = 10.0, strict_units: bool = True) -> DataFrame:
    """Add the size in bytes, and whether the data set is to be loaded."""
    size = F.col("converted_size")
    return df.withColumn("size_bytes", size_bytes(size)).withColumn(
        "load", size_allowed(size, limit_gb, strict_units)
    )


def groups_within(df: DataFrame, group: str, size: str, limit: float) -> DataFrame:
    """Groups whose sizes add up to no more than ``limit``."""
    return df.groupBy(group).agg(F.sum(size).alias("total")).filter(F.col("total") <= limit)
