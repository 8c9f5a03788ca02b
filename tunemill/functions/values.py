"""Scalar helpers: values to text, label names, sizes, version numbers, hashes."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The units a size may be written in.
SIZE_UNITS = {"KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12}
SIZE_RE = r"^([0-9.]+)(KB|MB|GB|TB)$"


def literal_text(value: Any) -> str:
    """A Python value in the spelling that :func:`as_text` gives the same value."""
    return str(value)


def as_text(column: Column, data_type: T.DataType) -> Column:
    """A column of any type as it should read inside a text."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def label_text(column: Column, names: Mapping[Any, Any]) -> Column:
    """Names for values; a value without a name stays as it is.

    ``column`` must be text already (see :func:`as_text`).
    """
    if not names:
        return column
    pairs = [F.lit(literal_text(item)) for entry in names.items() for item in entry]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), column)


def size_bytes(text: Column) -> Column:
    """``2.5MB`` to 2500000.0; NULL for whatever has no number or no unit."""
    number = F.nullif(F.regexp_extract(text, SIZE_RE, 1), F.lit("")).try_cast("double")
    unit = F.regexp_extract(text, SIZE_RE, 2)
    factor = F.create_map(*[F.lit(x) for kv in SIZE_UNITS.items() for x in kv])
    return number * F.element_at(factor, unit)


def size_allowed(text: Column, limit_gb: float = 10.0, strict_units: bool = True) -> Column:
    """Is a data set small enough to load?

    ``strict_units`` keeps the historical rule, which looks at the unit first:
    every size in MB, and GB up to the limit, are in; KB, TB, and sizes that
    cannot be read are out.  Without it the size in bytes decides.
    """
    size = size_bytes(text)
    if not strict_units:
        return F.coalesce(size <= F.lit(limit_gb * 10**9), F.lit(False))
    unit = F.right(text, F.lit(2))
    number = F.left(text, F.length(text) - 2).try_cast("double")
    return F.coalesce((unit == "MB") | ((unit == "GB") & (number <= limit_gb)), F.lit(False))


def version_number(name: Column, prefix: str) -> Column:
    """The number behind the first dash of a name that starts with ``prefix``."""
    number = F.get(F.split(name, "-"), F.lit(1)).try_cast("bigint")
    return F.when(name.startswith(prefix), number)


def whole_div(name: str, by: int) -> Column:
    """Integer division of a column; ``/`` would go through floating point."""
    return F.expr(f"`{name}` div {by}")


def epoch_micros(column: Column, data_type: T.DataType) -> Column:
    """Microseconds since 1970.

    A timestamp without a time zone is counted as written; turning it into one
    with a zone first would make clock changes count as time.
    """
    if isinstance(data_type, T.TimestampNTZType):
        since = column - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(24,6)") * 1_000_000).cast("bigint")
    return F.unix_micros(column)


def shuffle_hash(seed: int, *key: Column) -> Column:
    """32 hex digits that put rows into a random order which the seed decides."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))


def hash_percent(digest: Column) -> Column:
    """0 to 99 from the first eight digits of :func:`shuffle_hash`."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
