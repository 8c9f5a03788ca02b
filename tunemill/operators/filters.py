"""Row filters bound by column name."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, *names: str | None) -> None:
    """Fail before the plan runs when a recipe names a column that is not there."""
    missing = sorted({n for n in names if n is not None} - set(df.columns))
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}; there are {', '.join(df.columns)}")


def literal(df: DataFrame, name: str, value: Any) -> Column:
    """A value as the type of a column, NULL where that type cannot hold it."""
    require_columns(df, name)
    data_type = df.schema[name].dataType
    if isinstance(value, float) and isinstance(data_type, T.IntegralType) and value % 1:
        return F.lit(None).cast(data_type)
    return F.lit(value).try_cast(data_type)


def equals(df: DataFrame, name: str, value: Any) -> Column:
    """``column == value`` with the *literal* cast to the column's type.

    Casting the literal keeps the comparison pushable to the scan, and a text
    column that holds other words does not fail under ANSI rules.  A literal
    that does not exist in the column's type matches no row, and neither does
    NULL.
    """
    return F.col(name) == literal(df, name, value)


def filter_equals(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.filter(equals(df, name, value))
