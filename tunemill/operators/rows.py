"""A user function over batches of rows, for what columns cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Bytes and rows that a function gets at once; what it makes of them is on its way before it gets more.
PIECE_BYTES, PIECE_ROWS = 4 * 2**20, 1_000

# What :func:`map_rows_apart` adds: why a row has failed, and the row.
ERROR, FAILED = "error", "failed"


def map_rows(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Apply ``fn`` to pieces of Arrow batches in parallel; the schema stays unless given.

    A piece has some megabytes at most, or one row; ``fn`` must not rely on how
    rows are grouped.
    """

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            size = max(1, int(part.memory_usage(deep=True).sum()))
            step = max(1, min(PIECE_ROWS, len(part) * PIECE_BYTES // size))
            for start in range(0, max(1, len(part)), step):
                yield fn(part.iloc[start : start + step].reset_index(drop=True))
            # Else it stays until the next one is there as well.
            del part
            pa.default_memory_pool().release_unused()

    return df.mapInPandas(batches, df.schema if schema is None else schema)


def map_rows_apart(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str | None = None,
    row_wise: bool = True,
) -> DataFrame:
    """As :func:`map_rows`, but a row on which ``fn`` fails is set apart and the job goes on.

    The result has the columns of ``schema`` and two more.  Rows that went well
    have NULL in both; a row that failed has NULL in all columns but those:
    ``error``, the type and first line of what was raised, or that a value does
    not fit the schema, and ``failed``, the row as it came.  A batch that fails
    is tried again in halves, so ``k`` bad rows among ``n`` cost some
    ``2 k log2 n`` calls more; ``fn`` may be called again with rows it has
    seen, and must not rely on how rows are grouped.  With ``row_wise`` a
    result of another length than the batch counts as a failure.
    """
    if schema is None:
        schema = df.schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    clash = {ERROR, FAILED} & set(schema.names)
    if clash:
        raise ValueError(f"the result has columns of its own named {sorted(clash)}")
    wide = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField(ERROR, T.StringType()), T.StructField(FAILED, df.schema)]
    )
    names = schema.names

    def good(batch: pa.RecordBatch, arrow: pa.Schema) -> pa.RecordBatch:
        made = fn(batch.to_pandas())
        if row_wise and len(made) != batch.num_rows:
            raise ValueError(f"{batch.num_rows} rows became {len(made)}")
        columns = [pa.Array.from_pandas(made[name], type=arrow.field(name).type) for name in names]
        empty = [pa.nulls(len(made), arrow.field(name).type) for name in (ERROR, FAILED)]
        return pa.RecordBatch.from_arrays([*columns, *empty], schema=arrow)

    def bad(batch: pa.RecordBatch, arrow: pa.Schema, error: Exception) -> pa.RecordBatch:
        said = (str(error).splitlines() or [""])[0]
        kind = arrow.field(FAILED).type
        columns = [column.cast(kind.field(i).type) for i, column in enumerate(batch.columns)]
        row = pa.StructArray.from_arrays(columns, fields=[kind.field(i) for i in range(kind.num_fields)])
        nothing = [pa.nulls(1, arrow.field(name).type) for name in names]
        return pa.RecordBatch.from_arrays([*nothing, pa.array([f"{type(error).__name__}: {said}"]), row], schema=arrow)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(wide)
        for part in parts:
            step = max(1, min(PIECE_ROWS, part.num_rows * PIECE_BYTES // max(1, part.nbytes)))
            waiting = [part.slice(start, step) for start in range(0, part.num_rows, step)][::-1]
            del part
            while waiting:
                batch = waiting.pop()
                if not batch.num_rows:
                    continue
                try:
                    made = good(batch, arrow)
                except Exception as error:  # whatever the function raises belongs to its row
                    if batch.num_rows == 1:
                        made = bad(batch, arrow, error)
                    else:
                        half = batch.num_rows // 2
                        waiting += [batch.slice(half), batch.slice(0, half)]
                        continue
                yield made
                del batch, made
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(batches, wide)
