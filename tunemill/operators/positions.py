"""Positions of rows in a file scan, and a stored index of how many rows each file has.

Files count in path order.  Parquet readers number the rows of a file
themselves.  Other formats are read in blocks of a file; a block's rows are counted in
one pass over the scan, and their numbers follow from the running id that Spark gives
the rows of a task, less the block's first one.  The data is never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunemill.functions.values import whole_div

# Up to this many files, the table of file offsets (a path and a number each,
# some 50 MB in all) is sent to every task; beyond, it is joined in blocks of rows.
BROADCAST_FILES = 200_000
BLOCK_ROWS = 1_000_000
# Up to this many files of a slice are opened by name; a longer slice scans the data set.
NAMED_FILES = 10_000


def reader_numbers_rows(df: DataFrame) -> bool:
    """Whether the reader of a plain scan gives each row's number in its file."""
    return "row_index" in df.select("_metadata").schema["_metadata"].dataType.names


def _plain_path(path: Column) -> Column:
    """Without the file system, which a listing and a scan write in two ways."""
    return F.regexp_replace(path, r"^[A-Za-z0-9+.-]+:/+", "/")


def _scanned_key(path: Column) -> Column:
    """The path a scan gives, which is escaped, as a listing has it."""
    return _plain_path(F.url_decode(F.regexp_replace(path, r"\+", "%2B")))


def _offsets(counted: DataFrame, *order: str) -> DataFrame:
    """``_start``: the rows before each file or block; the driver holds the same list to plan the scan."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("bigint")))


def with_row_index(
    df: DataFrame, name: str = "idx", broadcast_files: int = BROADCAST_FILES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Number the rows of a file scan from 0, files in path order.

    ``df`` must be a plain scan, of which partition folders may be chosen.
    For Parquet what precedes a file is counted without reading a column.
    """
    if reader_numbers_rows(df):
        return _by_reader(df, name, broadcast_files, block_rows)
    return _by_block(df, name, broadcast_files)


def _by_reader(df: DataFrame, name: str, broadcast_files: int, block_rows: int) -> DataFrame:
    located = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.row_index").alias("_at"),
    )
    files = df.select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at")
    )
    counted = files.groupBy("_path").agg((F.max("_at") + 1).alias("_rows"))
    starts = _offsets(counted.withColumn("_key", _scanned_key(F.col("_path"))), "_key")
    if len(df.inputFiles()) <= broadcast_files:
        joined = located.join(F.broadcast(starts.select("_path", "_start")), "_path")
    else:
        blocks = starts.select(
            "_path",
            "_start",
            F.explode(F.expr(f"sequence(0L, (_rows - 1) div {block_rows})")).alias("_block"),
        )
        blocked = located.withColumn("_block", whole_div("_at", block_rows))
        joined = blocked.join(blocks, ["_path", "_block"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def _parsed_rows(df: DataFrame) -> Column:
    """The number of rows, with all values read: the reader then parses, and skips, the same lines as the scan itself."""
    return F.count_if(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns])) >= 0)


def _by_block(df: DataFrame, name: str, broadcast_files: int) -> DataFrame:
    """As the text formats are read: the same scan twice, so its blocks and their tasks are the same.

    A row that does not fit what was counted for its block stops the job: the
    files have changed meanwhile.
    """
    located = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    counted = located.groupBy("_path", "_block").agg(_parsed_rows(df).alias("_rows"), F.min("_at").alias("_first"))
    starts = _offsets(counted.withColumn("_key", _scanned_key(F.col("_path"))), "_key", "_block")
    keys = ["_path", "_block"]
    joined = located.join(F.broadcast(starts) if len(df.inputFiles()) <= broadcast_files else starts, keys, "left")
    at = F.col("_at") - F.col("_first")
    fits = F.coalesce((at >= 0) & (at < F.col("_rows")), F.lit(False))
    changed = F.raise_error(F.concat(F.lit("the file has changed while it was read: "), F.col("_path"))).cast("bigint")
    return joined.select(*df.columns, F.when(fits, F.col("_start") + at).otherwise(changed).alias(name))


# --- a stored index -------------------------------------------------------


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``length``, ``modified`` and the partition columns of the files of a data set; none is opened."""
    files = spark.read.format("binaryFile").load(root).drop("content")
    return files.withColumnRenamed("modificationTime", "modified").withColumn("_key", _plain_path(F.col("path")))


def file_index(files: DataFrame, stored: str, opened: Callable[[Sequence[str] | None], DataFrame]) -> DataFrame:
    """``files`` with ``rows``, from the table in the folder ``stored``.

    Files that the table does not know in this length and of this time are
    counted (of Parquet, the footers alone) and added to it; rows of files that
    are gone or have changed stay unused.  ``opened`` scans the files it is
    given, or all.
    """
    spark = files.sparkSession
    schema = "_key string, length bigint, modified timestamp, rows bigint"
    keys = ["_key", "length", "modified"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(stored)
    known = spark.createDataFrame([], schema)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.schema(schema).parquet(stored)
    new = files.join(known, keys, "left_anti").select("path", *keys)
    paths = [row.path for row in new.select("path").limit(NAMED_FILES + 1).collect()]
    if paths:
        df = opened(paths if len(paths) <= NAMED_FILES else None)
        by_reader = reader_numbers_rows(df)
        rows = F.max(F.col("_metadata.row_index")) + 1 if by_reader else _parsed_rows(df)
        counted = df.groupBy(_scanned_key(F.col("_metadata.file_path")).alias("_key")).agg(rows.alias("rows"))
        made = new.join(counted, "_key", "left").select(*keys, F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))
        made.coalesce(1).write.mode("append").parquet(stored)
        known = spark.read.schema(schema).parquet(stored)
    return files.join(known.dropDuplicates(keys), keys)


def files_of_slice(index: DataFrame, start: int, stop: int | None) -> tuple[list[str], int] | None:
    """The paths that hold rows ``start`` to ``stop`` and the position of their first row; None if they are too many to name."""
    placed = _offsets(index.select("path", "_key", F.col("rows").alias("_rows")), "_key")
    inside = (F.col("_rows") > 0) & (F.col("_start") + F.col("_rows") > start)
    if stop is not None:
        inside &= F.col("_start") < stop
    found = placed.where(inside).select("path", "_start").limit(NAMED_FILES + 1).collect()
    if len(found) > NAMED_FILES:
        return None
    return [row.path for row in found], min((row["_start"] for row in found), default=0)
