"""Running totals over an order, without ever sorting a whole table in one task.

``running_total`` cuts the order into buckets.  The caller names the bucket
columns from coarse to fine so that no bucket, and no list of sub-buckets of
one bucket, is large: the prefix of a hash, a vote count and a range of
positions, a day and an hour.  Rows are summed per bucket (combined on the map
side), the short lists of bucket totals are accumulated level by level, and
only the rows of one finest bucket are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OFFSET, BUCKET = "_offset", "_bucket_key"


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner join in which NULL meets NULL; the columns of ``left``, then the others of ``right``."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


def bucket_offsets(
    df: DataFrame,
    value: Column,
    levels: Sequence[str],
    group: Sequence[str] = (),
    descending: Sequence[str] = (),
) -> DataFrame:
    """One row per finest bucket with the total of everything before it."""
    keys = [*group, *levels]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    offsets = None
    for depth in range(1, len(levels) + 1):
        here = [*group, *levels[:depth]]
        last = levels[depth - 1]
        summed = totals if depth == len(levels) else totals.groupBy(*here).agg(F.sum("_total").alias("_total"))
        order = F.col(last).desc() if last in descending else F.col(last).asc()
        before = (
            Window.partitionBy(*here[:-1])
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        step = summed.select(
            *here, F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("bigint").alias("_step")
        )
        if offsets is None:
            offsets = step.withColumnRenamed("_step", OFFSET)
        else:
            offsets = _null_safe_join(step, offsets, here[:-1]).select(
                *here, (F.col(OFFSET) + F.col("_step")).alias(OFFSET)
            )
    return offsets


def running_total(
    df: DataFrame,
    value: Column,
    levels: Sequence[str],
    order: Sequence[Column],
    name: str,
    group: Sequence[str] = (),
    descending: Sequence[str] = (),
    small_offsets: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the row and all rows before it.

    ``order`` is the order inside a finest bucket.  ``small_offsets`` says that
    the number of buckets has a fixed bound, so that their totals can be sent
    to every task; otherwise they are joined on the bucket, by which the rows
    have to be partitioned anyway.  A NULL group or level is a group or bucket
    like others.  ``measured`` has the bucket columns and
    ``value`` of the same rows, if they can be had at less cost than ``df``.
    """
    keys = [*group, *levels]
    offsets = bucket_offsets(df if measured is None else measured, value, levels, group, descending)
    # A struct of the keys equals another where both have NULL, and window and join share its partitioning.
    bucket = F.struct(*keys).alias(BUCKET)
    inside = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.select("*", bucket).withColumn(name, F.sum(value).over(inside))
    placed = offsets.select(bucket, OFFSET)
    joined = summed.join(F.broadcast(placed) if small_offsets else placed, BUCKET)
    return joined.withColumn(name, F.col(name) + F.col(OFFSET)).drop(OFFSET, BUCKET)
