"""Tables of versions and of timed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunemill.functions.values import epoch_micros, version_number, whole_div

VERSION_PREFIX = "checkpoint-"


def latest_version(names: DataFrame, key: str, name: str, prefix: str = VERSION_PREFIX) -> DataFrame:
    """The name with the largest number per key, ``''`` when no name has one.

    Of names with equal numbers it is the last in alphabetical order.
    """
    number = version_number(F.col(name), prefix)
    best = F.max(F.when(number.isNotNull(), F.struct(number.alias("number"), F.col(name).alias("name"))))
    return names.groupBy(key).agg(
        F.coalesce(best["name"], F.lit("")).alias(name),
        F.coalesce(F.max(number), F.lit(-1).cast("bigint")).alias("version"),
    )


def with_elapsed(log: DataFrame, start: str, end: str, name: str = "elapsed_us") -> DataFrame:
    """Add the microseconds between two columns of a row."""

    def micros(column: str) -> Column:
        return epoch_micros(F.col(column), log.schema[column].dataType)

    return log.withColumn(name, micros(end) - micros(start))


def time_to_next(
    log: DataFrame, by: str, time: str, tie: str, name: str = "elapsed_us", bucket_seconds: float = 60
) -> DataFrame:
    """Add the microseconds until the next row of the same ``by``, NULL for the last.

    Rows are compared within a stretch of time; the last row of a stretch
    takes its successor from a table with the first row of each stretch.  So
    one busy key is spread over as many tasks as there are stretches; they may
    be shorter than a second.  NULL is a key like others.  A row without a time
    has no successor and is none.
    """
    width = round(bucket_seconds * 1_000_000)
    if width < 1:
        raise ValueError("a stretch lasts a microsecond or more")
    stamped = log.withColumn("_us", epoch_micros(F.col(time), log.schema[time].dataType)).withColumn(
        "_bucket", whole_div("_us", width)
    )
    # A struct of the key equals another where both hold NULL.
    stamped = stamped.withColumn("_key", F.struct(by))
    firsts = stamped.groupBy("_key", "_bucket").agg(F.min("_us").alias("_first"))
    following = firsts.filter(F.col("_bucket").isNotNull()).select(
        "_key", "_bucket", F.lead("_first").over(Window.partitionBy("_key").orderBy("_bucket")).alias("_later")
    )
    inside = Window.partitionBy("_key", "_bucket").orderBy("_us", tie)
    stepped = stamped.withColumn("_next", F.lead("_us").over(inside))
    joined = stepped.join(following, ["_key", "_bucket"], "left")
    return joined.select(*log.columns, (F.coalesce("_next", "_later") - F.col("_us")).alias(name))
