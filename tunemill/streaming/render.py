"""The same rendering on a stream of files.

Filter, label names, templates and the hash split look at one row at a time,
so a stream needs no state and no watermark; each file is rendered once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tunemill.operators.sampling import split_hash
from tunemill.plans.recipe import SPLIT_SEED, TEST_SHARE, Recipe
from tunemill.plans.training import training_texts


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    return spark.readStream.format(file_format).schema(schema).load(path)


def stream_training_set(
    source: DataFrame, recipe: Recipe, key: Sequence[str], out: str, checkpoint: str
) -> StreamingQuery:
    """Render what has arrived, append it to ``out`` by split, and stop."""
    if recipe.every_kth != 1:
        raise ValueError("a stream has no row positions to sample by")
    texts = training_texts(source, recipe, key)
    divided = split_hash(texts, key, SPLIT_SEED, round(TEST_SHARE * 100))
    return (
        divided.writeStream.format("parquet")
        .partitionBy("split")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
