"""Exact-match scores of model outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.extract import assistant_part_or_rest


def is_match(actual: Column, expected: Column) -> Column:
    """1 when both texts are the same to the last character, else 0."""
    return actual.eqNullSafe(expected).cast("int")


def scored(outputs: DataFrame, output: str = "output", expected: str = "expected") -> DataFrame:
    """Add the answer found in an output and whether it is the expected one."""
    answer = assistant_part_or_rest(F.col(output))
    return outputs.withColumn("answer", answer).withColumn(
        "match", is_match(F.col("answer"), F.col(expected))
    )


def exact_match_score(outputs: DataFrame, *by: str) -> DataFrame:
    """Number of matches and of items per model, or whatever ``by`` names."""
    return (
        scored(outputs)
        .groupBy(*by)
        .agg(F.sum("match").alias("score"), F.count("*").alias("n_items"))
    )


def compare_variants(outputs: DataFrame, *by: str) -> DataFrame:
    """Base and tuned score side by side; ``variant`` is ``base`` or ``tuned``."""

    def total(variant: str) -> Column:
        return F.sum(F.when(F.col("variant") == variant, F.col("match")).otherwise(0))

    return (
        scored(outputs)
        .groupBy(*by)
        .agg(
            total("base").alias("base_score"),
            total("tuned").alias("tuned_score"),
            (total("tuned") - total("base")).alias("gain"),
        )
    )
