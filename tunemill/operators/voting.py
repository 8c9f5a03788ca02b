"""Which answer do most models give?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.functions.values import whole_div
from tunemill.operators.ordering import running_total

# Positions that share a bucket when answers are ranked.
RANK_RANGE = 1_000_000


def vote_counts(responses: DataFrame, item: str, response: str, position: str) -> DataFrame:
    """Votes per item and answer, and where the answer was seen first."""
    return responses.groupBy(item, response).agg(
        F.count("*").alias("votes"), F.min(position).alias("first_pos")
    )


def vote_consensus(responses: DataFrame, item: str, response: str, position: str) -> DataFrame:
    """The answer with most votes per item, the first seen on ties."""
    best = F.struct(-F.col("votes"), F.col("first_pos"))
    return (
        vote_counts(responses, item, response, position)
        .groupBy(item)
        .agg(
            F.min_by(response, best).alias(response),
            F.max("votes").alias("votes"),
            F.sum("votes").alias("n_votes"),
        )
    )


def vote_ranking(
    responses: DataFrame, item: str, response: str, position: str, rank_range: int = RANK_RANGE
) -> DataFrame:
    """All answers of an item, numbered from 1 by votes, then by first appearance.

    ``position`` is an integer that no two rows share.  NULL is an item like
    others, and NULL positions come first, in the order of the answers.  An
    item with a great many different answers is ranked in ranges of positions.
    """
    counted = vote_counts(responses, item, response, position).withColumn(
        "_range", whole_div("first_pos", rank_range)
    )
    return running_total(
        counted,
        F.lit(1).cast("bigint"),
        levels=["votes", "_range"],
        order=[F.col("first_pos"), F.col(response)],
        name="rank",
        group=[item],
        descending=["votes"],
    ).select(item, response, "votes", "rank")
