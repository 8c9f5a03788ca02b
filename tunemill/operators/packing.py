"""Cut texts to a length, or pack them into blocks of equal length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.values import shuffle_hash, whole_div
from tunemill.operators.ordering import running_total
from tunemill.operators.sampling import PREFIX

END_MARK = "<|endoftext|>"


def truncate(tokens: Column, limit: int) -> Column:
    """The first ``limit`` tokens of an array."""
    return F.slice(tokens, 1, limit)


def pack(
    df: DataFrame,
    key: Sequence[str],
    tokens: Column,
    block: int,
    seed: int = 42,
    end_mark: Column | None = None,
) -> DataFrame:
    """Join all samples, in seeded random order, and cut them every ``block`` tokens.

    Each sample is followed by an end mark.  The last block may be short.
    Gives ``block_no``, ``n_tokens``, ``n_samples`` and ``tokens``.

    The order is that of a hash of the key, so a hash prefix cuts it into
    65,536 buckets of like size whatever the keys are.  A sample gives each
    block it touches just its slice; a block gathers at most ``block`` pieces.
    """
    if block < 1:
        raise ValueError("block must be 1 or more")
    mark = F.lit(END_MARK) if end_mark is None else end_mark
    digest = shuffle_hash(seed, *[F.col(k) for k in key])
    hashed = df.select("*", digest.alias("_hash"), F.substring(digest, 1, PREFIX).alias("_prefix"))
    marked = F.concat(tokens, F.array(mark))
    length = F.col("_n")
    # Move the columns that the tokens come from, which are smaller than the
    # tokens; and sum the lengths where the rows are, before anything moves.
    moved = hashed.repartition("_prefix").select("_hash", "_prefix", marked.alias("_tokens"))
    placed = running_total(
        moved.withColumn("_n", F.size("_tokens").cast("bigint")),
        length,
        levels=["_prefix"],
        order=[F.col("_hash")],
        name="_end",
        small_offsets=True,
        measured=hashed.select("_prefix", F.size(marked).cast("bigint").alias("_n")),
    )
    placed = placed.withColumn("_start", F.col("_end") - length).withColumn(
        "_last", F.col("_end") - 1
    )
    start = F.col("_start")
    touched = F.sequence(whole_div("_start", block), whole_div("_last", block))

    def piece(number: Column) -> Column:
        low = F.greatest(number * block, start)
        high = F.least((number + 1) * block, F.col("_end"))
        return F.struct(
            number.alias("block_no"),
            low.alias("at"),
            F.slice(F.col("_tokens"), (low - start + 1).cast("int"), (high - low).cast("int")).alias("part"),
        )

    pieces = placed.select(F.inline(F.transform(touched, piece)))
    gathered = pieces.groupBy("block_no").agg(
        F.sum(F.size("part")).cast("bigint").alias("n_tokens"),
        F.count("*").alias("n_samples"),
        F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_parts"),
    )
    return gathered.select(
        "block_no", "n_tokens", "n_samples", F.flatten(F.col("_parts.part")).alias("tokens")
    )
