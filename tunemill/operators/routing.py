"""Perplexity of texts under several experts, and the choice of the best expert.

Log-probabilities come from outside (:func:`perplexity`), or from unigram
counts that are fitted here: one language model per value of a column, with
add-one smoothing over the vocabulary of all experts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Memory that the frequent words sent to every task may take.
HEAD_BYTES = 64 * 2**20


def perplexity(tokens: DataFrame, *by: str, logprob: str = "logprob") -> DataFrame:
    """``exp`` of the mean negative log-probability of the tokens per ``by``."""
    return tokens.groupBy(*by).agg(F.exp(-F.avg(logprob)).alias("ppl"))


def fit_unigrams(df: DataFrame, expert: Column, tokens: Column, experts: Sequence[str]) -> DataFrame:
    """One row per word: ``token`` and ``counts``, an array in expert order."""
    words = df.filter(expert.isin(*experts)).select(expert.alias("_expert"), F.explode(tokens).alias("token"))
    per_expert = [F.count_if(F.col("_expert") == e) for e in experts]
    named = [c.alias(f"_c{i}") for i, c in enumerate(per_expert)]
    return words.groupBy("token").agg(*named).select(
        "token", F.array(*[F.col(f"_c{i}") for i in range(len(experts))]).alias("counts")
    )


def _array_sum(column: str) -> Column:
    return F.aggregate(column, F.lit(0).cast("bigint"), lambda done, x: done + x)


def _log(expert: int) -> Column:
    return F.coalesce(F.get("_logs", F.lit(expert)), F.lit(0.0))


def unigram_perplexity(
    df: DataFrame,
    key: str,
    tokens: Column,
    model: DataFrame,
    experts: Sequence[str],
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """The key and ``scores``, an array of ``expert, expert_pos, ppl`` per text (``ppl`` NULL without words).

    With add-one smoothing, ``log p = log(count + 1) - log(total + vocabulary)``.
    A word an expert has never seen adds nothing to the first term, so only
    counts that exist are joined, never all words with all experts.

    A few words make up most of any text.  Words with at least one k-th of all
    occurrences are at most k, hence small enough to send to every task, where
    a text's words collapse into one partial sum before any shuffle.  The
    words left are too rare to make a join on them uneven.  Texts are read and
    cut into words once: both branches start from the same shuffled sums.
    """
    size = len(experts)
    # A word's share of the memory: its own length, its counts, and some for the table.
    longest = model.agg(F.coalesce(F.max(F.octet_length("token")), F.lit(0))).scalar()
    head_words = F.greatest(F.lit(1), F.lit(head_bytes) / (longest + F.lit(48 + 16 * size)))
    sized = model.select(
        "token",
        _array_sum("counts").alias("_all"),
        F.transform("counts", lambda c: F.log(c + F.lit(1.0))).alias("_logs"),
    )
    everything = model.select(_array_sum("counts").alias("_all")).agg(F.sum("_all")).scalar()
    frequent = F.col("_all").cast("double") * head_words >= everything
    head = sized.filter(frequent).select("token", "_logs")
    tail = sized.filter(~frequent).select("token", "_logs")

    # A text without words stays, with one NULL word that counts for nothing.
    words = df.select(F.col(key), F.explode_outer(tokens).alias("token"))
    looked_up = words.join(F.broadcast(head), "token", "left")
    rare = F.when(F.col("_logs").isNull(), F.col("token"))
    sums = [f"_s{i}" for i in range(size)]
    log_sums = [F.sum(_log(i)).alias(s) for i, s in enumerate(sums)]
    parts = looked_up.groupBy(key, rare.alias("_rare")).agg(
        F.count("token").alias("_n"), F.count("_logs").alias("_known"), *log_sums
    )
    # The conditions are on a count, so they stay above the shuffle; and both
    # branches use all columns of it, so it is the same shuffle for both.
    known = parts.filter(F.col("_known") > 0).select(key, "_n", *sums)
    unknown = (
        parts.filter(F.col("_known") == 0)
        .withColumnRenamed("_rare", "token")
        .join(tail, "token", "left")
        .select(
            key,
            "_n",
            *[(F.col(s) + F.col("_n") * _log(i)).alias(s) for i, s in enumerate(sums)],
        )
    )
    summed = known.unionByName(unknown).groupBy(key).agg(
        *[F.sum(name).alias(name) for name in ("_n", *sums)]
    )

    totals = model.agg(
        F.array(*[F.log((F.sum(F.get("counts", F.lit(i))) + F.count("*")).cast("double")) for i in range(size)])
    ).scalar()
    scored = summed.withColumn("_base", totals)
    rows = [
        F.struct(
            F.lit(name).alias("expert"),
            F.lit(i).alias("expert_pos"),
            F.exp(F.get("_base", F.lit(i)) - F.col(f"_s{i}") / F.nullif(F.col("_n"), F.lit(0))).alias("ppl"),
        )
        for i, name in enumerate(experts)
    ]
    return scored.select(key, F.array(*rows).alias("scores"))


def _weighted(score: Column, coefs: Mapping[str, float] | None) -> Column:
    """What experts are compared by; one without a coefficient has 1."""
    weight = F.lit(1.0)
    if coefs:
        table = F.create_map(*[F.lit(x) for name, c in coefs.items() for x in (name, float(c))])
        weight = F.coalesce(F.element_at(table, score["expert"]), F.lit(1.0))
    weighted = score["ppl"] * weight
    return F.when(
        weighted.isNotNull() & ~F.isnan(weighted),
        F.struct(
            weighted.alias("score"),
            score["expert_pos"].alias("expert_pos"),
            score["expert"].alias("expert"),
        ),
    )


def _choice() -> list[Column]:
    return [F.col("_best.expert").alias("expert"), F.col("_best.score").alias("score")]


def choose_scored(df: DataFrame, key: str, coefs: Mapping[str, float] | None = None) -> DataFrame:
    """The expert with the lowest ``ppl`` times its coefficient, the first on ties.

    Reads the ``scores`` of :func:`unigram_perplexity`; nothing is shuffled.
    An expert without a score (NULL or NaN) is never chosen; a text that none
    has scored keeps its row, with NULL.
    """
    best = F.array_min(F.transform("scores", lambda score: _weighted(score, coefs)))
    return df.select(key, best.alias("_best")).select(key, *_choice())


def choose_expert(
    scores: DataFrame, key: str, coefs: Mapping[str, float] | None = None
) -> DataFrame:
    """As :func:`choose_scored` for a table with a row per text and expert."""
    row = F.struct("expert", "expert_pos", "ppl")
    best = scores.groupBy(key).agg(F.min(_weighted(row, coefs)).alias("_best"))
    return best.select(key, *_choice())
