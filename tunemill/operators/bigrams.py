"""Perplexity of texts under several experts, each word given the one before it.

Every expert is an interpolated bigram model with absolute discounting.  With
``c`` the occurrences of a pair, ``n`` those of its first word, ``f`` the number
of words seen after that one and ``b`` the number of words seen before the
second, all of one expert::

    P(w | v) = max(c - D, 0) / n + D * f / n * P(w)      P(w) = (b + 1) / (B + V)

``B`` counts the expert's different pairs, ``V`` the words of all experts.  A
first word the expert has never seen leaves ``P(w)`` alone; the word before a
text's first one is the empty text, which no word is.

The logarithm is a sum of terms that exist for what an expert has seen only::

    log P(w | v) = log(b + 1) - log(B + V)     by the word
                 + log(D * f / n)              by the word before
                 + log(1 + (c - D) / (D * f * P(w)))   by the pair

so one table of terms, looked up once, scores texts with any words in them.
The terms of frequent words are sent to every task; those of other words are
added to the terms of their pairs, so a text sends a rare pair and no words.

Beyond the scan a word is 80 bits of hashes, a ``word`` of 64 and a ``mark`` of
16: of 100 million words two are alike with a chance of some 4 in 10^9.  So
counts, sorts and shuffles move a few numbers a row, as long as any others.  A
pair's ``pair`` of 64 bits mixes both words, its ``marks`` of 32 have 16 of each;
joins and sorts compare the first number and look at the other where it is equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunemill.operators.routing import HEAD_BYTES

DISCOUNT = 0.75

# What a term belongs to.
WORD, BEFORE, PAIR, BASE = range(4)
PAIR_KEY = ["pair", "token", "marks"]
# The key of a term, of a word or a pair, and of a word.
KEY = ["code", "mark"]
TERM = ["kind", *KEY]


def token_pairs(df: DataFrame, tokens: Column, *keep: str | Column, silent: bool = False) -> DataFrame:
    """A row for each word, as ``token``, with the word before it as ``prev``.

    With ``silent`` a text without words has a row with a NULL ``token``.
    """
    cut = df.select(*keep, F.coalesce(tokens, F.array().cast("array<string>")).alias("_tokens") if silent else tokens.alias("_tokens"))
    names = cut.columns[:-1]
    zipped = F.arrays_zip(F.concat(F.array(F.lit("")), "_tokens").alias("prev"), F.col("_tokens").alias("token"))
    both = cut.select(*names, F.explode(zipped).alias("_pair"))
    # The last word stands before nothing.
    last = F.col("token").isNotNull()
    return both.select(*names, "_pair.prev", "_pair.token").filter(last | (F.col("prev") == "") if silent else last)


def hashed_pairs(pairs: DataFrame, *keep: str) -> DataFrame:
    """The pairs as numbers, NULL where ``token`` is.

    ``token`` has 64 bits of the second word, ``pair`` those of the first one
    mixed with them, ``marks`` 16 more bits of each.
    """
    mark = lambda c: F.hash(c).bitwiseAND(F.lit(0xFFFF))
    marks = F.shiftleft(mark("prev"), 16).bitwiseOR(mark("token"))
    numbers = pairs.select(*keep, F.xxhash64("prev").alias("_prev"), F.xxhash64("token").alias("_token"), marks.alias("_marks"), F.col("token").isNotNull().alias("_word"))
    key = F.col("_prev").bitwiseXOR(F.xxhash64("_token")), F.col("_token"), F.col("_marks")
    return numbers.select(*keep, *[F.when(F.col("_word"), n).alias(c) for n, c in zip(key, PAIR_KEY)])


def _word_of(side: str) -> list[Column]:
    """The key of a pair's first (``prev``) or second word (``token``)."""
    if side == "token":
        return [F.col("token").alias("code"), F.col("marks").bitwiseAND(F.lit(0xFFFF)).alias("mark")]
    return [F.col("pair").bitwiseXOR(F.xxhash64("token")).alias("code"), F.shiftrightunsigned("marks", 16).alias("mark")]


def within_bytes(table: DataFrame, weight: Column, row_bytes: Column, head_bytes: int) -> Column:
    """Whether a row is among the heaviest ones that fit into so many bytes together.

    Rows are summed up by the power of two of their weight, so at most 64 rows
    say where the limit is; whole classes of weight are in or out.
    """
    power = F.floor(F.log2(F.greatest(weight, F.lit(1)).cast("double"))).cast("int")
    classes = table.groupBy(power.alias("_power")).agg(F.sum(row_bytes.cast("double")).alias("_bytes"))
    heavier = Window.orderBy(F.col("_power").desc())
    fitting = classes.withColumn("_all", F.sum("_bytes").over(heavier)).filter(F.col("_all") <= head_bytes)
    return power >= fitting.agg(F.coalesce(F.min("_power"), F.lit(64))).scalar()


def _with(rows: DataFrame, key: Sequence[Column], table: DataFrame, values: Sequence[str], how: str) -> DataFrame:
    """``rows`` with the ``values`` of the term of their ``key``; the join is planned on the key's first number alone."""
    code, mark = key
    named = table.select(*[F.col(c).alias(f"_{c}") for c in KEY], *values)
    joined = rows.join(named, (code == F.col("_code")) & (mark.bitwiseXOR(F.col("_mark")) == 0), how)
    return joined.select(*rows.columns, *values)


def _look_up(pairs: DataFrame, table: DataFrame, side: str, values: Sequence[str], heavy: Column) -> DataFrame:
    """``pairs`` with the ``values`` of their words; heavy words from memory, so no task gets all pairs of one.

    Every word of ``pairs`` is in ``table``.
    """
    word = _word_of(side)
    first = _with(pairs, word, F.broadcast(table.filter(heavy)), values, "left")
    found = F.col(values[0]).isNotNull()
    rest = first.filter(~found).select(*pairs.columns)
    return first.filter(found).unionByName(_with(rest, word, table.filter(~heavy), values, "inner"))


def _each(experts: Sequence[str], prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(len(experts))]


def fit_bigrams(
    df: DataFrame,
    expert: Column,
    tokens: Column,
    experts: Sequence[str],
    folder: str,
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """The terms of all experts, kept below ``folder``: ``kind, code, mark, weight, sent`` and the ``logs``.

    ``log0``, ``log1``, ... are the experts' numbers, in their order; ``weight`` is how often
    the experts' texts use the term; each kind has a folder of its own.  ``sent`` marks the terms of words that
    fit into half of ``head_bytes``; those of other words are part of the
    terms of their pairs, and only pairs the experts have not seen use them
    alone.  The texts are read once; all counts are
    combined before they are shuffled, and the counts of pairs are written
    before the three tables that need them are made.  Pairs with a word that
    does not fit into ``head_bytes`` are written once more, to be joined.
    """
    spark = df.sparkSession
    counts, seen, after, before, logs = (_each(experts, prefix) for prefix in ("c", "n", "f", "b", "log"))
    wanted = hashed_pairs(token_pairs(df.filter(expert.isin(*experts)), tokens, expert.alias("_expert")), "_expert")
    wanted.groupBy(*PAIR_KEY).agg(
        *[F.count_if(F.col("_expert") == name).alias(c) for name, c in zip(experts, counts)]
    ).write.parquet(f"{folder}/counts")
    pairs = spark.read.parquet(f"{folder}/counts")

    total = lambda columns: reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    pairs.groupBy(*_word_of("prev")).agg(
        F.count("*").alias("_rows"),
        *[F.sum(c).alias(n) for c, n in zip(counts, seen)],
        *[F.count_if(F.col(c) > 0).alias(f) for c, f in zip(counts, after)],
    ).withColumn("weight", total(seen)).write.parquet(f"{folder}/firsts")
    pairs.groupBy(*_word_of("token")).agg(
        F.count("*").alias("_rows"),
        F.sum(total(counts)).alias("weight"),
        *[F.count_if(F.col(c) > 0).alias(b) for c, b in zip(counts, before)],
    ).write.parquet(f"{folder}/seconds")
    # Words whose own terms are sent to every task; a quarter of the memory for each kind.
    of_word = F.lit(64 + 16 * len(experts) + 16)
    firsts, seconds = (
        table.withColumn("sent", within_bytes(table, F.col("weight"), of_word, head_bytes // 4))
        for name in ("firsts", "seconds")
        for table in [spark.read.parquet(f"{folder}/{name}")]
    )

    bases = seconds.agg(F.count("*").alias("_words"), *[F.coalesce(F.sum(b), F.lit(0)).alias(b) for b in before])
    of_base = F.array(*[(F.col(b) + F.col("_words")).cast("double") for b in before])
    sizes = bases.select(of_base).scalar()

    def put(table: DataFrame, kind: int, key: list[Column], weight: Column, sent: Column, by_expert: list[Column]) -> None:
        named = [c.cast(t).alias(n) for c, t, n in zip(key, ("bigint", "int"), KEY)]
        numbers = [c.alias(n) for c, n in zip(by_expert, logs)]
        made = table.select(*named, weight.alias("weight"), sent.alias("sent"), *numbers)
        made.write.parquet(f"{folder}/terms/kind={kind}")

    by_word = [F.log(F.col(b) + 1.0) for b in before]
    by_first = [
        F.when(F.col(n) > 0, F.log(DISCOUNT * F.col(f) / F.col(n))).otherwise(0.0) for n, f in zip(seen, after)
    ]
    # A pair that an expert has not seen adds nothing but the terms of words that are not sent.
    alone = _each(experts, "l")
    by_pair = [
        F.when(
            F.col(c) > 0,
            F.log1p((F.col(c) - DISCOUNT) * F.get("_sizes", F.lit(i)) / (DISCOUNT * F.col(f) * (F.col(b) + 1.0))),
        ).otherwise(0.0)
        + F.col(first)
        + F.when(F.col("_sent"), 0.0).otherwise(word)
        for i, (c, f, b, first, word) in enumerate(zip(counts, after, before, alone, by_word))
    ]
    lone = firsts.select("*", *[F.when(F.col("sent"), 0.0).otherwise(log).alias(c) for log, c in zip(by_first, alone)])
    last = seconds.withColumnRenamed("sent", "_sent")
    of_first, of_second = [*after, *alone], [*before, "_sent"]
    heavy_first, heavy_second = (
        within_bytes(table, F.col("_rows"), F.lit(64 + 16 * len(values)), head_bytes)
        for table, values in ((lone, of_first), (last, of_second))
    )
    near = _with(pairs, _word_of("prev"), F.broadcast(lone.filter(heavy_first)), of_first, "left")
    near = _with(near, _word_of("token"), F.broadcast(last.filter(heavy_second)), of_second, "left")
    both = F.col(after[0]).isNotNull() & F.col(before[0]).isNotNull()
    near.filter(~both).select(*pairs.columns).write.parquet(f"{folder}/rest")
    rest = _look_up(spark.read.parquet(f"{folder}/rest"), lone, "prev", of_first, heavy_first)
    rest = _look_up(rest, last, "token", of_second, heavy_second)
    whole = near.filter(both).unionByName(rest).withColumn("_sizes", sizes)
    none, no = F.lit(0), F.lit(False)
    word, pair = [F.col(c) for c in KEY], [F.col("pair"), F.col("marks")]
    put(seconds, WORD, word, F.col("weight"), F.col("sent"), by_word)
    put(firsts, BEFORE, word, F.col("weight"), F.col("sent"), by_first)
    put(whole, PAIR, pair, total(counts), no, by_pair)
    of_bases = [F.log((F.col(b) + F.col("_words")).cast("double")) for b in before]
    put(bases, BASE, [none] * 2, none.cast("bigint"), no, of_bases)
    return spark.read.parquet(f"{folder}/terms")


def bigram_perplexity(
    df: DataFrame,
    key: str,
    tokens: Column,
    terms: DataFrame,
    experts: Sequence[str],
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """The key and ``scores``, an array of ``expert, expert_pos, ppl`` per text (``ppl`` NULL without words).

    The terms of the words that the model sends, and those of the heaviest
    pairs, as many as fit into half of ``head_bytes``, are sent to every task,
    where a text's words collapse into one partial sum before any shuffle.
    Pairs left are shuffled once, with the key of their text, to be joined; they
    are rare in the texts the model was fitted on, and of other texts adaptive
    execution splits what is not.  Texts are read once for the sums and once for
    these pairs, so no row is shuffled to be summed up before it is joined.  A
    pair that no expert has looks up its words; a term that no expert has adds
    nothing, and models of no words give NULL.  Texts of one key are one text,
    but each of them without words has a row of its own.
    """
    size = len(experts)
    logs = _each(experts, "log")

    def of(kind: int, prefix: str, rows: Column) -> DataFrame:
        numbers = [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(logs)]
        return terms.filter((F.col("kind") == kind) & rows).select(*KEY, *numbers)

    in_model = terms.filter(F.col("kind") == PAIR)
    heavy = within_bytes(in_model, F.col("weight"), F.lit(64 + 16 * size + 16), head_bytes // 2)
    head, tail = of(PAIR, "_pair", heavy), of(PAIR, "_rare", ~heavy)
    sent_words, sent_firsts = of(WORD, "_word", F.col("sent")), of(BEFORE, "_first", F.col("sent"))
    words_alone = terms.filter(F.col("kind").isin(WORD, BEFORE) & ~F.col("sent")).select(*TERM, *logs)

    def log(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(TERM, ("int", "bigint", "int"))]
    sums = _each(experts, "_s")
    pair = [F.col("pair"), F.col("marks")]
    near = hashed_pairs(token_pairs(df, tokens, key, silent=True), key)
    near = _with(near, _word_of("token"), F.broadcast(sent_words), _each(experts, "_word"), "left")
    near = _with(near, _word_of("prev"), F.broadcast(sent_firsts), _each(experts, "_first"), "left")
    is_word = F.col("token").isNotNull()
    near = _with(near, pair, F.broadcast(head), _each(experts, "_pair"), "left").select(
        key, *nothing, is_word.cast("int").alias("_words"), (~is_word).cast("int").alias("_silent"),
        *[(log(f"_word{i}") + log(f"_first{i}") + log(f"_pair{i}")).alias(s) for i, s in enumerate(sums)],
    )
    far = _with(hashed_pairs(token_pairs(df, tokens, key), key), pair, F.broadcast(head), [], "left_anti")
    far = _with(far, pair, tail, _each(experts, "_rare"), "left")
    seen = F.array(F.struct(*nothing))
    unseen = F.array(
        *[F.struct(F.lit(kind).alias("kind"), *_word_of(side)) for kind, side in ((WORD, "token"), (BEFORE, "prev"))]
    )
    far = far.select(
        key, F.inline(F.when(F.col("_rare0").isNotNull(), seen).otherwise(unseen)), F.lit(0).alias("_words"), F.lit(0).alias("_silent"),
        *[log(f"_rare{i}").alias(s) for i, s in enumerate(sums)],
    )
    added = ["_n", "_none", *sums]
    summed = near.unionByName(far).groupBy(key, *TERM).agg(
        F.count("*").alias("_rows"), F.count("kind").alias("_open"),
        F.sum("_words").alias("_n"), F.sum("_silent").alias("_none"), *[F.sum(s).alias(s) for s in sums],
    )
    # Both branches read the same shuffle: conditions on a count stay above it, both use all of its
    # columns (there is no group without rows), and an outer join asks for no keys below it.
    known = summed.filter((F.col("_open") == 0) & (F.col("_rows") > 0)).select(key, *added)
    unknown = summed.filter(F.col("_open") > 0).join(words_alone, TERM, "left")
    unknown = unknown.select(key, "_n", "_none", *[(F.col(s) + F.col("_rows") * log(c)).alias(s) for s, c in zip(sums, logs)])
    totals = known.unionByName(unknown).groupBy(key).agg(*[F.sum(c).alias(c) for c in added])

    base = terms.filter(F.col("kind") == BASE).select(F.array(*logs)).scalar()

    def scores(*ppl: Column) -> Column:
        named = zip(experts, range(size), ppl)
        return F.array(*[F.struct(F.lit(n).alias("expert"), F.lit(i).alias("expert_pos"), p.alias("ppl")) for n, i, p in named])

    of_words = scores(*[F.exp(F.get("_base", F.lit(i)) - F.col(s) / F.nullif(F.col("_n"), F.lit(0))) for i, s in enumerate(sums)])
    of_none = scores(*[F.lit(None).cast("double")] * size)
    each = F.concat(F.array_repeat(of_words, F.when(F.col("_n") > 0, 1).otherwise(0)), F.array_repeat(of_none, F.col("_none").cast("int")))
    return totals.withColumn("_base", base).select(key, F.explode(each).alias("scores"))
