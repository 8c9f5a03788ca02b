"""Row positions, systematic samples, and seeded splits with exact counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunemill.functions.values import hash_percent, shuffle_hash
from tunemill.operators.positions import with_row_index

# Up to this many groups, one cut per group is sent to every task.
BROADCAST_GROUPS = 100_000
# Hex digits of the hash that make a bucket: 65,536 buckets.  Those that follow order its rows.
PREFIX = 4
ORDERED = 15


def filter_indexed(df: DataFrame, predicate: Callable[[Column], Column]) -> DataFrame:
    """Keep the rows whose position satisfies ``predicate``."""
    return with_row_index(df, "_idx").filter(predicate(F.col("_idx"))).drop("_idx")


def rows_between(df: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    """The rows of a file scan at positions ``start`` up to but not including ``stop``."""

    def inside(idx: Column) -> Column:
        return (idx >= start) if stop is None else (idx >= start) & (idx < stop)

    return filter_indexed(df, inside)


def every_kth(df: DataFrame, k: int) -> DataFrame:
    """Rows 0, k, 2k, ... of a file scan; apply it before other filters."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    return df if k == 1 else filter_indexed(df, lambda idx: idx % k == 0)


def _needed(total: Column, share: float | None, rows: int | None) -> Column:
    if rows is not None:
        return F.least(F.lit(rows).cast("bigint"), total)
    if share is None or not 0 <= share <= 1:
        raise ValueError("give a share between 0 and 1 or a number of rows")
    return F.ceil(total.cast("double") * share).cast("bigint")


def hash_cuts(
    keys: DataFrame,
    share: float | None = None,
    rows: int | None = None,
    by: Sequence[str] = (),
    groups: int = 1,
    digits: int = PREFIX,
) -> DataFrame:
    """``_cut``, the largest beginning of a hash that still belongs to the sample, one row per ``by``.

    ``keys`` has the columns ``by`` and ``_hash``, of which the first
    ``digits + ORDERED`` hex digits count (76 bits).  One pass over the keys
    lists the hashes of each bucket; from this one exchange come both the
    counts that find the bucket of the cut and the hashes that are ranked in
    it.  ``digits`` more than 4 makes buckets of fewer rows for very large data.
    ``groups`` is the number of values of ``by``.
    """
    order = F.conv(F.substring("_hash", digits + 1, ORDERED), 16, 10).cast("bigint")
    prefix = F.substring("_hash", 1, digits).alias("_prefix")
    lists = keys.groupBy(*by, prefix).agg(F.collect_list(order).alias("_hashes"))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    counted = lists.select(*by, "_prefix", F.size("_hashes").alias("_n")).select(
        *by,
        "_prefix",
        "_n",
        F.sum("_n").over(upto).alias("_upto"),
        _needed(F.sum("_n").over(whole), share, rows).alias("_need"),
    )
    edge = counted.filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
    rest = edge.select(
        *[F.col(c).alias(f"_edge_{c}") for c in by],
        F.col("_prefix").alias("_edge"),
        (F.col("_need") - F.col("_upto") + F.col("_n")).cast("int").alias("_rest"),
    )
    # NULL-safe, so that no condition moves below the exchange on one side alone.
    same = [F.col("_prefix") == F.col("_edge"), *[F.col(c).eqNullSafe(F.col(f"_edge_{c}")) for c in by]]
    at_edge = lists.join(F.broadcast(rest) if groups <= BROADCAST_GROUPS else rest, same)
    last = F.conv(F.element_at(F.array_sort("_hashes"), F.col("_rest")).cast("string"), 10, 16)
    cut = F.concat("_prefix", F.lpad(F.lower(last), ORDERED, "0")).alias("_cut")
    return at_edge.select(*by, cut)


def _before_cut(digest: Column, cut: Column, digits: int = PREFIX) -> Column:
    return F.substring(digest, 1, digits + ORDERED) <= cut


def in_sample(
    df: DataFrame,
    key: Sequence[str],
    seed: int,
    share: float | None = None,
    rows: int | None = None,
    digits: int = PREFIX,
) -> Column:
    """True for exactly the share (rounded up) or number of rows asked for.

    ``key`` must be unique: rows with equal keys share a hash and are never
    separated.  The cut is a scalar subquery over the key columns, so the
    data itself is neither joined nor shuffled; it is read once for the cut
    and once for the result.  ``digits``: see :func:`hash_cuts`.
    """
    digest = shuffle_hash(seed, *[F.col(k) for k in key])
    cut = hash_cuts(df.select(digest.alias("_hash")), share, rows, digits=digits).scalar()
    return F.coalesce(_before_cut(digest, cut, digits), F.lit(False))


def split_exact(
    df: DataFrame, key: Sequence[str], seed: int = 42, test_share: float = 0.2, column: str = "split"
) -> DataFrame:
    """Mark ``ceil(test_share * n)`` rows as test and the others as train."""
    test = in_sample(df, key, seed, share=test_share)
    return df.withColumn(column, F.when(test, "test").otherwise("train"))


def split_exact_by(
    df: DataFrame,
    by: str,
    groups: int,
    key: Sequence[str],
    seed: int = 42,
    test_share: float = 0.2,
    column: str = "split",
) -> DataFrame:
    """As :func:`split_exact` within each value of ``by``.

    ``groups`` is the known number of values.  When there are too many to
    send their cuts to every task, the cuts are joined by shuffle, and salted
    copies of every cut keep a large group from meeting in one task.
    """
    digest = shuffle_hash(seed, *[F.col(k) for k in key])
    hashed = df.withColumn("_hash", digest)
    cuts = hash_cuts(hashed.select(by, "_hash"), share=test_share, by=[by], groups=groups)
    if groups <= BROADCAST_GROUPS:
        joined = hashed.join(F.broadcast(cuts), by, "left")
    else:
        salted = cuts.select("*", F.explode(F.sequence(F.lit(0), F.lit(255))).alias("_salt"))
        salt = F.conv(F.substring("_hash", 31, 2), 16, 10).cast("int")
        joined = hashed.withColumn("_salt", salt).join(salted, [by, "_salt"], "left").drop("_salt")
    side = F.when(_before_cut(F.col("_hash"), F.col("_cut")), "test").otherwise("train")
    return joined.select(*df.columns, side.alias(column))


def split_hash(
    df: DataFrame, key: Sequence[str], seed: int = 42, test_percent: int = 20, column: str = "split"
) -> DataFrame:
    """An approximate split decided row by row; works on streams as well."""
    percent = hash_percent(shuffle_hash(seed, *[F.col(k) for k in key]))
    return df.withColumn(column, F.when(percent < test_percent, "test").otherwise("train"))


def take_hashed(df: DataFrame, key: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    """A random but repeatable sample of exactly ``rows`` rows, or all there are."""
    return df.filter(in_sample(df, key, seed, rows=rows))


def first_rows(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The first ``n`` rows in key order; each task keeps no more than ``n``."""
    return df.orderBy(*key).limit(n)


def split_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))
