"""From raw documents to packed bins, in five stages; each is written as Parquet and read by the next.

Every stage but the last gives the columns of ``documents``, whatever they are,
in their order.  ``n_chars``, where it exists, follows the text.  Rows with a
NULL id or text pass through and are packed like others; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import near, packing, passages, secrets, toxicity
from tunemill.llm.common import BROADCAST_ROWS, keep_rows, stored, table
from tunemill.llm.spans import redacted

TOXIC = toxicity.THRESHOLD
"""Documents that score this or more go, as in op1."""


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; it learns from the labels of the others' fold.

    Stored, so that whoever writes the result sends no batches of 10,000 texts to workers that later stages use.
    """
    model = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    return stored(docs.where(toxicity.score(model) < TOXIC))


def keyed(docs: DataFrame) -> DataFrame:
    """``_key`` and ``_row`` of each row: the id, or where an id has several texts, a number of its own for each text.

    The text of the smallest hash keeps the id; the others get 62 bits of a
    hash, above ids of usual size, so that rows with plain ids come first.
    """
    hashed = docs.select(
        F.col("doc_id").cast("bigint").alias("_id"),
        F.xxhash64(F.col("text").cast("string")).alias("_hash"),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
    )
    by_id = hashed.where(F.col("_id").isNotNull()).groupBy("_id").agg(F.min("_hash").alias("_first"), F.max("_hash").alias("_last"))
    several = stored(by_id.where(F.col("_first") < F.col("_last")).drop("_last"))
    n = several.count()
    if not n:
        return hashed.select(F.col("_id").alias("_key"), "_row")
    own = F.xxhash64("_id", "_hash").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    joined = hashed.join(F.broadcast(several) if n <= BROADCAST_ROWS else several, "_id", "left")
    return joined.select(F.when(F.col("_hash") != F.col("_first"), own).otherwise(F.col("_id")).alias("_key"), "_row")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class, that with the smallest id; different texts under one id are apart."""
    rows = keyed(docs)
    found = near.near_duplicates(rows.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text")))
    found = stored(found.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_key"), "kept"))
    gone = stored(found.where(~F.col("kept")).select("_key").distinct())
    few = gone.count() <= BROADCAST_ROWS
    left = rows.join(F.broadcast(gone) if few else gone, "_key", "left_anti")
    twice = stored(found.where("kept").groupBy("_key").count().where("count > 1").select("_key"))
    columns = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    if twice.isEmpty():
        return left.select(*columns)
    # Rows that repeat id and text: of these alone the texts move, one row a key from each task.
    one = keep_rows(left, twice, "_key").groupBy("_key").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    single = left.join(F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice, "_key", "left_anti")
    return single.select(*columns).unionByName(one.select(*columns))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document has; a document of which no word is left goes."""
    rows = keyed(docs).select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text"), F.col("_row").alias("_whole"))
    cut = passages.without(rows, passages.removals(rows))
    left = cut.where(~F.col("_cut") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("_cut"), length).otherwise(F.col("_whole").getField("n_chars"))
    return left.select(*[made.get(c, F.col("_whole").getField(c)).alias(c) for c in docs.columns])


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With each secret replaced by its kind in brackets; secrets that overlap go as one."""
    whole = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    found = secrets.scan(whole, keep=["_row"])
    row = F.col("_row")
    text = row.getField("text")
    hidden = F.when(F.size("all") > 0, redacted(text, F.col("all"), secrets.KINDS)).otherwise(text)
    once = found.select("_row", (F.size("all") > 0).alias("_cut"), F.explode(F.array(hidden)).alias("_hidden"))
    made = {"text": F.col("_hidden")}
    if "n_chars" in docs.columns:
        length = F.length("_hidden").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("_cut"), length).otherwise(row.getField("n_chars"))
    return once.select(*[made.get(c, row.getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of ``packing.CAPACITY`` words without two pieces of one source or two equal texts."""
    return packing.pack_by_source(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("passages", cut_passages),
    ("secrets", hide_secrets),
    ("best_fit", pack),
]

ORACLE_SQL = None
"""No stage but the fourth can be said in SQL; the tests hold each against a plain version of it."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
