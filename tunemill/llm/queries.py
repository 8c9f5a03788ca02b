"""The operators of this package as queries over the test tables; a query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import (
    bpe,
    fingerprint,
    language,
    near,
    neighbours,
    packing,
    passages,
    pii,
    prefixes,
    secrets,
    spelling,
    toxicity,
    urls,
)
from tunemill.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~toxicity.teaches(), F.lit(False))
    scored = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), toxicity.score(model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = sorted({len(path) for _, _, path in urls.RULES})
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark), lengths)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.detect(table(spark, sf_dir, "documents")))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.removals(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents")))


def best_fit_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_by_source(table(spark, sf_dir, "documents"))


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_following(table(spark, sf_dir, "documents"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity_scores,
        "op2_url_filter": url_verdicts,
        "op3_nearest": nearest_vectors,
        "op4_personal_data": personal_data,
        "op5_best_fit": best_fit_bins,
        "op6_fingerprints": digests,
        "op7_near_duplicates": near_classes,
        "op8_bpe": bpe_round_trip,
        "op9_passages": repeated_passages,
        "op10_secrets": secret_scan,
        "op11_spelling": spelling_variants,
        "op12_conversation_trie": conversation_trie,
        "op13_language": languages,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": urls.ORACLE_SQL,
        "op7_near_duplicates": near.ORACLE_SQL,
        "op11_spelling": spelling.ORACLE_SQL,
        "op12_conversation_trie": prefixes.ORACLE_SQL,
    }
