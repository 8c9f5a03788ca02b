"""Each stage of the pipeline against a plain version of it, with odd rows and clashing columns."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from test_llm import SF, SECRET_TEXTS, plain_classes, secret_base

import corpus_pipeline as pipeline
from tunemill.llm import packing, secrets, toxicity
from tunemill.llm.common import stored, table

CLASHING = ["start", "end", "_row", "_text", "base", "spans", "kept", "component", "_gone", "bucket", "score", "label"]


@pytest.fixture(scope="module")
def raw(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    passage = " ".join(f"passage{i}" for i in range(60))
    more = [
        (None, "no id at all"), (-1, None), (-2, ""), (-3, "same row"), (-3, "same row"), (-4, "other row of an id"), (-4, "and another one"),
        *[(-100 - i, t) for i, t in enumerate(SECRET_TEXTS)],
        *[(10_000 + i, " ".join(f"own{i}x{j}" for j in range(90)) + " " + passage) for i in range(4)],
    ]
    odd = spark.createDataFrame(more, "doc_id bigint, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("bigint").alias("n_chars")
    )
    both = docs.unionByName(odd)
    return stored(both.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]))


@pytest.fixture(scope="module")
def stages(spark, raw):
    made = [raw]
    for _, stage in pipeline.STAGES:
        made.append(stored(stage(spark, made[-1], SF)))
    return made


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_columns_and_lengths_stay(raw, stages):
    for df in stages[:-1]:
        assert df.dtypes == raw.dtypes
        assert df.where(F.col("n_chars") != F.length("text")).isEmpty()
        assert df.where(F.col("start") != 0).isEmpty()


def test_toxic_documents_go(spark, stages):
    model = toxicity.fit_documents(stages[0], table(spark, SF, "labels"))
    assert rows(stages[1]) == [r for r in rows(stages[0]) if model.score(r[1]) < pipeline.TOXIC]
    assert 0 < stages[1].count() < stages[0].count()


def test_the_pipeline_rejects_what_op1_rejects():
    assert pipeline.TOXIC == toxicity.THRESHOLD == 0.3


def test_one_document_of_each_class_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    texts = {k: t for k, t in before if k is not None and k != -4}
    classes = plain_classes(texts, 5)
    kept = {k for k, (_, c) in classes.items() if k == c}
    assert {k for k, _ in after if k is not None and k != -4} == kept
    assert len(after) == len(kept) + 3  # the row without an id, and both texts of id -4
    assert {t for k, t in after if k == -4} == {t for k, t in before if k == -4} and set(after) <= set(before)


def test_different_texts_of_one_id_stay(spark):
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    given = [(5, text("a")), (9, text("a") + " end"), (9, text("b")), (9, text("c") + " " + text("b", 55)), (7, text("d")), (7, text("d"))]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    left = pipeline.drop_near_copies(spark, docs, SF)
    assert rows(left) == sorted([given[0], given[2], given[3], given[4]], key=str)
    cut = rows(pipeline.cut_passages(spark, stored(left), SF))
    assert given[0] in cut and given[4] in cut and len(cut) == 4
    nines = " ".join(t for k, t in cut if k == 9)
    assert all(nines.split().count(w) >= 1 for w in (given[2][1] + " " + given[3][1]).split())


def test_repeated_passages_go(stages):
    before, after = dict(rows(stages[2])), dict(rows(stages[3]))
    windows = lambda t: {tuple(w) for w in zip(*[(t or "").split()[i:] for i in range(50)])}
    seen, repeated = set(), set()
    for text in after.values():
        repeated |= seen & windows(text)
        seen |= windows(text)
    assert not repeated
    assert before[10_000] == after[10_000] and all(after[10_000 + i] != before[10_000 + i] for i in (1, 2, 3))
    everywhere = [w for t in before.values() for w in windows(t)]
    if len(everywhere) == len(set(everywhere)):
        assert before == after


def test_secrets_are_hidden(stages):
    def hidden(rule, text):
        return any(rule.kind != "web_token" or "." in m[0] for m in re.finditer(rule.pattern, text or ""))

    after = rows(stages[4])
    for key, text in rows(stages[3]):
        same = (key, text) in after
        if not secret_base(text) and not any(hidden(r, text) for r in secrets.MORE):
            assert same
        else:
            assert not same and not any(k == 1 for i, t in after if i == key for _, k, _ in secret_base(t))
    assert stages[3].count() == stages[4].count()


def test_whole_secrets_are_hidden(spark):
    body = "\n".join("Ab0/" * 16 for _ in range(3)) + "\n0123456789abcdef0123=="
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts = [
        f"a {head}\nProc-Type: 4,ENCRYPTED\n\n{body}\n{end} z",
        f"a {head}\n{body}\nand then prose z",
        f"a {head}\\n{'Ab0/' * 16}\\n{end} z",
        f"a {head} and then prose; z",
        "a Authorization: Bearer XYZ.0123456789abcdef.More-secret z",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [t for _, t in rows(pipeline.hide_secrets(spark, docs, SF))] == [
        "a [PRIVATE_KEY] z",
        "a [PRIVATE_KEY]\nand then prose z",
        "a [PRIVATE_KEY] z",
        "a [PRIVATE_KEY] and then prose; z",
        "a [BEARER] z",
    ]


def test_all_that_is_left_is_packed(stages):
    words = stages[4].agg(F.sum(packing.word_count())).first()[0]
    assert stages[5].agg(F.sum("n_tokens")).first()[0] == words
    assert stages[5].select("doc_id").distinct().count() == stages[4].select("doc_id").distinct().count()


def test_an_empty_table(spark, raw):
    df = raw.limit(0)
    for _, stage in pipeline.STAGES:
        df = stored(stage(spark, df, SF))
        assert df.count() == 0


def test_it_is_registered():
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is pipeline.run
    assert 4 <= len(pipeline.STAGES) <= 5 and pipeline.ORACLE_SQL is None
