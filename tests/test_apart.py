"""Bigrams, streams that merge, rows set apart and files of even size."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tunemill.functions.lines import words
from tunemill.operators.bigrams import DISCOUNT, bigram_perplexity, fit_bigrams
from tunemill.operators.logs import latest_version
from tunemill.operators.rows import map_rows, map_rows_apart
from tunemill.operators.scoring import exact_match_score
from tunemill.operators.voting import vote_counts
from tunemill.plans.recipe import Recipe
from tunemill.plans.training import run_recipes
from tunemill.queries import queries
from tunemill.sources.datasets import Library
from tunemill.sources.publish import Folders
from tunemill.streaming import merged
from tunemill.streaming.render import read_stream


class Plain:
    """The model of one expert, as the formula says it."""

    def __init__(self, texts, vocabulary):
        self.pairs, self.firsts = Counter(), Counter()
        self.after, self.before = defaultdict(set), defaultdict(set)
        for text in texts:
            for v, w in zip(["", *text], text):
                self.pairs[v, w] += 1
                self.firsts[v] += 1
                self.after[v].add(w)
                self.before[w].add(v)
        self.size = len(self.pairs) + vocabulary

    def word(self, w):
        return (len(self.before.get(w, ())) + 1) / self.size

    def p(self, w, v):
        if v not in self.firsts:
            return self.word(w)
        n = self.firsts[v]
        return max(self.pairs[v, w] - DISCOUNT, 0) / n + DISCOUNT * len(self.after[v]) / n * self.word(w)

    def perplexity(self, text):
        return math.exp(-sum(math.log(self.p(w, v)) for v, w in zip(["", *text], text)) / len(text))


@pytest.mark.parametrize("head_bytes", [0, 2_000, 2**20])
def test_bigrams_equal_the_formula(spark, tmp_path, head_bytes):
    chance = random.Random(3)
    vocabulary = [f"w{i}" for i in range(25)]
    # The most common word stands before and after a third of all others.
    draw = lambda: [chance.choice(vocabulary) if chance.random() < 0.6 else "hot" for _ in range(chance.randrange(1, 30))]
    docs = [(i, chance.choice("ab"), draw()) for i in range(40)]
    more = [(100, "a", ["w1", "unseen", "w2", "hot", "unseen"]), (101, "b", []), (102, "z", ["only", "here"]), (103, None, ["w1"])]
    rows = [(i, e, " ".join(t)) for i, e, t in [*docs, *more]] + [(104, "q", None)]
    texts = spark.createDataFrame(rows, "id long, expert string, text string")
    tokens, experts = words(F.col("text")), ["a", "b", "c"]
    fitted = texts.filter("id < 100")
    terms = fit_bigrams(fitted, F.col("expert"), tokens, experts, f"{tmp_path}/model", head_bytes)
    made = bigram_perplexity(texts, "id", tokens, terms, experts, head_bytes)
    found = {(r.id, r.expert): r.ppl for r in made.select("id", F.inline("scores")).collect()}

    known = len({w for _, _, t in docs for w in t})
    models = {e: Plain([t for _, x, t in docs if x == e], known) for e in experts}
    expected = {(i, e): m.perplexity(t) for i, _, t in [*docs, *more] if t for e, m in models.items()}
    assert found.keys() == expected.keys() | {(i, e) for i in (101, 104) for e in experts}
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in expected)
    assert all(found[i, e] is None for i in (101, 104) for e in experts)
    for model in (models["a"], models["b"]):  # probabilities of all words after any word
        every = {w for _, _, t in docs for w in t}
        assert all(math.isclose(sum(model.p(w, v) for w in every), 1) for v in ["", "hot", "w3", "none"])


def test_bigrams_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, expert string, text string")
    tokens = words(F.col("text"))
    terms = fit_bigrams(empty, F.col("expert"), tokens, ["a"], f"{tmp_path}/model")
    assert bigram_perplexity(empty, "id", tokens, terms, ["a"]).count() == 0


def shuffled_rows(plan):
    """Rows that a query which has run wrote to its shuffles, without those of subqueries."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled_rows(plan.plan())
    children = plan.children()
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_a_word_is_shuffled_once_to_be_scored(spark, tmp_path):
    chance = random.Random(4)
    rows = [(i, "ab"[i % 2], " ".join(f"w{chance.randrange(400)}" for _ in range(300))) for i in range(30)]
    texts = spark.createDataFrame(rows, "id long, expert string, text string")
    tokens = words(F.col("text"))
    terms = fit_bigrams(texts, F.col("expert"), tokens, ["a", "b"], f"{tmp_path}/model", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = bigram_perplexity(texts, "id", tokens, terms, ["a", "b"], 0)
        assert len(made.collect()) == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Each word once and each term once, and some sums per text and partition; not three rows a word, twice.
    assert 9_000 < shuffled_rows(made._jdf.queryExecution().executedPlan()) < 9_000 + terms.count() + 30 * 20


def joined_rows(plan):
    """Rows that the merge joins of a query which has run gave."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return joined_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return joined_rows(plan.plan())
    children = plan.children()
    own = plan.metrics().apply("numOutputRows").value() if name == "SortMergeJoin" else 0
    return own + sum(joined_rows(children.apply(i)) for i in range(children.size()))


def test_rare_pairs_are_joined_once_as_numbers(spark, tmp_path):
    chance = random.Random(4)
    rows = [(i, "ab"[i % 2], " ".join(f"w{chance.randrange(400)}" for _ in range(300))) for i in range(30)]
    texts = spark.createDataFrame(rows, "id long, expert string, text string")
    tokens = words(F.col("text"))
    terms = fit_bigrams(texts, F.col("expert"), tokens, ["a", "b"], f"{tmp_path}/model", 0)
    assert not [f.name for f in terms.schema if f.dataType.typeName() in ("string", "array")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = bigram_perplexity(texts, "id", tokens, terms, ["a", "b"], 0)
        assert len(made.collect()) == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # What is known of them and what is not comes from one join.
    assert 9_000 <= joined_rows(made._jdf.queryExecution().executedPlan()) < 10_000


def test_texts_of_one_key_and_texts_without_words(spark, tmp_path):
    rows = [(1, "a", "x y x"), (1, "a", ""), (1, None, None), (2, "a", " "), (2, "a", " "), (None, "a", "y x"), (None, "b", "")]
    texts = spark.createDataFrame(rows, "id long, expert string, text string")
    tokens = words(F.col("text"))
    terms = fit_bigrams(texts, F.col("expert"), tokens, ["a"], f"{tmp_path}/model")
    made = bigram_perplexity(texts, "id", tokens, terms, ["a"]).select("id", F.inline("scores")).collect()
    found = Counter((r.id, r.ppl is None) for r in made)
    assert found == {(1, False): 1, (1, True): 2, (2, True): 2, (None, False): 1, (None, True): 1}


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_streams_equal_the_batch(spark, tmp_path):
    chance = random.Random(5)
    rows = [(i, chance.choice([None, 1, 1, 1, 2]), chance.choice("abc"), chance.choice(["checkpoint-2", "checkpoint-11", "runs"]))
            for i in range(300)]
    schema = "pos long, item int, answer string, name string"
    whole = spark.createDataFrame(rows, schema)
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    kinds = {
        "votes": (merged.votes("item", "answer", "pos"), lambda df: vote_counts(df, "item", "answer", "pos")),
        "versions": (merged.versions("item", "name"), lambda df: latest_version(df, "item", "name")),
    }
    for part in range(3):
        # Rows arrive in no order at all.
        whole.filter(F.col("pos") % 3 == (2 - part)).coalesce(1).write.mode("append").parquet(source)
        for name, (merging, plain) in kinds.items():
            stream = read_stream(spark, source, whole.schema)
            merged.stream_merged(stream, merging, f"{out}/{name}", f"{state}/{name}").awaitTermination(120)
            arrived = whole.filter(F.col("pos") % 3 >= 2 - part)
            assert as_set(merged.merged(spark, merging, f"{out}/{name}")) == as_set(plain(arrived))
            if part == 1:
                merged.compact(spark, merging, f"{out}/{name}")
                assert Folders(spark).names(f"{out}/{name}") == ["base=1"]
    for name, (merging, plain) in kinds.items():
        assert sorted(Folders(spark).names(f"{out}/{name}")) == ["base=1", "batch=2"]
        # The last batch and one of the base run again.
        merged.add_batch(whole.filter("pos % 3 = 0"), 2, merging, f"{out}/{name}")
        merged.add_batch(whole.filter("pos % 3 = 1"), 1, merging, f"{out}/{name}")
        assert as_set(merged.merged(spark, merging, f"{out}/{name}")) == as_set(plain(whole))


def test_scores_merge_and_a_compaction_that_died(spark, tmp_path):
    rows = [("m", f"<|im_start|>assistant\n{i % 3}\n<|im_end|>", str(i % 2)) for i in range(20)]
    outputs = spark.createDataFrame(rows, "model string, output string, expected string").withColumn("i", F.monotonically_increasing_id() % 2)
    merging, out = merged.scores("model"), f"{tmp_path}/out"
    with pytest.raises(ValueError, match="no batch"):
        merged.merged(spark, merging, out)
    for number in range(2):
        merged.add_batch(outputs.filter(F.col("i") == number), number, merging, out)
    expected = as_set(exact_match_score(outputs, "model"))
    # The base is there, what it was made of not yet deleted.
    merged.merged(spark, merging, out).write.parquet(f"{out}/base=1")
    assert as_set(merged.merged(spark, merging, out)) == expected
    merged.compact(spark, merging, out)
    assert Folders(spark).names(out) == ["base=1"]
    assert as_set(merged.merged(spark, merging, out)) == expected


def test_bad_rows_are_set_apart(spark):
    bad = {7, 500, 501}

    def fn(part):
        if set(part["id"]) & bad:
            raise KeyError("no such thing\nsecond line")
        return part.assign(twice=part["id"] * 2)[["id", "twice"]]

    df = spark.range(1_000).select("id", F.when(F.col("id") % 2 == 0, "even").alias("word"), F.array("id").alias("many"))
    made = map_rows_apart(df, fn, "id long, twice long").collect()
    good = [r for r in made if r.error is None]
    assert {(r.id, r.twice) for r in good} == {(i, 2 * i) for i in range(1_000) if i not in bad}
    assert all(r.failed is None for r in good)
    wrong = {r.failed.id: r for r in made if r.error is not None}
    assert wrong.keys() == bad and len(made) == 1_000
    assert wrong[500].error.startswith("KeyError") and wrong[500].id is None
    assert tuple(wrong[500].failed) == (500, "even", [500]) and wrong[7].failed.word is None


def test_rows_of_wrong_type_number_or_name(spark):
    def text_once(part):
        return part.assign(id=["x" if i == 3 else i for i in part["id"]])

    made = map_rows_apart(spark.range(8), text_once).collect()
    assert sorted(r.id for r in made if r.error is None) == [0, 1, 2, 4, 5, 6, 7]
    assert [r.failed.id for r in made if r.error is not None] == [3]
    lost = map_rows_apart(spark.range(8), lambda part: part[part["id"] != 3]).collect()
    assert [(r.failed.id, r.error) for r in lost if r.error] == [(3, "ValueError: 1 rows became 0")]
    assert map_rows_apart(spark.range(8), lambda part: part[part["id"] != 3], row_wise=False).count() == 7
    assert map_rows_apart(spark.range(0), lambda part: part).count() == 0
    with pytest.raises(ValueError, match="error"):
        map_rows_apart(spark.range(1).withColumnRenamed("id", "error"), lambda part: part)


def test_a_function_gets_some_megabytes_at_once(spark):
    def sized(part):
        assert list(part.index) == list(range(len(part)))
        return part.assign(together=part["text"].str.len().sum())[["id", "together"]]

    rows = spark.range(40).coalesce(1).select("id", F.expr("repeat('x', 500000)").alias("text"))
    small = spark.range(2_500).coalesce(1).select("id", F.lit("x").alias("text"))
    for apply in (map_rows, map_rows_apart):
        made = apply(rows, sized, "id long, together long").select("id", "together").collect()
        assert [r.id for r in made] == list(range(40)) and max(r.together for r in made) <= 4 * 2**20
        made = apply(small, sized, "id long, together long").select("id", "together").collect()
        assert [r.id for r in made] == list(range(2_500)) and max(r.together for r in made) == 1_000
    assert map_rows(spark.range(0), lambda part: part).count() == 0


def test_more_to_read_makes_more_ranges(spark, tmp_path):
    docs = [(i, "de", f"text {i}") for i in range(300)] + [(None, "en", None)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(12).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1_000)
    try:
        made = queries()["systematic_sample_json"](spark, str(tmp_path))
        assert len(made.inputFiles()) > 12
        # NULL comes first.
        assert [r.doc_id for r in made.orderBy("doc_id").collect()] == [None, *range(2, 300, 3)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_of_even_size(spark, tmp_path):
    rows = spark.range(6_000).select("id", F.expr("if(id % 3 = 0, 0, id % 40)").alias("n"), F.expr("repeat(sha2(string(id), 512), 4)").alias("q"))
    rows.repartition(12).write.parquet(f"{tmp_path}/sets/d")
    recipes = [Recipe(f"r{n}", "d", "q", filter_field_name="n", filter_field_value=n) for n in range(40)]
    library = Library(f"{tmp_path}/sets")
    files, found = {}, {}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        for even in (False, True):
            out = f"{tmp_path}/out{even}"
            assert set(run_recipes(spark, library, recipes, ["id"], out, even_files=even).values()) == {"ok"}
            table = spark.read.parquet(f"{out}/d")
            files[even], found[even] = len(table.inputFiles()), as_set(table.select("recipe", "id", "text", "split"))
            hot = [f for f in table.inputFiles() if "recipe=r0/" in f]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert found[True] == found[False]
    # A folder for each of 80 recipes and splits; the hot recipe in several files, the others in one or two.
    assert files[True] <= 160 < files[False] and 2 < len(hot) < 40
