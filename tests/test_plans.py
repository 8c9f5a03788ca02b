"""Recipes, catalogs, evaluation and streams end to end, and the shape of plans."""

import json
import math
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tunemill.plans.catalog import load_catalog
from tunemill.plans.evaluation import comparison, evaluation_items, recipe_table, scores, with_prompts
from tunemill.plans.recipe import EvaluationItem, Recipe
from tunemill.plans.training import (
    fan_out,
    not_done,
    prepare,
    run_recipes,
    training_set,
    training_sets,
    training_texts,
)
from tunemill.queries import queries
from tunemill.sources.catalog import declared_schema, read_descriptor
from tunemill.sources.datasets import Library
from tunemill.sources.ingest import good_rows, load_all, parse_json, quarantined, scan_json_lines
from tunemill.streaming.render import read_stream, stream_training_set

SCHEMA = "id long, q string, a string, c string, n int, lang string"
ROWS = [
    (1, "q1", "a1", "c1", 0, "en"),
    (2, "q2", "a2", None, 1, "en"),
    (3, "q3", None, "c3", 2, "de"),
    (4, None, "a4", "c4", 0, "de"),
    (5, " q5\n\n x", "a5", "", None, "fr"),
]
REPLY = "<|im_end|>\n<|im_start|>assistant\n"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def recipe(name="r", **keys):
    return Recipe.from_dict(name, {"dataset_id": "d", "dataset_input_field_name": "q", **{f"dataset_{k}": v for k, v in keys.items()}})


def texts(df):
    return {r.id: r.text for r in df.collect()}


def test_template_follows_the_recipe(rows):
    plain = {"output_field_name": "a"}
    context = plain | {"context_field_name": "c"}
    made = texts(training_texts(rows, recipe(), ["id"]))
    assert made == {1: "q1", 2: "q2", 3: "q3", 5: "q5\nx"}
    made = texts(training_texts(rows, recipe(**plain), ["id"]))
    assert made.keys() == {1, 2, 5} and made[1] == f"<|im_start|>user\nq1\n{REPLY}a1\n<|im_end|>    "
    assert "\nh\nq1\n" in texts(training_texts(rows, recipe(**plain, input_hint="h"), ["id"]))[1]
    made = texts(training_texts(rows, recipe(**context, input_hint="h"), ["id"]))
    assert "\nq1\nc1\n" in made[1] and "\nq2\n\n<" in made[2] and "h\n" not in made[1]
    made = texts(training_texts(rows, recipe(**context, context_hint="h"), ["id"]))
    assert "\nh\ncontext:\nc1\nquestion:\nq1\n" in made[1]
    # A context hint without a context has no effect.
    assert texts(training_texts(rows, recipe(**plain, context_hint="h"), ["id"])) == texts(
        training_texts(rows, recipe(**plain), ["id"])
    )


def test_a_template_of_the_callers_own(rows):
    wanted = recipe(output_field_name="n", output_field_values_to_texts={0: "no"})
    made = training_texts(rows, wanted, ["id"], template=lambda f: F.concat_ws("|", f["input"], f["output"]))
    assert texts(made) == {1: "q1|no", 2: "q2|1", 3: "q3|2"}


def test_filters_labels_and_counts(rows):
    labels = recipe(
        output_field_name="n", output_field_values_to_texts={0: "no"}, filter_field_name="lang", filter_field_value="en"
    )
    made = texts(training_texts(rows, labels, ["id"]))
    assert "\nno\n" in made[1] and "\n1\n" in made[2] and len(made) == 2
    # A filter value without a filter name filters nothing.
    assert len(texts(training_texts(rows, recipe(filter_field_value="en"), ["id"]))) == 4
    observation = Observation()
    training_texts(rows, recipe(output_field_name="a"), ["id"], observation).collect()
    assert observation.get == {"rows": 5, "dropped": 2}
    with pytest.raises(ValueError):
        training_texts(rows, recipe(output_field_name="missing"), ["id"])
    with pytest.raises(ValueError):
        Recipe.from_dict("x", {"dataset_id": "d"})


def test_every_kth_follows_the_config():
    sampled = {c: recipe(load_config=c).every_kth for c in ("20231101.ja", "20231101.fr", "20231101.ko", "all")}
    assert sampled == {"20231101.ja": 3, "20231101.fr": 5, "20231101.ko": 1, "all": 1}
    assert recipe().every_kth == 1


MANY = [
    recipe("text/en", filter_field_name="lang", filter_field_value="en"),
    recipe("text/de", filter_field_name="lang", filter_field_value="de"),
    recipe("text/de2", filter_field_name="lang", filter_field_value="de"),
    recipe("all"),
    recipe("all2"),
    recipe("qa", output_field_name="a"),
    recipe("hint", output_field_name="a", input_hint="h"),
    recipe("labels", output_field_name="n", output_field_values_to_texts={0: "no", 1: "yes"}),
    recipe("labels2", output_field_name="n", input_hint="h", output_field_values_to_texts={2: "two"}),
    recipe("context", output_field_name="a", context_field_name="c"),
    recipe("contexthint", output_field_name="a", context_field_name="c", context_hint="h"),
    recipe("number", output_field_name="a", filter_field_name="n", filter_field_value="0"),
    recipe("nothing", filter_field_name="n", filter_field_value="none"),
]


def test_fan_out_equals_single_runs(rows):
    made = {(r.recipe, r.id, r.text) for r in fan_out(rows, MANY, ["id"]).collect()}
    single = {(r.name, i, t) for r in MANY for i, t in texts(training_texts(rows, r, ["id"])).items()}
    assert made == single
    with pytest.raises(ValueError):
        fan_out(rows, [recipe(), recipe(load_config="x")], ["id"])


def test_split_inside_each_recipe(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("q"), (F.col("id") % 10 == 0).alias("rare"))
    pair = [recipe("all"), recipe("rare", filter_field_name="rare", filter_field_value=True)]
    counts = {(r.recipe, r.split): r["count"] for r in training_sets(df, pair, ["id"]).groupBy("recipe", "split").count().collect()}
    assert counts == {("all", "test"): 20, ("all", "train"): 80, ("rare", "test"): 2, ("rare", "train"): 8}


def test_prepare_and_run_recipes(spark, rows, tmp_path):
    library = Library(str(tmp_path / "in"))
    rows.write.parquet(library.path("d"))
    stored = prepare(spark, library, MANY[0], ["id"], str(tmp_path / "one"))
    assert sorted((r.id, r.split) for r in stored.collect() if r.split == "test").__len__() == 1
    bad = Recipe("bad", "missing", "q")
    wrong = Recipe("wrong", "d2", "no-such-column")
    rows.write.parquet(library.path("d2"))
    out = str(tmp_path / "out")
    result = run_recipes(spark, library, [*MANY[:2], bad, wrong], ["id"], out)
    assert result["text/en"] == result["text/de"] == "ok"
    assert "ok" not in (result["bad"], result["wrong"])
    # A later run leaves what earlier runs wrote for the same source.
    assert run_recipes(spark, library, MANY[:4], ["id"], out, done=["text/en", "text/de"]) == {
        "text/de2": "ok",
        "all": "ok",
    }
    kept = {r.recipe for r in spark.read.parquet(f"{out}/d").select("recipe").distinct().collect()}
    assert kept == {"text/en", "text/de", "text/de2", "all"}
    assert run_recipes(spark, library, MANY[:1], ["id"], out, done=["text/en"]) == {}
    manifest = spark.createDataFrame([(1,), (1,), (3,)], "id long")
    assert {r.id for r in not_done(rows, manifest, "id").collect()} == {2, 4, 5}


def test_sampled_training_set(spark, tmp_path):
    library = Library(str(tmp_path))
    spark.range(0, 100, 1, 1).select("id", F.col("id").cast("string").alias("q"), F.lit("20231101.de").alias("config")).write.partitionBy(
        "config"
    ).parquet(library.path("d"))
    from tunemill.sources.datasets import scan

    wanted = recipe(load_config="20231101.de")
    df = training_set(scan(spark, library, "d", wanted.load_config), wanted, ["id"], complete=True)
    assert sorted(r.id for r in df.collect()) == list(range(0, 100, 5))
    assert df.filter("split = 'test'").count() == math.ceil(0.2 * 20)


def test_catalog(spark, tmp_path):
    entries = {
        "a": "id: x/small\nconverted_size: 2.5MB\nlang: no\nlangs:\n  - no\nstructure:\n  - id: t\n    type: string\n    optional: true\n  - id: n\n    type: int64\n",
        "b": "id: x/nested\nconverted_size: 9GB\nstructure:\n  main:\n    - id: label\n      type: Label\n",
        "c": "id: x/huge\nconverted_size: 2.45TB\n",
        "d": "id: x/unsized\nconverted_size: 7.12\n",
    }
    folder = tmp_path / "catalog" / "deep"
    folder.mkdir(parents=True)
    for name, text in entries.items():
        (folder / f"{name}.yaml").write_text(text)
    descriptor = read_descriptor(folder / "a.yaml")
    assert descriptor["lang"] == "no" and descriptor["langs"] == ["no"]
    assert declared_schema(descriptor).simpleString() == "struct<t:string,n:bigint>"
    assert declared_schema(read_descriptor(folder / "b.yaml")).simpleString() == "struct<label:int>"
    library = Library(str(tmp_path / "data"))
    spark.range(3).withColumn("t", F.lit("z")).write.parquet(library.path("x/small"))
    loaded = load_catalog(spark, str(tmp_path / "catalog"), library)
    assert loaded.frames.keys() == {"x/small"} and loaded.failed.keys() == {"x/nested"}


def test_load_all_unions_what_can_be_read(spark, tmp_path):
    library = Library(str(tmp_path))
    spark.range(3).write.parquet(library.path("one"))
    spark.createDataFrame([("a",)], "t string").write.parquet(library.path("two"))
    loaded = load_all(spark, library, ["one", "none", "two"])
    assert loaded.failed.keys() == {"none"}
    assert {(r.id, r.t, r.dataset_id) for r in loaded.rows().collect()} >= {(None, "a", "two"), (2, None, "one")}


def test_bad_json_is_kept_aside(spark):
    raw = [(1, '{"k": 5}'), (2, '{"k": '), (3, "{}"), (4, '{"k": "x"}'), (5, None)]
    schema = spark.createDataFrame([], "k long").schema
    parsed = parse_json(spark.createDataFrame(raw, "i int, raw string"), "raw", schema)
    assert {(r.i, r.k) for r in good_rows(parsed).collect()} == {(1, 5), (3, None), (5, None)}
    assert {r.i for r in quarantined(parsed).collect()} == {2, 4}


def test_broken_json_lines(spark, tmp_path):
    (tmp_path / "set").mkdir()
    (tmp_path / "set" / "part.json").write_text('{"k": 1}\n{"k": \n{"k": 3, "more": true}\n')
    lines = scan_json_lines(spark, Library(str(tmp_path)), "set", spark.createDataFrame([], "k long").schema)
    assert sorted(r.k for r in good_rows(lines).collect()) == [1, 3]
    assert [r._corrupt_record for r in quarantined(lines).collect()] == ['{"k": ']


def test_evaluation(spark):
    recipes = [
        Recipe("r1", "d", "q", evaluations=(EvaluationItem("p0", "A"), EvaluationItem("p1", "B", context=""), EvaluationItem("p2", "C", hint="h"))),
        Recipe("r2", "d", "q", context_hint="ch", evaluations=(EvaluationItem("p", "D", context="c"),)),
    ]
    items = evaluation_items(recipe_table(spark, recipes))
    prompts = {(r.recipe, r.pos): (r.prompt, r.shown) for r in with_prompts(items).collect()}
    assert prompts["r1", 0] == (f"<|im_start|>user\np0\n{REPLY}", "p0")
    assert prompts["r1", 1][1] == "p1\n" and prompts["r1", 2][1] == "h\np2"
    assert prompts["r2", 0][1] == "ch\ncontext:\nc\nquestion:\np"
    outputs = spark.createDataFrame(
        [("r1", 0, "base", "A"), ("r1", 0, "tuned", "A"), ("r1", 1, "base", "x"), ("r1", 1, "tuned", prompts["r1", 1][0] + "B\n<|im_end|>"), ("r2", 0, "base", "D"), ("r2", 0, "tuned", "d")],
        "recipe string, pos int, variant string, output string",
    )
    assert {tuple(r) for r in comparison(items, outputs).collect()} == {("r1", 1, 2, 1), ("r2", 1, 0, -1)}
    assert {tuple(r) for r in scores(items, outputs).collect()} >= {("r1", "tuned", 2, 3), ("r2", "tuned", 0, 1)}


def test_recipe_file(tmp_path):
    path = tmp_path / "r.yaml"
    path.write_text(
        "dataset_id: d\ndataset_input_field_name: q\ndataset_output_field_name: n\n"
        "dataset_output_field_values_to_texts:\n  0: \"No\"\n"
        "dataset_filter_field_name: flag\ndataset_filter_field_value: true\n"
        "evaluations:\n  -\n    prompt: \"p\"\n    expected_output: 7\n"
    )
    made = Recipe.read(path)
    assert made.name == str(path) and made.filter_field_value is True
    assert made.output_field_values_to_texts == {0: "No"}
    assert made.evaluations == (EvaluationItem("p", "7"),)


def test_stream_equals_batch(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    wanted = recipe(output_field_name="a")
    for part in ([1, 2], [3, 4, 5]):
        rows.filter(F.col("id").isin(part)).coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, rows.schema)
        stream_training_set(stream, wanted, ["id"], out, str(tmp_path / "state")).awaitTermination(120)
    made = spark.read.parquet(out)
    assert texts(made) == texts(training_texts(rows, wanted, ["id"]))
    assert made.count() == 3
    with pytest.raises(ValueError):
        stream_training_set(stream, recipe(load_config="20231101.ja"), ["id"], out, "x")


# --- plans ----------------------------------------------------------------

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", list(queries()))
def test_no_slow_operators(spark, name):
    plan = plan_of(queries()[name](spark, str(DATA)))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInPandas" in plan) == name.startswith("map_rows")


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(queries()["filter_equals"](spark, str(DATA)))
    assert "EqualTo(lang,de)" in plan
    plan = plan_of(queries()["recipe_fanout"](spark, str(DATA)))
    assert "EqualTo(lang,en)" in plan
    plan = plan_of(queries()["split_exact"](spark, str(DATA)))
    assert "text" not in plan and plan.count("ReadSchema: struct<doc_id:bigint>") >= 1


@needs_data
def test_the_flagship_is_small(spark):
    made = queries()["training_summary"](spark, str(DATA))
    assert json.loads(made.schema.json())["fields"][0]["name"] == "split"
