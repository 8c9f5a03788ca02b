"""Jobs over many recipes and sources: what one of them lacks must not touch the others."""

import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill import __main__ as cli
from tunemill.operators.logs import latest_version, time_to_next
from tunemill.operators.routing import choose_expert
from tunemill.operators.turns import question_answer_pairs
from tunemill.operators.voting import vote_ranking
from tunemill.plans.evaluation import evaluation_items, recipe_table, scores
from tunemill.plans.recipe import EvaluationItem, Recipe
from tunemill.plans.training import fan_out, run_recipes, training_texts
from tunemill.sources.datasets import Library, scan
from tunemill.sources.ingest import load_all


@pytest.fixture
def call(spark, monkeypatch, capsys):
    def run(*args):
        monkeypatch.setattr(sys, "argv", ["tunemill", *map(str, args)])
        cli.main()
        return capsys.readouterr().out

    return run


@pytest.fixture
def rows(spark):
    data = [(i, f"q{i}", f"a{i}", i % 3, i % 2 == 0, float(i % 4)) for i in range(24)]
    return spark.createDataFrame(data, "id int, q string, a string, n int, b boolean, x double")


def filtered(name, column, value):
    return Recipe(name, "d", "q", "a", filter_field_name=column, filter_field_value=value)


def test_recipes_match_alike_alone_and_together(rows):
    asked = [("n", 1), ("n", 1.0), ("n", 1.5), ("n", True), ("n", "1"), ("n", None), ("b", True), ("b", "false"), ("x", 2), ("x", "no")]
    recipes = [filtered(f"{c}={v!r}", c, v) for c, v in asked] + [Recipe("all", "d", "q", "a")]
    together = {}
    for r in fan_out(rows, recipes, ["id"]).collect():
        together.setdefault(r.recipe, set()).add((r.id, r.text))
    for recipe in recipes:
        alone = {(r.id, r.text) for r in training_texts(rows, recipe, ["id"]).collect()}
        assert together.get(recipe.name, set()) == alone


@pytest.mark.parametrize("n", [3, 130])
def test_the_number_of_recipes_changes_nothing(rows, n):
    recipes = [filtered(f"r{i}", "q", f"q{i}") for i in range(n)] + [filtered("none", "q", None), filtered("two", "n", 2)]
    found = fan_out(rows, recipes, ["id"]).groupBy("recipe").count().collect()
    assert {r.recipe: r["count"] for r in found} == {**{f"r{i}": 1 for i in range(min(n, 24))}, "two": 8}


def test_mixed_filters_share_one_scan(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/d")
    df = scan(spark, Library(str(tmp_path)), "d")
    made = fan_out(df, [filtered("a", "n", 1), filtered("b", "b", True), Recipe("c", "d", "q", "a")], ["id"])
    assert made._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_a_wrong_recipe_beside_good_ones(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/d")
    recipes = [Recipe("good", "d", "q", "a"), Recipe("bad", "d", "nope", "a"), filtered("some", "n", 1)]
    out = run_recipes(spark, Library(str(tmp_path)), recipes, ["id"], f"{tmp_path}/out")
    assert out["good"] == out["some"] == "ok" and out["bad"].startswith("no such column: nope")
    assert spark.read.parquet(f"{tmp_path}/out/d").groupBy("recipe").count().count() == 2


def test_a_rerun_leaves_nothing_of_the_old_folders(spark, rows, tmp_path):
    library, recipe = Library(str(tmp_path)), Recipe("r", "d", "q", "a")
    rows.write.parquet(f"{tmp_path}/d")
    run_recipes(spark, library, [recipe], ["id"], f"{tmp_path}/out")
    rows.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/d")
    assert run_recipes(spark, library, [recipe], ["id"], f"{tmp_path}/out") == {"r": "ok"}
    assert not list((tmp_path / "out" / "d" / "config=default").glob("recipe=*/**/*.parquet"))


def test_data_columns_called_split_and_config_choose_nothing(spark, tmp_path):
    data = [(i, "train" if i % 2 else "dev", "c") for i in range(10)]
    spark.createDataFrame(data, "id int, split string, config string").write.parquet(f"{tmp_path}/d")
    library = Library(str(tmp_path))
    assert scan(spark, library, "d").count() == 10
    with pytest.raises(ValueError, match="no configs"):
        scan(spark, library, "d", "c")
    spark.createDataFrame(data, "id int, split string, config string").write.partitionBy("config", "split").parquet(f"{tmp_path}/p")
    assert scan(spark, library, "p", "c").count() == 5


def test_csv_keeps_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.csv").write_text('id,t\n1,"a\nb"\n2,"c ""q"" d"\n')
    schema = T.StructType().add("id", "integer").add("t", "string")
    found = scan(spark, Library(str(tmp_path), "csv"), "d", schema=schema).collect()
    assert [tuple(r) for r in found] == [(1, "a\nb"), (2, 'c "q" d')]
    first = scan(spark, Library(str(tmp_path), "csv"), "d", split="train[:1]", schema=schema).collect()
    assert [tuple(r) for r in first] == [(1, "a\nb")]


def test_a_torn_file_among_three_sources(spark, tmp_path):
    for name in "abc":
        spark.range(50).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    torn = next((tmp_path / "b").glob("*.parquet"))
    data = bytearray(torn.read_bytes())
    data[4:60] = b"\xff" * 56
    torn.write_bytes(data)
    for crc in (tmp_path / "b").glob(".*.crc"):
        crc.unlink()
    loaded = load_all(spark, Library(str(tmp_path)), "abc", out=f"{tmp_path}/out")
    assert set(loaded.frames) == {"a", "c"} and set(loaded.failed) == {"b"}
    assert loaded.rows().count() == 100


def test_bad_json_lines_are_stored_apart(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text('{"id": 1}\nnot json\n{"id": 2}\n')
    schema = {"j": T.StructType().add("id", "long")}
    loaded = load_all(spark, Library(str(tmp_path), "json"), ["j"], schema, f"{tmp_path}/out")
    assert sorted(r.id for r in loaded.frames["j"].collect()) == [1, 2]
    assert [r._corrupt_record for r in spark.read.parquet(f"{tmp_path}/out/j.bad").collect()] == ["not json"]


def test_prepare_skips_what_is_finished(rows, call, tmp_path):
    rows.write.parquet(f"{tmp_path}/sets/d")
    paths = [tmp_path / "one.yaml", tmp_path / "two.yaml"]
    for path in paths:
        path.write_text("dataset_id: d\ndataset_input_field_name: q\n")
    options = ["--root", f"{tmp_path}/sets", "--key", "id", "--out", f"{tmp_path}/out"]
    assert call("prepare", paths[0], *options) == f"{paths[0]}: ok\n"
    assert call("prepare", paths[0], *options) == ""
    assert call("prepare", *paths, *options) == f"{paths[1]}: ok\n"
    assert call("prepare", paths[0], *options, "--again", "--complete") == f"{paths[0]}: ok\n"


def test_votes_of_many_items_are_written(spark, call, tmp_path):
    data = [(f"i{i:02}", 0, "yes") for i in range(21)]
    spark.createDataFrame(data, "item string, voter_pos int, response string").write.parquet(f"{tmp_path}/votes")
    call("vote", "--responses", f"{tmp_path}/votes", "--out", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 21
    assert "1 more items" in call("vote", "--responses", f"{tmp_path}/votes")


def test_items_without_output_count(spark):
    recipe = Recipe("r", "d", "q", evaluations=(EvaluationItem("p", "A"), EvaluationItem("p", "B"), EvaluationItem("p", "C")))
    outputs = spark.createDataFrame([("r", 0, "base", "A")], "recipe string, pos int, variant string, output string")
    found = scores(evaluation_items(recipe_table(spark, [recipe])), outputs).collect()
    assert [tuple(r) for r in found] == [("r", "base", 1, 3)]


def test_nulls_and_ties(spark):
    votes = spark.createDataFrame([(None, "a", 1), (None, "b", None), (1, "a", None)], "i int, r string, p int")
    assert vote_ranking(votes, "i", "r", "p").count() == 3
    log = spark.createDataFrame([(1, None, 0), (2, None, 300)], "e int, u int, s int").withColumn("ts", F.timestamp_seconds("s"))
    for width in (60, 0.5):
        found = {r.e: r.elapsed_us for r in time_to_next(log, "u", "ts", "e", bucket_seconds=width).collect()}
        assert found == {1: 300_000_000, 2: None}
    for names in (["checkpoint-7-b", "checkpoint-007"], ["checkpoint-007", "checkpoint-7-b"]):
        df = spark.createDataFrame([(1, n) for n in names], "k int, name string").coalesce(1)
        assert latest_version(df, "k", "name").first().name == "checkpoint-7-b"
    table = [(1, "a", 0, None), (1, "b", 1, 2.0), (1, "c", 2, float("nan")), (2, "a", 0, None)]
    scored = spark.createDataFrame(table, "id int, expert string, expert_pos int, ppl double")
    assert sorted(map(tuple, choose_expert(scored, "id").collect())) == [(1, "b", 2.0), (2, None, None)]


def test_pairs_over_a_gap_if_asked(spark):
    said = [(1, 0, "user", "q"), (1, 5, "assistant", "a"), (1, 6, "user", "r"), (1, 7, "assistant", "b")]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    assert question_answer_pairs(turns, 2).count() == 1
    assert question_answer_pairs(turns, 2, over_gaps=True).count() == 2
