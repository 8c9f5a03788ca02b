import sys

import pytest

from tunemill import __main__ as cli


@pytest.fixture
def call(spark, monkeypatch, capsys):
    def run(*args):
        monkeypatch.setattr(sys, "argv", ["tunemill", *map(str, args)])
        cli.main()
        return capsys.readouterr().out

    return run


def test_prepare_prompts_and_score(spark, call, tmp_path):
    spark.createDataFrame([(i, f"q{i}", f"a{i}") for i in range(10)], "id int, q string, a string").write.parquet(
        f"{tmp_path}/sets/me/data"
    )
    path = tmp_path / "r.yaml"
    path.write_text(
        "dataset_id: me/data\ndataset_input_field_name: q\ndataset_output_field_name: a\n"
        "evaluations:\n  - prompt: p\n    expected_output: x\n"
    )
    printed = call("prepare", path, "--root", f"{tmp_path}/sets", "--key", "id", "--out", f"{tmp_path}/out")
    assert printed == f"{path}: ok\n"
    made = spark.read.parquet(f"{tmp_path}/out/me/data")
    assert made.count() == 10 and made.filter("split = 'test'").count() == 2
    call("prompts", path, "--out", f"{tmp_path}/prompts")
    assert spark.read.parquet(f"{tmp_path}/prompts").first().shown == "p"
    outputs = [(str(path), 0, "base", "y"), (str(path), 0, "tuned", "x")]
    spark.createDataFrame(outputs, "recipe string, pos int, variant string, output string").write.parquet(
        f"{tmp_path}/outputs"
    )
    assert "|0         |1          |1   |" in call("score", path, "--outputs", f"{tmp_path}/outputs")


def test_vote_and_load(spark, call, tmp_path):
    rows = [("one", 0, "no"), ("one", 1, "yes"), ("one", 2, "yes")]
    spark.createDataFrame(rows, "item string, voter_pos int, response string").write.parquet(f"{tmp_path}/votes")
    assert "|one |yes     |2    |3      |" in call("vote", "--responses", f"{tmp_path}/votes")
    (tmp_path / "catalog").mkdir()
    for name, size in (("small", "1MB"), ("gone", "1MB"), ("large", "11GB")):
        (tmp_path / "catalog" / f"{name}.yaml").write_text(f"id: {name}\nconverted_size: {size}\n")
    spark.range(2).write.parquet(f"{tmp_path}/sets/small")
    printed = call("load", tmp_path / "catalog", "--root", f"{tmp_path}/sets")
    assert "small: struct<id:bigint>" in printed and "gone: [PATH_NOT_FOUND]" in printed
    assert "large" not in printed
