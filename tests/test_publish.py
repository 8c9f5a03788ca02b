"""Sets that are made anew stay readable until the new one is whole; sources are read side by side."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tunemill.plans import training
from tunemill.plans.recipe import Recipe
from tunemill.plans.training import prepare, run_recipes
from tunemill.sources import ingest, publish
from tunemill.sources.datasets import Library
from tunemill.sources.ingest import load_all


@pytest.fixture
def library(spark, tmp_path):
    data = [(i, f"q{i}", f"a{i}", i % 3) for i in range(24)]
    spark.createDataFrame(data, "id int, q string, a string, n int").write.parquet(f"{tmp_path}/sets/d")
    return Library(f"{tmp_path}/sets")


def broken(texts):
    """Fails half-way: the row with id 20 stops its task."""
    stop = F.when(F.col("id") == 20, F.raise_error(F.lit("half-way")).cast("string")).otherwise(F.col("text"))
    return texts.withColumn("text", stop)


def test_a_failing_job_leaves_the_last_good_sets(spark, library, tmp_path, monkeypatch):
    recipes = [Recipe("r1", "d", "q", "a"), Recipe("r2", "d", "q", "a", filter_field_name="n", filter_field_value=2)]
    out = f"{tmp_path}/out"
    assert set(run_recipes(spark, library, recipes, ["id"], out).values()) == {"ok"}
    rows = lambda: sorted(map(tuple, spark.read.parquet(f"{out}/d").select("recipe", "id", "text", "split").collect()))
    before = rows()
    real = training.training_sets
    monkeypatch.setattr(training, "training_sets", lambda *a, **k: broken(real(*a, **k)))
    outcome = run_recipes(spark, library, recipes, ["id"], out)
    assert "half-way" in outcome["r1"] and "half-way" in outcome["r2"] and rows() == before
    monkeypatch.undo()
    assert set(run_recipes(spark, library, recipes[:1], ["id"], out).values()) == {"ok"} and rows() == before
    assert not [p for p in (tmp_path / "out").rglob("_*") if p.is_dir()]


def test_a_failing_set_of_one_recipe(spark, library, tmp_path, monkeypatch):
    recipe, out = Recipe("r", "d", "q", "a"), f"{tmp_path}/one"
    prepare(spark, library, recipe, ["id"], out)
    real = training.training_set
    monkeypatch.setattr(training, "training_set", lambda *a, **k: broken(real(*a, **k)))
    with pytest.raises(Exception, match="half-way"):
        prepare(spark, library, recipe, ["id"], out)
    assert spark.read.parquet(out).count() == 24


def test_what_was_set_aside_comes_back(spark, tmp_path):
    target = f"{tmp_path}/set"
    spark.range(3).write.parquet(target)
    folders = publish.Folders(spark)
    folders.rename(target, f"{tmp_path}/_replaced/set")  # died between the two renames
    with pytest.raises(ZeroDivisionError):
        publish.publish(spark, target, lambda folder: 1 / 0)
    assert spark.read.parquet(target).count() == 3
    publish.publish(spark, target, lambda folder: spark.range(5).write.parquet(folder))
    assert spark.read.parquet(target).count() == 5 and folders.names(str(tmp_path)) == ["set"]


def test_a_failed_rename_brings_the_old_folder_back(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/set"
    spark.range(3).write.parquet(target)
    real = publish.Folders.rename

    def rename(self, source, to):
        if "_staging" in source:
            raise OSError("no")
        real(self, source, to)

    monkeypatch.setattr(publish.Folders, "rename", rename)
    with pytest.raises(OSError, match="no"):
        publish.publish(spark, target, lambda folder: spark.range(5).write.parquet(folder))
    assert spark.read.parquet(target).count() == 3


def test_sources_are_read_side_by_side(spark, tmp_path, monkeypatch):
    for name in "abcd":
        spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    together, most, lock = [], [], threading.Lock()
    real = ingest.scan

    def slow(*args, **more):
        with lock:
            together.append(1)
            most.append(len(together))
        time.sleep(0.5)
        with lock:
            together.pop()
        return real(*args, **more)

    monkeypatch.setattr(ingest, "scan", slow)
    loaded = load_all(spark, Library(str(tmp_path)), ["d", "b", "none", "c", "a", "b"], workers=3, out=f"{tmp_path}/out")
    assert max(most) == 3
    assert list(loaded.frames) == ["d", "b", "c", "a"] and list(loaded.failed) == ["none"]
    assert loaded.rows().count() == 20


def test_a_source_is_tried_again(spark, tmp_path, monkeypatch):
    spark.range(5).write.parquet(f"{tmp_path}/a")
    calls, real = [], ingest.scan

    def flaky(*args, **more):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("gone for a moment")
        return real(*args, **more)

    monkeypatch.setattr(ingest, "scan", flaky)
    assert load_all(spark, Library(str(tmp_path)), ["a"]).frames["a"].count() == 5 and len(calls) == 2


def test_a_source_that_takes_too_long_is_ended(spark, tmp_path, monkeypatch):
    for name in "ab":
        spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    real = ingest.scan

    def nap(batches):
        time.sleep(30)
        yield from batches

    def scan(spark, library, dataset_id, **more):
        df = real(spark, library, dataset_id, **more)
        return df.mapInArrow(nap, df.schema) if dataset_id == "a" else df

    monkeypatch.setattr(ingest, "scan", scan)
    began = time.time()
    loaded = load_all(spark, Library(str(tmp_path)), ["a", "b"], out=f"{tmp_path}/out", seconds=4)
    assert loaded.frames["b"].count() == 5 and "took more than 4 seconds" in loaded.failed["a"]
    assert time.time() - began < 14


def test_bad_lines_come_from_the_same_pass(spark, tmp_path):
    from pyspark.sql import types as T

    schema = {"j": T.StructType().add("id", "long"), "k": T.StructType().add("id", "long")}
    for name, text in (("j", '{"id": 1}\nnot json\n'), ("k", '{"id": 2}\n')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text(text)
    library = Library(str(tmp_path), "json")
    for _ in range(2):  # a second load replaces the first
        loaded = load_all(spark, library, ["j", "k"], schema, f"{tmp_path}/out")
        assert {n: [tuple(r) for r in df.collect()] for n, df in loaded.frames.items()} == {"j": [(1,)], "k": [(2,)]}
        assert [r._corrupt_record for r in spark.read.parquet(f"{tmp_path}/out/j.bad").collect()] == ["not json"]
        assert spark.read.parquet(f"{tmp_path}/out/k.bad").count() == 0
