"""The manifest of finished rows: exact answers from the parts that a batch touches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tunemill.plans.training import not_done
from tunemill.sources.manifest import PARTS, Manifest


def ids(df):
    return sorted(row.id for row in df.collect())


def test_a_batch_opens_the_parts_it_touches(spark, tmp_path):
    done = spark.range(40_000)
    manifest = Manifest(spark, str(tmp_path / "m"), ["id"], expected=40_000)
    manifest.record(done)
    # A batch of one per cent: new rows, and three that were done.
    batch = spark.range(40_000, 40_400).union(spark.createDataFrame([(7,), (7,), (12_345,)], "id long"))
    suspects = manifest.suspects(batch)
    assert {7, 12_345} <= set(ids(suspects)) and suspects.count() <= 4
    opened = manifest.opened(suspects)
    touched = {row.part for row in suspects.collect()}
    files = {f.rpartition("/part=")[2].partition("/")[0] for f in opened.inputFiles()}
    assert files == {str(part) for part in touched}
    assert opened.count() <= 40_000 * 0.03 and len(touched) <= PARTS * 0.02
    assert ids(manifest.not_done(batch)) == list(range(40_000, 40_400)) == ids(not_done(batch, done, "id"))
    # Nothing in the batch was done: no part is opened but for a filter's rare mistake.
    assert manifest.opened(manifest.suspects(spark.range(50_000, 50_400))).count() <= 40_000 * 0.01


def test_later_batches_nulls_and_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), ("a", 1, "again")], "k string, n int, text string")
    manifest = Manifest(spark, str(tmp_path / "m"), ["k", "n"], parts=4)
    assert manifest.not_done(rows).count() == 5  # nothing is recorded yet
    manifest.record(rows.where("text = 'x' or text = 'n'"))
    assert {r.text for r in manifest.not_done(rows).collect()} == {"y", "z", "n"}
    manifest.record(rows.where("text = 'z'"))
    manifest.record(rows.where("text = 'z'"))
    again = Manifest(spark, str(tmp_path / "m"), ["k", "n"], expected=10**9, parts=99)  # the stored shape counts
    assert (again.parts, again.blocks) == (4, manifest.blocks)
    expected = {"y", "n"}
    assert {r.text for r in again.not_done(rows).collect()} == expected
    again.compact(expected=100_000, parts=8)
    assert again.keys().count() == 2 and again.parts == 8
    assert {r.text for r in Manifest(spark, str(tmp_path / "m"), ["k", "n"]).not_done(rows).collect()} == expected
    again.record(rows.limit(0))
    assert {r.text for r in again.not_done(rows).collect()} == expected
    assert again.not_done(rows.limit(0)).count() == 0


def test_too_small_filters_change_no_answer(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), ["id"], expected=1, parts=2)
    manifest.record(spark.range(0, 60_000, 2))
    assert manifest.blocks == 1
    assert ids(manifest.not_done(spark.range(0, 1_000))) == list(range(1, 1_000, 2))


def test_filters_without_their_keys(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), ["id"], parts=4)
    manifest.record(spark.range(3))
    other = Manifest(spark, str(tmp_path / "o"), ["id"], parts=4)
    other.record(spark.range(10))
    # As if the job that records 3 to 9 had ended after the filters.
    spark.read.parquet(f"{tmp_path}/o/filters").write.mode("append").parquet(f"{tmp_path}/m/filters")
    assert ids(manifest.not_done(spark.range(10))) == list(range(3, 10))


def test_an_empty_manifest(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), ["id"])
    manifest.record(spark.range(0))
    assert ids(manifest.not_done(spark.range(3))) == [0, 1, 2]


def test_keys_of_another_type(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), ["id"])
    manifest.record(spark.range(3))
    with pytest.raises(ValueError, match="id is int, recorded as bigint"):
        manifest.not_done(spark.range(3).select(F.col("id").cast("int")))
