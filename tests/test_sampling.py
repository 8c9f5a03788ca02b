import hashlib
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunemill.operators import sampling
from tunemill.operators.filters import filter_equals
from tunemill.operators.sampling import (
    every_kth,
    first_rows,
    rows_between,
    split_exact,
    split_exact_by,
    split_hash,
    take_hashed,
    with_row_index,
)
from tunemill.sources.datasets import Library, scan


def order(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 4, 5, 11, 3000])
def test_exact_counts(spark, n):
    rows = split_exact(spark.range(n), ["id"]).collect()
    test = {r.id for r in rows if r.split == "test"}
    assert len(rows) == n
    assert test == set(sorted(range(n), key=order)[: math.ceil(0.2 * n)])


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_other_shares(spark, share):
    rows = split_exact(spark.range(100), ["id"], seed=1, test_share=share).filter("split = 'test'")
    assert rows.count() == 100 * share


def test_split_depends_on_seed_and_not_on_partitions(spark):
    def test_ids(df, seed):
        return {r.id for r in split_exact(df, ["id"], seed).filter("split = 'test'").collect()}

    assert test_ids(spark.range(500), 1) == test_ids(spark.range(500).repartition(7, F.rand()), 1)
    assert test_ids(spark.range(500), 1) != test_ids(spark.range(500), 2)


@pytest.mark.parametrize("broadcast_groups", [100, 0])
def test_exact_split_in_groups(spark, monkeypatch, broadcast_groups):
    monkeypatch.setattr(sampling, "BROADCAST_GROUPS", broadcast_groups)
    # One group holds most rows.
    df = spark.range(2000).withColumn("g", F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7))
    rows = split_exact_by(df, "g", 4, ["id"]).collect()
    assert len(rows) == 2000
    for group in {r.g for r in rows}:
        members = [r.id for r in rows if r.g == group]
        test = {r.id for r in rows if r.g == group and r.split == "test"}
        assert test == set(sorted(members, key=order)[: math.ceil(0.2 * len(members))])


def test_hash_split(spark):
    rows = split_hash(spark.range(1000), ["id"]).collect()
    assert all((r.split == "test") == (int(order(r.id)[:8], 16) % 100 < 20) for r in rows)


@pytest.mark.parametrize("n", [0, 1, 17, 1000])
def test_take_hashed(spark, n):
    taken = {r.id for r in take_hashed(spark.range(100), ["id"], n).collect()}
    assert taken == set(sorted(range(100), key=order)[:n])


def test_first_rows(spark):
    assert [r.id for r in first_rows(spark.range(50).orderBy(F.rand()), 3, "id").collect()] == [0, 1, 2]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """A table of five files with 0, 1 or more rows; ``at`` is the position over all of them."""
    root = tmp_path_factory.mktemp("files")
    paths, start = [], 0
    for number, rows in enumerate([40, 1, 0, 137, 22]):
        part = spark.range(start, start + rows, numPartitions=1).withColumnRenamed("id", "at")
        paths.append(f"{root}/{number}")
        part.withColumn("lang", F.when(F.col("at") % 2 == 0, "x").otherwise("y")).write.parquet(paths[-1])
        start += rows
    return spark.read.parquet(*paths)


@pytest.mark.parametrize("options", [{}, {"broadcast_files": 0, "block_rows": 7}])
def test_row_index_over_files(spark, files, options):
    rows = with_row_index(files, **options).collect()
    assert sorted(r.at for r in rows) == list(range(200))
    assert all(r.at == r.idx for r in rows)


def test_rows_between(files):
    for start, stop in ((0, 10), (35, 45), (100, None), (0, 0), (190, 900)):
        made = sorted(r.at for r in rows_between(files, start, stop).collect())
        assert made == list(range(200))[start:stop]


def test_every_kth_comes_before_filters(spark, files):
    df = filter_equals(every_kth(files, 3), "lang", "x")
    assert sorted(r.at for r in df.collect()) == [i for i in range(0, 200, 3) if i % 2 == 0]
    assert every_kth(files, 1).count() == 200


def test_scan_prunes_partitions(spark, tmp_path):
    rows = spark.range(30).select(
        "id",
        F.element_at(F.array(*map(F.lit, ("a.1", "b.2", "c.3"))), (F.col("id") % 3 + 1).cast("int")).alias("config"),
        F.when(F.col("id") < 20, "train").otherwise("test").alias("split"),
    )
    rows.write.partitionBy("config", "split").parquet(f"{tmp_path}/who/data")
    library = Library(str(tmp_path))
    df = scan(spark, library, "who/data", config="b.2")
    assert sorted(r.id for r in df.collect()) == [i for i in range(20) if i % 3 == 1]
    assert scan(spark, library, "who/data", split="test").count() == 10
    assert scan(spark, library, "who/data", config="b.2", split="train[:3]").count() == 3
    assert scan(spark, library, "who/data", config="b.2", split="train[5:]").count() == df.count() - 5
    with pytest.raises(ValueError):
        scan(spark, library, "who/data", split="train[:10%]")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(config" in plan
    assert every_kth(df, 2).count() == math.ceil(df.count() / 2)


def test_scan_of_other_formats(spark, tmp_path):
    for file_format in ("json", "csv", "orc"):
        writer = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string").write
        if file_format == "csv":
            writer = writer.option("header", True)
        writer.format(file_format).save(f"{tmp_path}/{file_format}/set")
        library = Library(f"{tmp_path}/{file_format}", file_format)
        df = scan(spark, library, "set", schema=spark.createDataFrame([], "n int, s string").schema)
        assert sorted(map(tuple, df.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(PySparkException):
        scan(spark, library, "nothing")
    with pytest.raises(ValueError):
        scan(spark, Library(f"{tmp_path}/orc", "orc"), "set", config="en")


@pytest.mark.parametrize(
    ("name", "value", "found"),
    [
        ("s", 0, [1]),
        ("s", "x", [2]),
        ("n", "0", [1]),
        ("n", 0.5, []),
        ("n", "many", []),
        ("n", 5.0, [2]),
        ("b", True, [1]),
        ("b", "true", [1]),
    ],
)
def test_filter_literals(spark, name, value, found):
    df = spark.createDataFrame([(1, "0", 0, True), (2, "x", 5, False), (3, None, None, None)], "i int, s string, n int, b boolean")
    assert [r.i for r in filter_equals(df, name, value).collect()] == found
    with pytest.raises(ValueError):
        filter_equals(df, "missing", 1)
