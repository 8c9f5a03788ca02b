"""Rows by position in any format, and slices that open only the files they need."""

import pytest
from pyspark.sql import functions as F

from tunemill.functions.extract import cut_at_stop
from tunemill.operators.positions import file_index, listed_files, with_row_index
from tunemill.operators.sampling import every_kth, rows_between, split_exact
from tunemill.queries import queries
from tunemill.sources.datasets import Library, scan

SCHEMA = "at bigint, t string"


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """2,000 rows in files of uneven size, in four formats; ``at`` is the position."""
    root = tmp_path_factory.mktemp("formats")
    for file_format in ("json", "csv", "text", "parquet"):
        start = 0
        for number, rows in enumerate([700, 1, 0, 1200, 99]):
            part = spark.range(start, start + rows, numPartitions=1).select(
                F.col("id").alias("at"), F.concat(F.lit("é, x "), F.col("id").cast("string")).alias("t")
            )
            if file_format == "text":
                part = part.select(F.col("at").cast("string").alias("value"))
            writer = part.write.option("header", True) if file_format == "csv" else part.write
            writer.format(file_format).save(f"{root}/{file_format}/part={number}")
            start += rows
    return root


def opened(spark, root, file_format):
    reader = spark.read.format(file_format)
    if file_format == "text":
        return reader.load(f"{root}/text").select(F.col("value").cast("bigint").alias("at"), "_metadata")
    return reader.schema(SCHEMA).option("header", True).load(f"{root}/{file_format}")


@pytest.mark.parametrize("file_format", ["json", "csv", "text", "parquet"])
@pytest.mark.parametrize("size", ["2000", "128m"])
def test_rows_of_any_format_are_numbered(spark, lines, file_format, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)  # files in many blocks, and whole
    try:
        df = spark.read.format(file_format).option("header", True).load(f"{lines}/{file_format}")
        if file_format != "text":
            df = spark.read.format(file_format).schema(SCHEMA).option("header", True).load(f"{lines}/{file_format}")
        at = "value" if file_format == "text" else "at"
        for options in ({}, {"broadcast_files": 0}):
            rows = with_row_index(df, **options).collect()
            assert sorted(int(r[at]) for r in rows) == list(range(2000))
            assert all(int(r[at]) == r["idx"] for r in rows)
        assert sorted(int(r[at]) for r in every_kth(df, 7).collect()) == list(range(0, 2000, 7))
        assert sorted(int(r[at]) for r in rows_between(df, 690, 710).collect()) == list(range(690, 710))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_and_blank_lines_keep_their_place(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"at": 0}\n\nnot json\n{"at": 2}\n')
    (tmp_path / "j" / "b.json").write_text('{"at": 3}\n')
    rows = with_row_index(spark.read.schema("at bigint").json(f"{tmp_path}/j")).collect()
    assert sorted((r.idx, r.at) for r in rows) == [(0, 0), (1, None), (2, 2), (3, 3)]


@pytest.fixture(scope="module")
def fifty(spark, tmp_path_factory):
    """50 files of 20 rows in train, 3 in test; a name with a blank and a plus."""
    root = tmp_path_factory.mktemp("fifty") / "a b+c"
    for split, n in (("train", 50), ("test", 3)):
        for i in range(n):
            rows = spark.range(i * 20, i * 20 + 20, numPartitions=1).withColumnRenamed("id", "at")
            rows.write.mode("append").parquet(f"{root}/d/split={split}")
    # Names of files decide the order, and Spark chooses them: give them numbers.
    for folder in root.glob("d/split=*"):
        by_row = {spark.read.parquet(str(f)).first()["at"]: f for f in folder.glob("*.parquet")}
        for at, file in by_row.items():
            file.rename(folder / f"{at:05}.parquet")
            (folder / f".{file.name}.crc").unlink(missing_ok=True)
    return root


def files_read(df):
    return len(df.inputFiles())


def test_a_slice_opens_only_its_files(spark, fifty, tmp_path):
    library = Library(str(fifty), index=f"{tmp_path}/index")
    for text, start, stop, files in (("[:10]", 0, 10, 1), ("[990:1000]", 990, 1000, 1), ("[15:45]", 15, 45, 3), ("[975:]", 975, 1000, 2)):
        df = scan(spark, library, "d", split=f"train{text}")
        assert files_read(df) == files
        assert sorted(r["at"] for r in df.collect()) == list(range(start, stop))
        assert set(df.columns) == {"at", "split"}
    assert scan(spark, library, "d", split="train[5000:]").count() == 0
    assert sorted(r["at"] for r in scan(spark, library, "d", split="test[50:70]").collect()) == list(range(50, 60))


def test_the_index_follows_the_files(spark, tmp_path):
    library = Library(str(tmp_path), index=f"{tmp_path}/index")
    spark.range(30).coalesce(1).write.parquet(f"{tmp_path}/d")
    assert scan(spark, library, "d", split="train[25:]").count() == 5
    counted = []

    def count(paths):
        counted.append(paths)
        return spark.read.parquet(*paths)

    files = listed_files(spark, f"{tmp_path}/d")
    assert file_index(files, f"{tmp_path}/index/d", count).first()["rows"] == 30 and counted == []
    spark.range(12).coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    assert {r["rows"] for r in file_index(listed_files(spark, f"{tmp_path}/d"), f"{tmp_path}/index/d", count).collect()} == {30, 12}
    assert len(counted) == 1 and len(counted[0]) == 1
    spark.range(7).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/d")
    assert scan(spark, library, "d", split="train[5:]").count() == 2


def test_json_slices_with_an_index(spark, lines, tmp_path):
    library = Library(str(lines), "json", index=f"{tmp_path}/index")
    df = scan(spark, library, "json", split="train[1895:1905]", schema=spark.range(0).selectExpr("id AS at").schema)
    assert sorted(r["at"] for r in df.collect()) == list(range(1895, 1905)) and files_read(df) == 2


@pytest.mark.parametrize("name", ["training_summary", "training_labels"])
def test_an_exact_split_reads_the_texts_twice(spark, name):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum("ReadSchema" in line and "text:" in line for line in plan.splitlines()) == 2
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_more_digits_change_nothing(spark):
    from tunemill.operators.sampling import in_sample

    df = spark.range(3000)
    ids = lambda digits: {r.id for r in df.where(in_sample(df, ["id"], 42, share=0.2, digits=digits)).collect()}
    assert ids(4) == ids(6) == ids(2) == {r.id for r in split_exact(df, ["id"]).where("split = 'test'").collect()}


def test_no_stop_string_stops_nothing(spark):
    text = spark.range(1).select(F.lit("a stop b").alias("t"))
    cut = lambda stops: text.select(cut_at_stop(F.col("t"), stops)).first()[0]
    assert cut([]) == cut([""]) == "a stop b" and cut(["", " stop"]) == "a"
