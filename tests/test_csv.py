"""CSV typing: default missing tokens, the lattice of types, the table of problems."""

import datetime

import pytest

from tessera.sources.csv import csv_problems, read_csv, scratch_path, stage_csv


def staged(spark, lines, name="t"):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_na_and_empty_are_missing_by_default(spark):
    path = staged(spark, ["a,b,c,d,e,f", "1,x,NA,1.5,,2020-01-02", "NA,NA,,2,,2021-12-31", " 3 , y ,true,NA,NA,"])
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "boolean", "double", "boolean", "date"]
    assert [tuple(r) for r in df.collect()] == [(1, "x", None, 1.5, None, datetime.date(2020, 1, 2)), (None, None, None, 2.0, None, datetime.date(2021, 12, 31)),
                                                (3, "y", True, None, None, None)]
    assert read_csv(spark, path, na="").schema["a"].dataType.simpleString() == "string"


def test_the_narrowest_type_of_all_rows(spark):
    path = staged(spark, ["a,b,c,d", "1,5000000000,1,2020-01-01 10:00:00", "2,1,1e3,2020-01-02", "3,2,x,2020-01-03"])
    assert [f.dataType.simpleString() for f in read_csv(spark, path).schema] == ["int", "bigint", "string", "timestamp"]


def test_problems(spark):
    lines = ["n,day,month"] + [f"{i},2024-01-01,Jan" for i in range(1, 41)]
    lines[3], lines[17], lines[40] = "three,2024-13-01,Jan", "NA,,Juni", "40.5,today,"
    path = staged(spark, lines, "p")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # several stretches of one file
    try:
        levels = {"month": ["Jan", "Feb"]}
        df = read_csv(spark, path, schema="n int, day date, month string", levels=levels)
        got = csv_problems(spark, path, "n int, day date, month string", levels=levels)
        assert spark.read.csv(path).rdd.getNumPartitions() > 1
        rows = sorted((r["row"], r["col"], r["expected"], r["actual"]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [(3, "day", "date", "2024-13-01"), (3, "n", "int", "three"), (17, "month", "value in level set", "Juni"),
                    (40, "day", "date", "today"), (40, "n", "int", "40.5")]
    assert df.count() == 40 and df.where("n is null").count() == 3 and df.where("month is null").count() == 2


def test_a_clean_file_has_no_problems(spark):
    path = stage_csv(spark.range(10).selectExpr("id", "id * 2 as b"), "clean")
    assert csv_problems(spark, path, "id bigint, b bigint").count() == 0
    assert read_csv(spark, path, schema="id bigint, b bigint").agg({"b": "sum"}).first()[0] == pytest.approx(90)
