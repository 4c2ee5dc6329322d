import pytest

from tessera.operators import leveled as L


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "mid", 3), (2, "low", 1), (3, None, 5), (4, "high", 2), (5, "low", 4), (6, "odd", 9)]
    return spark.createDataFrame(rows, "id int, size string, x int")


ORDER = ["low", "mid", "high", "huge"]


def test_levels_survive_select_filter_join_and_parquet(spark, df, tmp_path):
    f = L.as_factor(df, "size", ORDER)
    assert [r["size"] for r in f.orderBy("id").collect()] == ["mid", "low", None, "high", "low", None]
    other = spark.createDataFrame([(i, i * 10) for i in range(1, 7)], "id int, y int")
    joined = f.select("id", "size").where("id <> 1").join(other, "id").orderBy("y")
    assert L.levels_of(joined, "size") == ORDER
    joined.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert L.levels_of(back, "size") == ORDER
    assert [r["id"] for r in L.sort_by_levels(back, "size").collect()][:3] in ([2, 5, 4], [5, 2, 4])
    got = {r["size"]: (r["ord"], r["n"]) for r in L.count_levels(back, "size").collect()}
    assert got == {"low": (1, 2), "mid": (2, 0), "high": (3, 1), "huge": (4, 0), None: (None, 2)}


def test_default_levels_and_changes_of_order(df):
    f = L.as_factor(df, "size")
    assert L.levels_of(f, "size") == ["high", "low", "mid", "odd"]
    assert L.levels_of(L.relevel(f, "size", ["mid"]), "size") == ["mid", "high", "low", "odd"]
    assert L.levels_of(L.reverse_levels(f, "size"), "size") == ["odd", "mid", "low", "high"]
    few = f.where("x < 4")
    assert L.levels_of(few, "size") == ["high", "low", "mid", "odd"]
    assert L.levels_of(L.drop_unused(few, "size"), "size") == ["high", "low", "mid"]
    assert {r["size"]: r["c"] for r in f.select("size", L.code(f, "size").alias("c")).collect()} == {
        "high": 1, "low": 2, "mid": 3, "odd": 4, None: None}


def test_what_must_raise_and_empty(df):
    with pytest.raises(ValueError):
        L.levels_of(df, "size")
    with pytest.raises(L.TooManyLevelsError):
        L.as_factor(df, "size", max_levels=3)
    with pytest.raises(ValueError):
        L.as_factor(df, "size", ["a", "a"])
    none = L.as_factor(df.limit(0), "size")
    assert L.levels_of(none, "size") == [] and L.count_levels(none, "size").count() == 0
    with pytest.raises(ValueError):
        L.relevel(L.as_factor(df, "size"), "size", ["new"])
