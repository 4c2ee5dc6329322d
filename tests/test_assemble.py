"""Predictors as one vector: the values, their compression and what the column says about them are the plain assembler's."""

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from tessera.ml import recipe


def test_vector_and_metadata_are_the_plain_assemblers(spark):
    d = spark.range(50).select("id", (F.col("id") % 3).cast("string").alias("g"), *[(F.col("id") % (k + 2) == 0).alias(f"x{k}") for k in range(40)],
                               (F.col("id") / 7).alias("y"))
    d = StringIndexer(inputCols=["g"], outputCols=["g_ix"], handleInvalid="keep").fit(d).transform(d).drop("g")
    got = recipe.AssemblePredictors(exclude=["id"]).transform(d)
    cols = [c for c in d.columns if c != "id"]
    num = d.select("id", *[F.col(c) if c in ("y", "g_ix") else F.col(c).cast("double").alias(c) for c in cols])
    want = VectorAssembler(inputCols=cols, outputCol="features").transform(num)
    a, b = [{r["id"]: r["features"] for r in x.collect()} for x in (got, want)]
    assert a == b and {type(v) for v in a.values()} == {type(v) for v in b.values()} == {DenseVector, SparseVector}
    assert got.schema["features"].metadata == want.schema["features"].metadata and got.columns == want.columns


def test_many_columns_do_not_go_through_the_assembler_one_by_one(spark):
    d = spark.range(5).select("id", *[F.rand(k).alias(f"x{k}") for k in range(70)])
    plan = recipe.AssemblePredictors(exclude=["id"]).transform(d)._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(struct(x0" not in plan


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_a_missing_predictor_is_an_error(spark, bad):
    d = spark.createDataFrame([(1, 2.0, 1.0), (2, bad, 1.0)], "id long, a double, b double")
    with pytest.raises(Exception, match="missing"):
        recipe.AssemblePredictors(exclude=["id"]).transform(d).select("features").collect()
