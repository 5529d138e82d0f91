"""The boosted trees of ``boosting.fit`` are those of MLlib's own fit."""
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tripflow.operators import boosting
from tripflow.operators import models as mdl


def rows(spark, n, parts):
    """Values that repeat, zeros, a constant, one feature twice; labels with a bend."""
    return spark.range(0, n, 1, parts).select(
        (F.col("id") * 37 % 263).cast("int").alias("a"), (F.sin("id") * 50).alias("b"), (F.col("id") % 7 * 0.1).alias("c"),
        F.lit(3.5).alias("d"), (F.sin("id") * 50).alias("e"), F.greatest(F.cos("id"), F.lit(0.0)).alias("f"),
        (F.col("id") * 37 % 263 / 9 + F.abs(F.sin("id") * 50 - 10) + F.cos(F.col("id") * 3)).alias("y"))


def trees(model):
    return model.toDebugString.split("\n")[1:]      # without its name


@pytest.mark.parametrize("n, parts, params", [
    (3000, 3, {"maxIter": 4, "maxDepth": 5}),       # candidates from all rows
    (45000, 2, {"maxIter": 3, "maxDepth": 4}),      # from a sample
    (5, 2, {"maxIter": 3, "maxDepth": 5}),          # fewer rows than bins
    (40, 1, {"maxIter": 22, "maxDepth": 3, "stepSize": 0.5, "maxBins": 8, "seed": 7}),      # past a checkpoint
])
def test_trees_equal_those_of_mllib(spark, n, parts, params):
    gbt = GBTRegressor(featuresCol="x", labelCol="y", lossType="squared", **{**mdl.GBT_PARAMS, **params})
    df = VectorAssembler(inputCols=list("abcdef"), outputCol="x").transform(rows(spark, n, parts))
    got, want = boosting.fit(df, gbt), gbt.fit(df)
    assert trees(got) == trees(want)
    assert got.treeWeights == want.treeWeights and got.featureImportances == want.featureImportances
    assert got.transform(df).select("prediction").collect() == want.transform(df).select("prediction").collect()


def test_tasks_sums_added_up_first(spark, monkeypatch):
    gbt = GBTRegressor(featuresCol="x", labelCol="y", maxIter=2, maxDepth=3, seed=42)
    df = VectorAssembler(inputCols=list("abcdef"), outputCol="x").transform(rows(spark, 3000, 3))
    want = trees(boosting.fit(df, gbt))
    monkeypatch.setattr(boosting, "DRIVER_PARTS", 2)
    assert trees(boosting.fit(df, gbt)) == want
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)        # many blocks for few tasks: dealt evenly
    dealt = boosting.fit(df, gbt)
    assert dealt.trees[0].numNodes > 7
    off = dealt.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert off == pytest.approx(gbt.fit(df).transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0])


def test_train_does_not_run_the_fit_of_mllib(spark, scratch, monkeypatch):
    """Which reads its rows in all 200 rounds at several times the cost."""
    def slow(self, dataset):
        raise AssertionError("MLlib's own fit")
    df = rows(spark, 500, 2)
    with monkeypatch.context() as m:
        m.setattr(GBTRegressor, "_fit", slow)
        model = mdl.train(df, list("abcdef"), "y", max_iter=3)
    model.save(f"{scratch}/m")
    assert mdl.score(PipelineModel.load(f"{scratch}/m"), df).collect() == mdl.score(model, df).collect()
    other = mdl.train(df, list("abcdef"), "y", max_iter=2, subsamplingRate=0.5)     # what boosting does not have
    assert other.stages[1].getNumTrees == 2


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_bad_values_and_no_rows(spark, bad):
    df = rows(spark, 30, 2)
    with pytest.raises(Exception, match="null, NaN or infinite"):
        mdl.train(df.withColumn("b", F.when(F.col("a") > 100, F.lit(bad)).otherwise(F.col("b"))), list("ab"), "y", max_iter=1)
    with pytest.raises(Exception, match="null, NaN or infinite"):
        mdl.train(df.withColumn("y", F.when(F.col("a") > 100, F.lit(bad)).otherwise(F.col("y"))), list("ab"), "y", max_iter=1)
    with pytest.raises(ValueError, match="no rows"):
        mdl.train(df.where("a < 0"), list("ab"), "y", max_iter=1)
