"""Regression models, evaluation, registry and champion choice.

Training uses MLlib's distributed gradient-boosted trees (squared loss);
scoring is ``Model.transform`` — batch or inside a streaming
``foreachBatch`` — so it runs on the executors next to the data.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The feature vectors of the two model families.
TRIP_FEATURES = [
    "pickup_zone_id", "dropoff_zone_id", "trip_distance",
    "pickup_hour", "pickup_day_of_week", "pickup_month",
    "passenger_count",
    "pu_zone_avg_fare", "pu_zone_avg_duration_min", "pu_zone_avg_distance",
    "do_zone_avg_fare", "do_zone_avg_duration_min", "do_zone_avg_distance",
]
DEMAND_FEATURES = [
    "zone_id", "pickup_hour", "day_of_week", "month",
    "zone_avg_fare", "zone_avg_duration_min", "zone_avg_distance", "zone_trip_count",
]
# Boosting parameters (rounds, learning rate, seed); MLlib grows
# depth-limited trees, depth 5 is the closest to 31 leaves.
MAX_TRAIN_ROWS, MAX_TEST_ROWS = 1_000_000, 250_000     # fixed values: rows that a fit and its test read
GBT_PARAMS = {"maxIter": 200, "stepSize": 0.1, "maxDepth": 5, "seed": 42}


def train(df: DataFrame, features: list[str], label: str, max_iter: int | None = None, **params):
    """Fit ``VectorAssembler → GBTRegressor`` on ``df`` (I15). The trees are
    grown by ``boosting.fit``, from all rows and with the results of MLlib's own
    fit, which is left to parameters that ``boosting`` does not have."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from tripflow.operators import boosting
    p = {**GBT_PARAMS, **params}
    if max_iter is not None:
        p["maxIter"] = max_iter
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, lossType="squared", **p)
    rows = df.select(*features, F.col(label).cast("double").alias(label))
    if not boosting.fits(gbt, set(p)):
        return Pipeline(stages=[asm, gbt]).fit(rows)
    return PipelineModel([asm, boosting.fit(asm.transform(rows), gbt)])


def score(model, df: DataFrame, out_col: str = "prediction", decimals: int = 2) -> DataFrame:
    """Apply a fitted model and round the prediction (I17): 2 places for
    minutes and fares, 1 for demand."""
    out = model.transform(df).drop("features").withColumn("prediction", F.round("prediction", decimals))
    return out if out_col == "prediction" else out.withColumnRenamed("prediction", out_col)


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R² (E8) in one aggregate pass. The total sum of squares
    is ``n · var_pop(y)``; Spark's variance aggregate merges centred
    moments (numerically stable, no separate pass for the mean)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    agg = pred.agg(F.count(F.lit(1)).alias("n"),
                   F.avg(F.abs(e)).alias("mae"),
                   F.sqrt(F.avg(e * e)).alias("rmse"),
                   F.sum(e * e).alias("_sse"),
                   (F.var_pop(y) * F.count(y)).alias("_sst"))
    return agg.select("n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"),
                      F.round(F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")), 6).alias("r2"))


def champions(versions: DataFrame, model_col: str = "model", version_col: str = "version",
              mae_col: str = "mae") -> DataFrame:
    """Champion after each registration (I10): a new version is promoted
    when no champion exists or its MAE is strictly lower than the
    champion's — which is the minimum MAE of all earlier versions (earliest
    wins ties). Windows are per model over its (few) versions."""
    w = Window.partitionBy(model_col).orderBy(version_col)
    best_before = F.min(mae_col).over(w.rowsBetween(Window.unboundedPreceding, -1))
    promoted = best_before.isNull() | (F.col(mae_col) < best_before)
    x = versions.withColumn("promoted", promoted)
    return x.withColumn("champion_version", F.last(F.when(F.col("promoted"), F.col(version_col)),
                                                   ignorenulls=True)
                        .over(w.rowsBetween(Window.unboundedPreceding, 0)))


def log_run(spark: SparkSession, model: str, version: int, params: dict, metrics: dict,
            train_rows: int) -> DataFrame:
    """One row for the ``runs`` table (I16): parameters and metrics as maps."""
    return spark.createDataFrame(
        [(model, int(version), {k: str(v) for k, v in params.items()},
          {k: float(v) for k, v in metrics.items()}, int(train_rows), time.time())],
        "model string, version int, params map<string,string>, metrics map<string,double>, "
        "train_rows bigint, logged_at double")


def resolve_champion(registry: DataFrame, model: str) -> int | None:
    """Current champion version of a model (I18); call at the start of each
    scoring batch so a newer champion is picked up without a restart."""
    rows = (champions(registry.where(F.col("model") == model))
            .orderBy(F.col("version").desc()).select("champion_version").limit(1).collect())
    return rows[0][0] if rows else None


@dataclass(frozen=True)
class Champion:
    """A loaded champion: its model, name and version."""

    model: object
    name: str
    version: int

    def score(self, df: DataFrame, out_col: str = "prediction", decimals: int = 2) -> DataFrame:
        """``score`` with the model's name and version on each row."""
        return score(self.model, df, out_col, decimals).withColumns(
            {"model_name": F.lit(self.name), "model_version": F.lit(self.version)})


class Champions:
    """The champions of a registry, loaded from where their models were saved
    (I18): ``root/<name>/v=<version>``. Each call asks the registry, and loads
    only when the champion has changed; one model is kept for each name."""

    def __init__(self, registry: Callable[[], DataFrame], root: str):
        self._registry, self._root = registry, root.rstrip("/")
        self._loaded: dict[str, Champion] = {}

    def get(self, name: str) -> Champion | None:
        from pyspark.ml import PipelineModel
        version = resolve_champion(self._registry(), name)
        if version is None:
            return None
        have = self._loaded.get(name)
        if have is None or have.version != version:
            have = Champion(PipelineModel.load(f"{self._root}/{name}/v={version}"), name, int(version))
            self._loaded[name] = have
        return have


def model_metrics(spark: SparkSession, name: str, metrics: dict, train_rows: int) -> DataFrame:
    """A trained model's ``model_mae``, ``_rmse``, ``_r2``, ``_train_rows`` and
    ``_retrain_timestamp`` (A15), as a one-row frame for ``to_metrics``."""
    one = [(name, *(None if metrics[k] is None else float(metrics[k]) for k in ("mae", "rmse", "r2")),
            int(train_rows), int(time.time()))]
    return spark.createDataFrame(one, "model string, mae double, rmse double, r2 double, train_rows long, "
                                      "retrain_timestamp long")
