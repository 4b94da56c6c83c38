"""Train, predict and publish: a model and its priced scores as versions that replace each other whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.trees import Settings
from ..sources.publish import publish, read_published
from . import boosting, models, training


def train(
    rows: DataFrame, root: str, features: list[str], categorical: list[str], target: str, keys: list[str],
    settings: Settings = Settings(), train_tenths: int = 8,
) -> int:
    """Fit the leaf-wise booster on a stable share of the rows, and publish it with its errors on the others."""
    fitted, held = models.split(rows, F.concat_ws("|", *keys), train_tenths)
    model = boosting.fit(fitted, held, features, categorical, target, keys, settings)
    return publish_model(model, models.evaluate(boosting.predict(model, held), target), target, root)


def publish_model(model: boosting.Booster, errors: DataFrame, target: str, root: str) -> int:
    """The trees are written before the row that names their folder, so predicting never meets half a model."""
    folder = f"{root}/models/{uuid.uuid4().hex}"
    boosting.save(model, folder)
    return publish(errors.withColumn("folder", F.lit(folder)).withColumn("target", F.lit(target)), f"{root}/model")


def predict(spark: SparkSession, score: DataFrame, prices: DataFrame, root: str, base: str = "p_qty_bl", version: int | None = None) -> int:
    """Score with the newest published model, put intervals and prices beside the scores, and publish the rows."""
    evaluation = read_published(spark, f"{root}/model", version)
    entry = evaluation.select("folder", "target").first()
    scored = boosting.predict(boosting.load(spark, entry.folder), score)
    bounded = models.with_intervals(scored, evaluation.drop("folder", "target"), entry.target, base)
    return publish(training.price_results(bounded, prices), f"{root}/scores")
