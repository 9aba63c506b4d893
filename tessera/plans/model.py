"""The match classifier: boosted trees over the 28 features, a threshold, and their storage."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.evaluation import best_threshold, sweep
from tessera.operators.features import COLUMNS
from tessera.operators.sampling import with_fold
from tessera.plans.trees import Trees, fit_trees

DEFAULT_THRESHOLD = 0.4


def held(df: DataFrame) -> DataFrame:
    """The same rows, worked once, with a short plan: in the checkpoint folder, or kept by Spark where there is none."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


@dataclass
class TreeSettings:
    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    least: int = 20
    columns: float = 0.8
    rows: float = 0.8
    folds: int = 5
    seed: int = 42


@dataclass
class MatchModel:
    model: Trees
    threshold: float = DEFAULT_THRESHOLD

    def probabilities(self, features: DataFrame) -> DataFrame:
        """M5, M7: `probability` beside the features' other columns."""
        model = self.model

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            return pd.Series(model.probabilities([c.to_numpy(np.float32) for c in columns]))

        return features.drop("probability").withColumn("probability", probability(*[F.col(c).cast("float") for c in COLUMNS]))

    def save(self, path: str) -> None:
        """K5: the model's folder and a line of JSON with the threshold."""
        spark = SparkSession.active()
        spark.createDataFrame([(self.model.text(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
        spark.createDataFrame([(json.dumps({"threshold": self.threshold}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @staticmethod
    def load(path: str, threshold: float | None = None) -> MatchModel:
        """The caller's threshold, else the stored one, else 0.4."""
        spark = SparkSession.active()
        model = Trees.of(spark.read.text(f"{path}/model", wholetext=True).first()["value"])
        try:
            stored = json.loads(spark.read.text(f"{path}/settings").first()["value"]).get("threshold")
        except Exception as e:  # a bare model
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = None
        return MatchModel(model, threshold if threshold is not None else stored if stored is not None else DEFAULT_THRESHOLD)

    def importances(self) -> DataFrame:
        """Features by falling importance."""
        return SparkSession.active().createDataFrame(sorted(zip(COLUMNS, self.model.gains), key=lambda x: (-x[1], x[0])), "feature string, importance double")


def fit(features: DataFrame, settings: TreeSettings) -> Trees:
    """M4: boosted trees on label, both classes weighing the same."""
    return fit_trees(features, COLUMNS, settings)


def out_of_fold(features: DataFrame, settings: TreeSettings) -> DataFrame:
    """M3, M5: each pair's probability from a model that saw no pair of its record."""
    dealt = with_fold(features, "s1_id", settings.folds).persist()
    parts = None
    for k in range(settings.folds):
        model = MatchModel(fit(dealt.where(F.col("fold") != k), settings))
        part = model.probabilities(dealt.where(F.col("fold") == k)).select("s1_id", "target_id", "label", "fold", "probability")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def train(features: DataFrame, truth: DataFrame, settings: TreeSettings | None = None) -> tuple[MatchModel, DataFrame]:
    """The model of all pairs with the threshold that does best out of fold, and the sweep."""
    settings = settings or TreeSettings()
    swept = sweep(out_of_fold(features, settings), truth)
    return MatchModel(fit(features, settings), best_threshold(swept)), swept
