"""Churn: a logistic model on the player features, scored by an expression or, if opaque, by a pandas UDF."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.functions.expr import risk_band

# Recency is left out when training: the label is a threshold on it.
TRAIN_ON = ["tenure_days", "purchase_count", "avg_order_value", "digital_share", "platforms_used", "log_ltv", "mrr"]
SCORE_ON = ["recency_days", "tenure_days", "log_ltv"]


@dataclass(frozen=True)
class LogisticWeights:
    intercept: float
    recency_days: float
    tenure_days: float
    log_ltv: float


def score_churn(features: DataFrame, weights: LogisticWeights) -> DataFrame:
    """Scores of a logistic model as a column expression; a missing feature gives no score."""
    z = F.lit(weights.intercept)
    for column in SCORE_ON:
        z = z + F.lit(getattr(weights, column)) * F.col(column)
    scored = features.withColumn("churn_probability", F.round(1.0 / (1.0 + F.exp(-z)), 6))
    return scored.withColumn("risk_band", risk_band("churn_probability"))


def score_with(features: DataFrame, predict: Callable[..., pd.Series], columns: list[str]) -> DataFrame:
    """Scores of an opaque model: ``predict`` gets the feature columns of an Arrow batch as series."""
    probability = F.pandas_udf(predict, "double")
    scored = features.withColumn("churn_probability", F.round(probability(*columns), 6))
    return scored.withColumn("risk_band", risk_band("churn_probability"))


def holdout(features: DataFrame, since: str = "tenure_days", share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Training and holdout rows by time: the newest players (least tenure) are held out."""
    cut = features.agg(F.percentile_approx(since, share)).first()[0]
    newest = F.coalesce(F.col(since) <= F.lit(cut), F.lit(True))
    return features.filter(~newest), features.filter(newest)


def fit_churn(features: DataFrame, columns: list[str] | None = None) -> PipelineModel:
    """Missing features take the training median, so no player is left out of the scores."""
    columns = columns or TRAIN_ON
    features = features.withColumns({c: F.col(c).cast("double") for c in columns})
    return Pipeline(
        stages=[
            Imputer(inputCols=columns, outputCols=[f"_{c}" for c in columns], strategy="median"),
            VectorAssembler(inputCols=[f"_{c}" for c in columns], outputCol="_raw", handleInvalid="error"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True),
            LogisticRegression(featuresCol="_scaled", labelCol="is_churned", regParam=0.01),
        ]
    ).fit(features)


def apply_churn(model: PipelineModel, features: DataFrame) -> DataFrame:
    typed = features.withColumns({c: F.col(c).cast("double") for c in TRAIN_ON if c in features.columns})
    scored = model.transform(typed).withColumn(
        "churn_probability", F.round(vector_to_array("probability")[1], 6)
    )
    return scored.select(*features.columns, "churn_probability", risk_band("churn_probability").alias("risk_band"))
