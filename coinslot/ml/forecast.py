"""Demand forecast per series: seasonal baseline and a regression on the lag features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.plans.features import SEQUENCE_FEATURES, SERIES

# Only what is known a horizon ahead: the calendar, and lags of at least HORIZON rows.
HORIZON = 28
INPUTS = [
    c for c in SEQUENCE_FEATURES
    if not c.startswith("revenue") or (c.startswith("revenue_lag_") and int(c.rsplit("_", 1)[1]) >= HORIZON)
]


def seasonal_baseline(split: DataFrame) -> DataFrame:
    """Validation rows forecast by the value one horizon (28 rows) earlier."""
    return split.filter("split = 'validation'").select(
        *SERIES, "ds", "revenue", F.col("revenue_lag_28").alias("forecast")
    )


def fit_forecast(split: DataFrame) -> PipelineModel:
    train = split.filter("split = 'train'")
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=INPUTS, outputCol="_x"),
            LinearRegression(featuresCol="_x", labelCol="revenue", predictionCol="forecast", regParam=0.1),
        ]
    ).fit(train)


def apply_forecast(model: PipelineModel, split: DataFrame) -> DataFrame:
    scored = model.transform(split.filter("split = 'validation'"))
    return scored.select(*SERIES, "ds", "revenue", F.round("forecast", 4).alias("forecast"))
