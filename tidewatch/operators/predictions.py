"""Queries over stored predictions and stored feature rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch import schema
from tidewatch.functions.values import instant, risk_band

# Key lists longer than this are joined instead of being written into the filter.
_INLINE_KEYS = 1000


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest prediction of every customer; the higher probability wins a tie."""
    newest = Window.partitionBy("customer_id").orderBy(
        F.desc("prediction_date"), F.desc("churn_probability"))
    return (predictions.withColumn("_place", F.row_number().over(newest))
            .where(F.col("_place") == 1)
            .select("customer_id", "churn_probability", "prediction_date", "model_version"))


def latest_prediction(predictions: DataFrame, customer_id: str) -> DataFrame:
    """The newest prediction of one customer."""
    return (predictions.where(F.col("customer_id") == customer_id)
            .orderBy(F.desc("prediction_date"), F.desc("churn_probability"))
            .limit(1)
            .select("customer_id", "churn_probability", "prediction_date", "model_version"))


def prediction_metrics(predictions: DataFrame, as_of: str | datetime) -> DataFrame:
    """Count, mean and high-risk count of the last hour's predictions.

    A probability counts as high risk above the threshold here, while the risk band
    starts at the threshold.
    """
    start = instant(as_of) - F.make_dt_interval(hours=F.lit(1))
    high = (F.col("churn_probability") > schema.HIGH_RISK).cast("long")
    return predictions.where(F.col("prediction_date") >= start).agg(
        F.count("*").alias("total_predictions"),
        F.avg("churn_probability").alias("avg_churn_score"),
        F.sum(F.coalesce(high, F.lit(0).cast("long"))).alias("high_risk_count"))


def with_risk_level(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("risk_level", risk_band(F.col("churn_probability")))


def feature_lookup(features: DataFrame, customers: DataFrame | Iterable[str],
                   columns: Iterable[str] = tuple(schema.STORED_FEATURES)) -> DataFrame:
    """Stored features, or the given columns of those there are, of the listed customers.

    A short list becomes a filter the source can evaluate. A table of customers is a
    semi join, broadcast by Spark only if its measured size allows.
    """
    stored = features.select("customer_id", *[c for c in columns if c in features.columns])
    if isinstance(customers, DataFrame):
        # Distinct first: repeated keys are combined before they are shuffled.
        return stored.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    wanted = list(customers)
    if len(wanted) <= _INLINE_KEYS:
        return stored.where(F.col("customer_id").isin(wanted))
    table = features.sparkSession.createDataFrame([(key,) for key in wanted], "customer_id string")
    return stored.join(table, "customer_id", "left_semi")


def prediction_rows(scored: DataFrame) -> DataFrame:
    """Scored customers in the shape of the prediction table."""
    return scored.select("customer_id", "churn_probability",
                         F.col("prediction_timestamp").alias("prediction_date"),
                         "model_version", F.lit(None).cast("string").alias("features"))


def with_prediction_defaults(rows: DataFrame, as_of: str | datetime) -> DataFrame:
    """Prediction rows with absent columns added and defaults filled in."""
    rows = _with_missing(rows, schema.PREDICTION)
    return rows.select(
        "customer_id",
        F.col("churn_probability").cast("double").alias("churn_probability"),
        F.coalesce(F.col("prediction_date"), instant(as_of)).alias("prediction_date"),
        F.coalesce(F.col("model_version"), F.lit(schema.MODEL_VERSION)).alias("model_version"),
        F.col("features").cast("string").alias("features"))


def with_feature_defaults(rows: DataFrame, as_of: str | datetime) -> DataFrame:
    """Stored feature rows with absent columns added and defaults filled in."""
    rows = _with_missing(rows, schema.STORED_FEATURE_ROW)
    numbers = [field for field in schema.STORED_FEATURE_ROW if field.name in schema.STORED_FEATURES]
    return rows.select(
        "customer_id",
        *[F.coalesce(F.col(field.name), F.lit(0)).cast(field.dataType).alias(field.name)
          for field in numbers],
        F.coalesce(F.col("last_updated"), instant(as_of)).alias("last_updated"))


def _with_missing(rows: DataFrame, shape) -> DataFrame:
    absent = {field.name: F.lit(None).cast(field.dataType)
              for field in shape if field.name not in rows.columns}
    return rows.withColumns(absent) if absent else rows
