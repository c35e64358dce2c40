"""Five-minute customer windows with a rule score, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch import schema
from tidewatch.functions.values import is_type, mean_of, paid, paid_beyond, rule_score, total_of


def window_features(events: DataFrame, window: str = schema.WINDOW,
                    watermark: str = schema.WATERMARK) -> DataFrame:
    """Counts and mean amount per customer and window.

    On a stream the watermark bounds how late an event may be and how long a window's
    state is kept; on a table it has no effect.
    """
    return (events.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", window).alias("window"), "customer_id")
            .agg(F.count("*").alias("event_count"),
                 F.count(F.when(is_type("purchase"), 1)).alias("purchase_count"),
                 F.count(F.when(is_type("page_view"), 1)).alias("page_view_count"),
                 mean_of(total_of(F.sum(paid()), F.sum(paid_beyond())), F.count(paid()))
                 .alias("avg_purchase_amount")))


def with_rule_score(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "churn_score", rule_score(F.col("event_count"), F.col("purchase_count")))


def window_scores(events: DataFrame, window: str = schema.WINDOW,
                  watermark: str = schema.WATERMARK) -> DataFrame:
    """Window features, their rule score and the time of scoring."""
    return with_rule_score(window_features(events, window, watermark)).withColumn(
        "prediction_timestamp", F.current_timestamp())


def score_messages(scores: DataFrame) -> DataFrame:
    """Scores as keyed JSON messages."""
    return scores.select(
        F.col("customer_id").alias("key"),
        F.to_json(F.struct("customer_id", "churn_score", "prediction_timestamp")).alias("value"))
