"""The jobs a user runs: features, training, scoring, stream."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schema
from tidewatch.functions.values import instant
from tidewatch.operators.counters import KEYS, event_counters, merge_rules, profile_of
from tidewatch.operators.model import (
    LABEL, churn_labels, evaluate, load_model, model_inputs, save_model, score, train, training_set,
    training_set_as_of,
)
from tidewatch.operators.predictions import feature_lookup, prediction_rows
from tidewatch.operators.profile import customer_profile
from tidewatch.operators.rolling import cohort_features, rolling_aggregations
from tidewatch.sources.events import decode
from tidewatch.sources.tables import append, key_columns, lookup, read_table, upsert
from tidewatch.streaming.features import window_scores
from tidewatch.streaming.sinks import append_to_table, append_to_versions


def run_feature_job(events: DataFrame, table: str, as_of: str | datetime,
                    days: int = schema.RECENT_DAYS, rolling_path: str | None = None,
                    cohort_path: str | None = None, table_format: str = "parquet",
                    history: str | None = None) -> None:
    """Merge every customer's profile into the feature table.

    With paths given, the event-grain rolling and cohort features are stored as well, and the
    profiles are added to a history with the time from which they are known: once for each time.
    """
    profiles = customer_profile(events, as_of, days)
    upsert(profiles, table, ["customer_id"], table_format=table_format)
    if history is not None:
        append(profiles.withColumn("known_at", instant(as_of)), history, batch=(f"features of {as_of}", 0))
    if rolling_path is not None:
        rolling_aggregations(events).write.mode("overwrite").parquet(rolling_path)
    if cohort_path is not None:
        cohort_features(events).write.mode("overwrite").parquet(cohort_path)


def run_incremental_feature_job(new_events: DataFrame, counter_table: str, table: str, as_of: str | datetime,
                                batch: tuple[str, int], days: int = schema.RECENT_DAYS) -> None:
    """Count new events into the table of counters, and merge all profiles into the feature table.

    Past events are not read again. `batch` names the writer and numbers its batches: one that
    is counted already changes nothing, so a failed job can be run again.
    """
    spark = new_events.sparkSession
    upsert(event_counters(new_events), counter_table, KEYS, merge_rules(), batch=batch)
    profiles = profile_of(read_table(spark, counter_table), as_of, days)
    upsert(profiles, table, ["customer_id"], batch=batch)


def run_training_job(spark: SparkSession, table: str, model_path: str, training_path: str,
                     labels: DataFrame | None = None, inactive_days: int = schema.INACTIVE_DAYS,
                     exclude_label_source: bool = False,
                     settings: Mapping[str, Any] | None = None,
                     table_format: str = "parquet", history: str | None = None) -> DataFrame:
    """Store the training set, fit and store the model, and return its metrics.

    Labels with a column `labelled_at` meet, in the `history` of `run_feature_job`, the features
    that were known by then, so that no label is explained by what came after it.

    Without a label table the label is inactivity beyond `inactive_days`. That rule
    reads a model input; `exclude_label_source` leaves the input out of the model.
    """
    if history is not None:
        if labels is None or "labelled_at" not in labels.columns:
            raise ValueError("a history of features needs labels with labelled_at")
        dated = labels.select("customer_id", "labelled_at", LABEL)
        chosen = training_set_as_of(read_table(spark, history), dated, "known_at", "labelled_at")
    else:
        features = read_table(spark, table, table_format=table_format)
        chosen = training_set(features, churn_labels(features, inactive_days) if labels is None else labels)
    chosen.write.mode("overwrite").parquet(training_path)
    rows = spark.read.parquet(training_path)
    inputs: Sequence[str] = [name for name in schema.FEATURES
                             if not (exclude_label_source and name == "days_since_last_activity")]
    model = train(rows, inputs, settings)
    save_model(model, model_path)
    return evaluate(model, rows)


def run_scoring_job(spark: SparkSession, table: str, model_path: str, as_of: str | datetime,
                    store: Callable[[DataFrame], None],
                    customers: DataFrame | Iterable[str] | None = None,
                    model_version: str = schema.MODEL_VERSION,
                    table_format: str = "parquet", stored_only: bool = False) -> DataFrame:
    """Score the feature table, or the listed customers, and pass prediction rows to `store`.

    A customer gets the same score listed as in a full run. With `stored_only`, listed ones
    are scored from the features of the relational table alone; the recent ones are 0.
    """
    model = load_model(model_path)
    if customers is None:
        features = read_table(spark, table, table_format=table_format)
    else:
        columns = schema.STORED_FEATURES if stored_only else model_inputs(model)
        # A table cut by customer is read where the listed ones are.
        is_cut = table_format == "parquet" and key_columns(spark, table) == ["customer_id"]
        asked = customers if isinstance(customers, DataFrame) else list(customers)
        if isinstance(asked, DataFrame):
            asked = asked.select("customer_id")
        features = lookup(spark, table, asked) if is_cut else read_table(spark, table, table_format=table_format)
        features = feature_lookup(features, asked, columns)
    scored = score(model, features, as_of, model_version)
    store(prediction_rows(scored))
    return scored


def run_stream_job(messages: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                   table_format: str = "parquet") -> StreamingQuery:
    """Decode messages, score five-minute windows, and append them to a table.

    With `table_format="versions"` it is a versioned table, else one of Spark's own formats.
    """
    if table_format == "versions":
        return append_to_versions(window_scores(decode(messages)), path, checkpoint, available_now)
    return append_to_table(window_scores(decode(messages)), path, checkpoint, available_now,
                           table_format)
