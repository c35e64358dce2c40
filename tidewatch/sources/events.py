"""Event records: reading, encoding and decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch import schema
from tidewatch.functions.values import iso_text

# Activity-log types and the event types they stand for.
LOG_TYPES = {
    "view": "page_view",
    "purchase": "purchase",
    "error": "support_ticket",
    "signup": "login",
    "click": "logout",
}


def _log_type(column: Column) -> Column:
    mapped = column
    for source, target in LOG_TYPES.items():
        mapped = F.when(column == source, target).otherwise(mapped)
    return mapped


def from_activity_log(log: DataFrame, keep: Sequence[str] = (), map_types: bool = True) -> DataFrame:
    """Events from a log of (event_id, ts, user_id, event_type, value, props)."""
    event_type = F.col("event_type")
    return log.select(
        *keep,
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (_log_type(event_type) if map_types else event_type).alias("event_type"),
        F.create_map(
            F.lit("amount"), F.col("value").cast("string"),
            F.lit("k"), F.get_json_object("props", "$.k"),
        ).alias("event_data"),
        F.lit(schema.SCHEMA_VERSION).alias("schema_version"),
    )


def encode(events: DataFrame) -> DataFrame:
    """Keyed JSON messages (key, value) ready for a topic."""
    return events.select(
        F.col("customer_id").alias("key"),
        F.to_json(F.struct(
            "customer_id",
            iso_text(F.col("timestamp")).alias("timestamp"),
            "event_type",
            "event_data",
            F.lit(schema.SCHEMA_VERSION).alias("schema_version"),
        )).alias("value"),
    )


def decode(messages: DataFrame) -> DataFrame:
    """Events from messages; text that is no JSON object becomes an all-NULL row.

    The generator makes Spark parse each text once, where selecting the fields of a
    parsed column would parse it again for each field.
    """
    event = F.from_json(F.col("value").cast("string"), schema.EVENT)
    return messages.select(F.inline(F.array(event)))


def keys(messages: DataFrame) -> DataFrame:
    """Messages with their key bytes as text; a NULL key stays NULL."""
    return messages.withColumn("key", F.col("key").cast("string"))


def follow_messages(spark: SparkSession, folder: str,
                    files_per_batch: int | None = None) -> DataFrame:
    """A stream of JSON messages from text files, one per line, as they appear.

    A micro-batch takes all files that are there. With `files_per_batch` a backlog is cut
    into several, and the watermark moves between them: give it only where files arrive in
    the order of their event times, or events of the later files are dropped as late.
    """
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
