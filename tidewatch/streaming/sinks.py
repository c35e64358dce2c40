"""Streaming sinks. Each query keeps its own checkpoint and resumes from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schema
from tidewatch.sources import tables
from tidewatch.streaming.features import score_messages


def append_to_table(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                    table_format: str = "parquet") -> StreamingQuery:
    """Append to a table every 30 seconds, or once through what is there."""
    writer = (stream.writeStream.format(table_format).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=schema.TRIGGER).start()


def into_table(stream: DataFrame, store: Callable[[DataFrame, tables.Batch], None], checkpoint: str,
               available_now: bool = False, mode: str = "append") -> StreamingQuery:
    """Hand each micro-batch to `store`, with the name and number under which it counts once.

    The name is the query's own, which its checkpoint keeps over restarts.
    """
    spark = stream.sparkSession

    def take(rows: DataFrame, number: int) -> None:
        store(rows, (tables.stream_name(spark, checkpoint), number))

    writer = stream.writeStream.foreachBatch(take).outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": schema.TRIGGER}
    return writer.trigger(**trigger).start()


def append_to_versions(stream: DataFrame, path: str, checkpoint: str,
                       available_now: bool = False) -> StreamingQuery:
    """Append to a versioned table, each micro-batch exactly once: its number is committed
    together with its rows, so one that is repeated after a crash adds nothing."""
    return into_table(stream, lambda rows, batch: tables.append(rows, path, batch), checkpoint, available_now)


def publish_scores(scores: DataFrame, servers: str, checkpoint: str,
                   topic: str = schema.PREDICTION_TOPIC) -> StreamingQuery:
    """Publish scores as keyed JSON messages; needs Spark's Kafka connector."""
    return (score_messages(scores).writeStream.format("kafka").outputMode("append")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
