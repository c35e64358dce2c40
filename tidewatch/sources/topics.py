"""Kafka topics; needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch import schema
from tidewatch.sources.events import encode

# Publishing settings.
_PUBLISH = {
    "kafka.acks": "all",
    "kafka.retries": 3,
    "kafka.batch.size": 16384,
    "kafka.linger.ms": 100,
    "kafka.compression.type": "snappy",
}


def subscribe(spark: SparkSession, servers: str, topic: str = schema.EVENT_TOPIC,
              starting: str = "latest", **options: str | int) -> DataFrame:
    """A stream of messages; `minPartitions` may split large topic partitions."""
    return (spark.readStream.format("kafka")
            .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic,
                        "startingOffsets": starting, "failOnDataLoss": "false", **options})
            .load())


def subscribe_in_polls(spark: SparkSession, servers: str, topic: str = schema.EVENT_TOPIC,
                       group: str = schema.CONSUMER_GROUP,
                       poll_size: int = schema.POLL_SIZE,
                       batch_size: int | None = None) -> DataFrame:
    """Messages for a handler, read by a named consumer group in polls of `poll_size` records.

    Polls don't bound a micro-batch. `batch_size` does, for the whole job.
    """
    return subscribe(spark, servers, topic, **poll_options(group, poll_size, batch_size))


def poll_options(group: str, poll_size: int, batch_size: int | None = None) -> dict[str, str | int]:
    options = {"kafka.group.id": group, "kafka.max.poll.records": poll_size}
    return options if batch_size is None else {**options, "maxOffsetsPerTrigger": batch_size}


def publish_events(events: DataFrame, servers: str, topic: str = schema.EVENT_TOPIC) -> None:
    """Publish events as keyed JSON messages."""
    (encode(events).write.format("kafka")
     .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **_PUBLISH}).save())
