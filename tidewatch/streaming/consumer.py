"""A handler function applied to each message of a stream, with a dead-letter table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

Handler = Callable[[dict[str, Any]], None]

_OUTCOME = "value string, error string"
_PROGRESS = "processed bigint, failed bigint"


def _decoded(messages: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    return messages.select(text.alias("value"),
                           F.try_parse_json(text).isNotNull().alias("is_json"))


def _handling(handler: Handler) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    import json

    def outcome(value: str | None, is_json: bool) -> str | None:
        if value is None or not is_json:
            return "not JSON"
        try:
            handler(json.loads(value))
        except Exception as error:  # the handler is user code; any failure is a dead letter
            return f"{type(error).__name__}: {error}"
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = [outcome(*row) for row in batch.itertuples(index=False)]
            yield pd.DataFrame({"value": batch["value"], "error": errors}, dtype=object)

    return run


def apply_handler(messages: DataFrame, handler: Handler) -> DataFrame:
    """Call `handler` in the tasks, once per message; `error` is NULL where it succeeded."""
    return _decoded(messages).mapInPandas(_handling(handler), _OUTCOME)


def consume(messages: DataFrame, handler: Handler, checkpoint: str, outcomes: str,
            available_now: bool = False) -> StreamingQuery:
    """Handle a stream of messages, at least once each.

    A failing message does not stop the stream. It is kept with its error under
    `outcomes/dead_letters`, and each micro-batch leaves its totals under
    `outcomes/progress`. A repeated micro-batch replaces what it wrote before.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        # Counted on the way to the write, so that the handler runs once per message.
        totals = Observation()
        (apply_handler(batch, handler)
         .observe(totals, F.count(F.when(F.col("error").isNull(), 1)).alias("processed"),
                  F.count("error").alias("failed"))
         .where(F.col("error").isNotNull())
         .write.mode("overwrite").parquet(f"{outcomes}/dead_letters/{part}"))
        counted = totals.get
        (batch.sparkSession.createDataFrame([(counted["processed"], counted["failed"])], _PROGRESS)
         .coalesce(1).write.mode("overwrite").parquet(f"{outcomes}/progress/{part}"))

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def dead_letters(spark: SparkSession, outcomes: str) -> DataFrame:
    return spark.read.schema(f"{_OUTCOME}, batch_id bigint").parquet(f"{outcomes}/dead_letters")


def progress(spark: SparkSession, outcomes: str) -> DataFrame:
    return spark.read.schema(f"{_PROGRESS}, batch_id bigint").parquet(f"{outcomes}/progress")
