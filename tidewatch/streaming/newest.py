"""The newest prediction of every customer of a stream, kept in a versioned table.

State holds one prediction for each customer and forgets those who have had none for a while, so
it is bounded by the customers seen in that time. It keeps rows that change nothing away from the
table; the merge itself compares times again, so a late row of a forgotten customer does no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatch.sources import tables
from tidewatch.streaming.sinks import into_table

EXPIRE_HOURS = 24 * 90
NEWEST = "customer_id string, churn_probability double, prediction_date timestamp, model_version string"
_KEPT = "prediction_date timestamp, churn_probability double"

_LATER = ("source.prediction_date > target.prediction_date OR source.prediction_date = target.prediction_date"
          " AND source.churn_probability > target.churn_probability")
_RULES = {name: f"CASE WHEN {_LATER} THEN source.{name} ELSE target.{name} END"
          for name in ("churn_probability", "prediction_date", "model_version")}


class _Newest(StatefulProcessor):
    """Passes a customer's best row of a batch on if it is newer than the one in the state."""

    def __init__(self, expire_hours: float) -> None:
        self.expire_ms = int(expire_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("newest", _KEPT, self.expire_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        order = ["prediction_date", "churn_probability"]
        for batch in rows:
            top = batch.sort_values(order, na_position="first").iloc[-1:]
            if best is None or tuple(top[order].iloc[0]) > tuple(best[order].iloc[0]):
                best = top
        if best is None:
            return
        date, probability = best[order].iloc[0]
        if self.kept.exists():
            if tuple(self.kept.get()) >= (date.to_pydatetime(), float(probability)):
                return
        self.kept.update((date.to_pydatetime(), float(probability)))
        yield best.assign(customer_id=key[0])[["customer_id", "churn_probability", "prediction_date", "model_version"]]

    def close(self) -> None:
        pass


def newest_predictions(predictions: DataFrame, expire_hours: float = EXPIRE_HOURS) -> DataFrame:
    """Changes of each customer's newest prediction; the higher probability wins a tie.

    Rows without a customer, a date or a probability are left out. Needs the RocksDB state store.
    """
    usable = predictions.select("customer_id", "churn_probability", "prediction_date", "model_version").na.drop(
        subset=["customer_id", "churn_probability", "prediction_date"])
    return usable.groupBy("customer_id").transformWithStateInPandas(
        _Newest(expire_hours), NEWEST, outputMode="Update", timeMode="ProcessingTime")


def keep_newest(predictions: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                expire_hours: float = EXPIRE_HOURS) -> StreamingQuery:
    """Keep the table at `path` at each customer's newest prediction."""
    def merge(rows: DataFrame, batch: tables.Batch) -> None:
        tables.upsert(rows, path, ["customer_id"], _RULES, batch=batch)

    spark, option = predictions.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(option)
    if available_now:
        # State that may expire calls for batches without data, one after the other, for ever.
        spark.conf.set(option, "false")
    try:
        return into_table(newest_predictions(predictions, expire_hours), merge, checkpoint, available_now, "update")
    finally:
        spark.conf.set(option, before)
