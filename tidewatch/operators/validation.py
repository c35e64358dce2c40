"""Validation of event messages: accepted events, rejected messages, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import schema

_REQUIRED = ["customer_id", "timestamp", "event_type", "event_data"]
# Fixed value: ISO-8601 date, or date and time with optional fraction and offset.
_ISO_TIME = (r"^\d{4}-\d{2}-\d{2}"
             r"([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$")


def check_messages(messages: DataFrame) -> DataFrame:
    """Decoded events with the message text and the `reasons` to reject it.

    The text is read twice: as an event, and as a plain map of its top-level fields,
    which shows the fields an event has no place for and those that were absent. The
    generator around each step holds its result; as a plain column it would be copied
    into, and parsed again by, every expression that refers to it.
    """
    text = F.col("value").cast("string")
    read = messages.select(text.alias("value"), F.inline(F.array(F.struct(
        F.from_json(text, schema.EVENT).alias("event"),
        F.from_json(text, "map<string,string>").alias("fields")))))
    reasons = F.when(F.col("fields").isNull(), F.array(F.lit("bad_json"))).otherwise(_reasons())
    checked = read.select("*", F.explode(F.array(reasons)).alias("reasons"))
    names = [field.name for field in schema.EVENT if field.name != "schema_version"]
    version = F.when(~_has("schema_version"), F.lit(schema.SCHEMA_VERSION)).otherwise(
        F.col("event.schema_version"))
    return checked.select(*[F.col(f"event.{name}").alias(name) for name in names],
                          version.alias("schema_version"), "value", "reasons")


def _has(name: str) -> Column:
    return F.coalesce(F.map_contains_key("fields", F.lit(name)), F.lit(False))


def _reasons() -> Column:
    event, fields = F.col("event"), F.col("fields")
    given = {name: fields[name].isNotNull() for name in _REQUIRED}
    known = F.array(*[F.lit(field.name) for field in schema.EVENT])
    failures = [(~given[name], f"missing_{name}") for name in _REQUIRED]
    failures += [
        (given["customer_id"]
         & ~F.char_length(event["customer_id"]).between(*schema.CUSTOMER_ID_LENGTH),
         "customer_id_length"),
        (given["timestamp"]
         & (event["timestamp"].isNull() | ~fields["timestamp"].rlike(_ISO_TIME)),
         "bad_timestamp"),
        (given["event_type"] & ~event["event_type"].isin(schema.EVENT_TYPES), "bad_event_type"),
        (given["event_data"] & event["event_data"].isNull(), "bad_event_data"),
        (_has("schema_version") & fields["schema_version"].isNull(), "bad_schema_version"),
        (F.size(F.array_except(F.map_keys(fields), known)) > 0, "extra_fields"),
    ]
    return F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for failed, reason in failures]))


def valid_events(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("value", "reasons")


def rejected_messages(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0).select("value", "reasons")


def _totals() -> list[Column]:
    failed = F.size("reasons") > 0
    return [F.count(F.when(~failed, 1)).alias("valid_events"),
            F.count(F.when(failed, 1)).alias("validation_errors"),
            F.count("*").alias("total_processed")]


def validation_stats(checked: DataFrame) -> DataFrame:
    return checked.agg(*_totals())


def observe_validation(checked: DataFrame, name: str = "validation") -> DataFrame:
    """The same messages; a stream reports the totals of each micro-batch in its
    progress, under `observedMetrics` and `name`, at no extra pass."""
    return checked.observe(name, *_totals())
