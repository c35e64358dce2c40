"""Per-customer features: lifetime totals, recent activity and clock habits.

All three families, and the profile that holds them together, come from the same
two steps. Step one sums events per customer with fixed-width counters, so every
map task sends at most one row per customer no matter how many events it read.
Step two merges those rows.

Distinct counts need no distinct aggregate. The known event types and the days of
the recent window are bits, merged with `bit_or`. A value without a bit (an unknown
type, a day after `as_of`) becomes a further grouping key of step one. A row never
carries two of these rare values, so step one leaves each of them exactly once per
customer and step two counts them with a plain `count`. Ordinary events carry none
and add no groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import schema
from tidewatch.functions.values import days_before, instant, mean_of, paid, paid_beyond, total_of

_WORD = 64


class Counter(NamedTuple):
    """An aggregate over events, as SQL, and the aggregate that merges partial values."""
    name: str
    value: str
    merge: str = "sum"


def _count_when(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


def _quoted(values: Sequence[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _roll_up(rows: DataFrame, counters: Sequence[Counter], rare: Sequence[str] = ()) -> DataFrame:
    """One row per customer; each `rare` column becomes its number of distinct values."""
    partial = rows.groupBy("customer_id", *rare).agg(
        *[F.expr(f"{counter.value} AS {counter.name}") for counter in counters])
    if not rare:
        return partial
    return partial.groupBy("customer_id").agg(
        *[F.expr(f"{merge}({name}) AS {name}") for name, _, merge in counters],
        *[F.expr(f"count({name}) AS {name}") for name in rare])


def _keyed(events: DataFrame) -> DataFrame:
    return events.where(F.col("customer_id").isNotNull())


def since(events: DataFrame, start: Column) -> DataFrame:
    """Events at or after `start`; an `event_date` partition column prunes files."""
    recent = events.where(F.col("timestamp") >= start)
    if "event_date" in events.columns:
        recent = recent.where(F.col("event_date") >= F.to_date(start))
    return recent


# --- lifetime -------------------------------------------------------------

def _lifetime_rows(rows: DataFrame) -> DataFrame:
    known = _quoted(schema.EVENT_TYPES)
    return rows.selectExpr(
        "*",
        f"CASE WHEN event_type IN ({known}) "
        f"THEN shiftleft(1L, CAST(array_position(array({known}), event_type) AS INT)) END AS type_bit",
        f"CASE WHEN event_type NOT IN ({known}) THEN event_type END AS rare_type")


def _lifetime_counters() -> list[Counter]:
    return [
        Counter("total_events", "count(event)"),
        Counter("type_bits", "bit_or(type_bit)", "bit_or"),
        Counter("first_event_date", "min(timestamp)", "min"),
        Counter("last_event_date", "max(timestamp)", "max"),
        Counter("purchase_count", _count_when("event_type = 'purchase'")),
        Counter("page_view_count", _count_when("event_type = 'page_view'")),
        Counter("support_ticket_count", _count_when("event_type = 'support_ticket'")),
        Counter("paid_total", "sum(paid)"),
        Counter("paid_rest", "sum(beyond)"),
        Counter("paid_events", "count(paid)"),
    ]


def _lifetime_columns(as_of: str | datetime) -> list[Column]:
    lifetime = "(date_diff(last_event_date, first_event_date) + 1)"
    paid_sum = total_of(F.col("paid_total"), F.col("paid_rest"))
    return [
        F.col("total_events"),
        F.expr("coalesce(bit_count(type_bits), 0) + rare_type AS unique_event_types"),
        F.col("first_event_date"),
        F.col("last_event_date"),
        F.col("purchase_count"),
        F.col("page_view_count"),
        F.col("support_ticket_count"),
        mean_of(paid_sum, F.col("paid_events")).alias("avg_purchase_amount"),
        paid_sum.alias("total_purchase_amount"),
        F.date_diff(instant(as_of), "last_event_date").alias("days_since_last_activity"),
        F.expr(f"{lifetime} AS customer_lifetime_days"),
        F.expr(f"try_divide(total_events, {lifetime}) AS events_per_day"),
        F.expr(f"try_divide(purchase_count, {lifetime}) AS purchase_frequency"),
    ]


def _event_rows(events: DataFrame) -> DataFrame:
    return _keyed(events).select("customer_id", "timestamp", "event_type",
                                 paid().alias("paid"), paid_beyond().alias("beyond"),
                                 F.lit(1).alias("event"))


def customer_features(events: DataFrame, as_of: str | datetime) -> DataFrame:
    """Lifetime counts, amounts, recency and rates of every customer."""
    rows = _lifetime_rows(_event_rows(events))
    merged = _roll_up(rows, _lifetime_counters(), ["rare_type"])
    return merged.select("customer_id", *_lifetime_columns(as_of))


# --- recent ---------------------------------------------------------------

def _is_late(as_of: str | datetime) -> Column:
    """After the calendar day of `as_of`, so without a place in the window's bits."""
    return F.col("timestamp") >= (F.to_date(instant(as_of)) + F.lit(1)).cast("timestamp")


def _recent_rows(rows: DataFrame, as_of: str | datetime, days: int) -> DataFrame:
    start = days_before(as_of, days)
    recent = F.col("timestamp") >= start
    return rows.withColumns({
        "recent": recent,
        "recent_paid": F.when(recent, F.col("paid")),
        "recent_beyond": F.when(recent, F.col("beyond")),
        "day_slot": F.when(recent & ~_is_late(as_of),
                           F.date_diff(F.to_date("timestamp"), F.to_date(start))),
    })


def _day_words(days: int) -> list[str]:
    # One spare day: 24-hour steps can cross one more date where clocks change.
    return [f"day_word_{word}" for word in range((days + 1) // _WORD + 1)]


def _recent_counters(days: int) -> list[Counter]:
    return [
        Counter("recent_events", _count_when("recent")),
        Counter("recent_purchases", _count_when("recent AND event_type = 'purchase'")),
        Counter("recent_views", _count_when("recent AND event_type = 'page_view'")),
        Counter("recent_paid_total", "sum(recent_paid)"),
        Counter("recent_paid_rest", "sum(recent_beyond)"),
        Counter("recent_paid_events", "count(recent_paid)"),
        *[Counter(name,
                  f"bit_or(CASE WHEN day_slot BETWEEN {word * _WORD} AND {word * _WORD + _WORD - 1} "
                  f"THEN shiftleft(1L, day_slot - {word * _WORD}) END)",
                  "bit_or")
          for word, name in enumerate(_day_words(days))],
    ]


def _recent_columns(days: int) -> list[Column]:
    marked = " + ".join(f"coalesce(bit_count({name}), 0)" for name in _day_words(days))
    return [
        F.col("recent_events").alias(f"events_last_{days}d"),
        F.col("recent_purchases").alias(f"purchases_last_{days}d"),
        F.col("recent_views").alias(f"page_views_last_{days}d"),
        F.expr(f"{marked} + late_day AS active_days_last_{days}d"),
        mean_of(total_of(F.col("recent_paid_total"), F.col("recent_paid_rest")),
                F.col("recent_paid_events"))
        .alias(f"avg_purchase_amount_last_{days}d"),
    ]


def time_features(events: DataFrame, as_of: str | datetime, days: int = schema.RECENT_DAYS) -> DataFrame:
    """Activity of the last `days` days; customers without any are absent."""
    recent = _event_rows(since(events, days_before(as_of, days)))
    rows = _recent_rows(recent, as_of, days).withColumn(
        "late_day", F.when(_is_late(as_of), F.to_date("timestamp")))
    merged = _roll_up(rows, _recent_counters(days), ["late_day"])
    return merged.select("customer_id", *_recent_columns(days))


# --- clock ----------------------------------------------------------------

_HOURS = range(24)
_WEEKDAYS = range(1, 8)


def _clock_rows(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", "hour(timestamp) AS hour", "dayofweek(timestamp) AS weekday")


def _clock_counters() -> list[Counter]:
    return [
        *[Counter(f"hour_{hour}", _count_when(f"hour = {hour}")) for hour in _HOURS],
        *[Counter(f"weekday_{day}", _count_when(f"weekday = {day}")) for day in _WEEKDAYS],
    ]


def _most_frequent(counts: Sequence[str], first: int) -> str:
    """Position of the largest count; the smallest position wins a tie."""
    listed = ", ".join(counts)
    return (f"CASE WHEN greatest({listed}) > 0 THEN "
            f"CAST(array_position(array({listed}), greatest({listed})) AS INT) - 1 + {first} END")


def _with_moments(merged: DataFrame) -> DataFrame:
    """Number, sum and sum of squares of the events' hours, from the hour counts."""
    powers = [(f"hour_{hour}", hour, hour ** 2) for hour in _HOURS]
    return merged.selectExpr(
        "*",
        f"CAST({' + '.join(name for name, _, _ in powers)} AS DOUBLE) AS hour_n",
        f"CAST({' + '.join(f'{name} * {hour}' for name, hour, _ in powers)} AS DOUBLE) AS hour_sum",
        f"CAST({' + '.join(f'{name} * {square}' for name, _, square in powers)} AS DOUBLE) "
        "AS hour_squares")


def _clock_columns() -> list[Column]:
    hours = [f"hour_{hour}" for hour in _HOURS]
    weekdays = [f"weekday_{day}" for day in _WEEKDAYS]

    def between(bounds: tuple[int, int]) -> str:
        return " + ".join(hours[bounds[0]:bounds[1] + 1])

    return [F.expr(f"{value} AS {name}") for name, value in {
        "preferred_hour": _most_frequent(hours, 0),
        "preferred_day": _most_frequent(weekdays, 1),
        "activity_time_variance":
            "CASE WHEN hour_n > 1 THEN "
            "sqrt((hour_n * hour_squares - hour_sum * hour_sum) / (hour_n * (hour_n - 1))) END",
        "business_hours_activity": between(schema.BUSINESS_HOURS),
        "evening_activity": between(schema.EVENING_HOURS),
        "weekend_activity": " + ".join(f"weekday_{day}" for day in schema.WEEKEND_DAYS),
    }.items()]


def behavioral_features(events: DataFrame) -> DataFrame:
    """Preferred hour and weekday, spread over the day, and part-of-day counts."""
    rows = _clock_rows(_keyed(events).select("customer_id", "timestamp"))
    merged = _with_moments(_roll_up(rows, _clock_counters()))
    return merged.select("customer_id", *_clock_columns())


# --- all together ---------------------------------------------------------

def customer_profile(events: DataFrame, as_of: str | datetime, days: int = schema.RECENT_DAYS) -> DataFrame:
    """All feature families of every customer in one pass, missing numbers as 0.

    Equal to joining `customer_features`, `time_features` and `behavioral_features`
    with outer joins and filling the gaps, without the joins.
    """
    # An event of a late day makes one more row, which stands for that day alone.
    late = F.when(_is_late(as_of), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = _event_rows(events).withColumn("is_day", F.explode(late))
    rows = rows.select(
        "customer_id", F.when(F.col("is_day"), F.to_date("timestamp")).alias("late_day"),
        *[F.when(~F.col("is_day"), F.col(name)).alias(name)
          for name in ("timestamp", "event_type", "paid", "beyond", "event")])
    rows = _clock_rows(_recent_rows(_lifetime_rows(rows), as_of, days))
    counters = _lifetime_counters() + _recent_counters(days) + _clock_counters()
    merged = _with_moments(_roll_up(rows, counters, ["rare_type", "late_day"]))
    return merged.select("customer_id", *_lifetime_columns(as_of), *_recent_columns(days),
                         *_clock_columns()).fillna(0)
