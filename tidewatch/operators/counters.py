"""Stored counters per customer, from which a profile follows without its past events.

A run counts new events only and merges these counts into a table; `profile_of` then gives what
`customer_profile` gives over all events so far. The table has, for each customer, a row for the
lifetime (counts, amounts, bits of the known event types, 24 hours, 7 weekdays), one for each
unknown event type, and one for each of the last active days. Days share `RING` places: a day
takes the place of the one `RING` days before, so the table is bounded by its customers, whatever
the number of days and events.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import schema
from tidewatch.functions.values import days_before
from tidewatch.operators import profile

RING = 128
KEYS = ["customer_id", "part"]
_WHOLE = "all"
_DAY_COUNTERS = ("total_events", "purchase_count", "page_view_count", "paid_total", "paid_rest", "paid_events")


def _counters() -> list[profile.Counter]:
    return profile._lifetime_counters() + profile._clock_counters()


def event_counters(events: DataFrame) -> DataFrame:
    """Mergeable counters of some events: at most one row for each customer and part.

    Events without a customer are left out; those without a time count for the lifetime alone.
    """
    rows = profile._clock_rows(profile._lifetime_rows(profile._event_rows(events)))
    rows = rows.withColumn("day", F.to_date("timestamp"))
    counters = _counters()
    daily = rows.groupBy("customer_id", "day", "rare_type").agg(
        *[F.expr(f"{c.value} AS {c.name}") for c in counters])

    place = F.format_string("day %03d", F.pmod(F.unix_date("day"), F.lit(RING)).cast("int"))
    parts = F.array_compact(F.array(
        F.lit(_WHOLE), F.when(F.col("day").isNotNull(), place),
        F.when(F.col("rare_type").isNotNull(), F.concat(F.lit("type "), F.col("rare_type")))))
    dealt = daily.withColumn("part", F.explode(parts))
    whole, of_day = F.col("part") == _WHOLE, F.col("part").startswith("day ")
    dealt = dealt.select(*KEYS, F.when(of_day, F.col("day")).alias("day"), *[
        F.when(whole | of_day if c.name in _DAY_COUNTERS else whole, F.col(c.name)).alias(c.name) for c in counters])
    summed = dealt.groupBy(*KEYS, "day").agg(*[F.expr(f"{c.merge}({c.name}) AS {c.name}") for c in counters])
    # Of days that share a place only the newest counts.
    newest = summed.groupBy(*KEYS).agg(F.max(F.struct("day", *[c.name for c in counters])).alias("row"))
    return newest.select(*KEYS, "row.*")


def merge_rules() -> dict[str, str]:
    """How a stored row takes in a new one, as SQL over `target` and `source`."""
    merged = {
        "sum": "coalesce(target.{0} + source.{0}, target.{0}, source.{0})",
        "bit_or": "coalesce(target.{0} | source.{0}, target.{0}, source.{0})",
        "min": "least(target.{0}, source.{0})",
        "max": "greatest(target.{0}, source.{0})",
    }

    def taken_in(c: profile.Counter) -> str:
        if c.name == "paid_total":  # a digit less, so that the sum keeps its decimals
            a, b = (f"CAST({side}.{c.name} AS DECIMAL(37,10))" for side in ("target", "source"))
            return f"coalesce({a} + {b}, target.{c.name}, source.{c.name})"
        return merged[c.merge].format(c.name)

    rules = {c.name: "CASE WHEN target.day <=> source.day THEN " + taken_in(c) + f" WHEN target.day < source.day THEN source.{c.name} ELSE target.{c.name} END" for c in _counters()}
    return {"day": "greatest(target.day, source.day)", **rules}


def _window_start(counters: DataFrame, as_of: str | datetime, days: int) -> Column:
    start = days_before(as_of, days)
    whole, = counters.sparkSession.range(1).select(start == F.date_trunc("day", start)).first()
    if not whole:
        raise ValueError("counters are kept by day: as_of must be the start of one")
    return F.to_date(start)


def profile_of(counters: DataFrame, as_of: str | datetime, days: int = schema.RECENT_DAYS) -> DataFrame:
    """The profile of every customer, equal to `customer_profile` over all counted events.

    `as_of` is the start of a day. Events more than `RING` days after the window's start may have
    taken the place of its days: that fails.
    """
    if not 0 < days < RING:
        raise ValueError(f"the window must be shorter than {RING} days")
    start = _window_start(counters, as_of, days)
    lost = F.raise_error(F.concat(F.lit("days of the window were replaced by "), F.col("day").cast("string")))
    is_recent = F.when(F.col("day") >= F.date_add(start, RING), lost.cast("boolean")).otherwise(F.col("day") >= start)
    whole, recent = F.col("part") == _WHOLE, F.col("_recent")
    rows = counters.withColumn("_recent", F.coalesce(is_recent, F.lit(False))).select(
        "customer_id",
        *[F.when(whole, F.col(c.name)).alias(c.name) for c in _counters()],
        F.when(F.col("part").startswith("type "), 1).alias("rare_type"),
        F.when(recent, 1).alias("late_day"),
        *[F.when(recent, F.col(of)).alias(name) for name, of in {
            "recent_events": "total_events", "recent_purchases": "purchase_count",
            "recent_views": "page_view_count", "recent_paid_total": "paid_total",
            "recent_paid_rest": "paid_rest", "recent_paid_events": "paid_events"}.items()])
    sums = ("recent_events", "recent_purchases", "recent_views", "recent_paid_total", "recent_paid_rest",
            "recent_paid_events")
    merged = rows.groupBy("customer_id").agg(
        *[F.expr(f"{c.merge}({c.name}) AS {c.name}") for c in _counters()],
        F.count("rare_type").alias("rare_type"), F.count("late_day").alias("late_day"),
        *[F.sum(name).alias(name) for name in sums])
    # Days are counted as rows here, so the profile's day bits stay empty.
    empty = {name: F.lit(None).cast("long") for name in profile._day_words(days)}
    merged = profile._with_moments(merged.withColumns(empty))
    return merged.select("customer_id", *profile._lifetime_columns(as_of), *profile._recent_columns(days),
                         *profile._clock_columns()).fillna(0)
