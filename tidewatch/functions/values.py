"""Column expressions shared by batch and stream."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from tidewatch import schema

# Summing it gives DECIMAL(38,10), so totals of ordinary amounts do not depend on the
# order in which tasks finish. What doesn't fit goes into a second, floating sum.
MONEY = "decimal(28,10)"


def instant(moment: str | datetime) -> Column:
    """A timestamp literal; text and naive datetimes are in the session time zone."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp")


def days_before(moment: str | datetime, days: int) -> Column:
    """The exact instant `days` times 24 hours before `moment`."""
    return instant(moment) - F.make_dt_interval(F.lit(days))


def is_type(name: str) -> Column:
    return F.col("event_type") == name


def _finite() -> Column:
    """The amount as a double; NULL for missing and malformed text, infinities and NaN."""
    number = F.col("event_data")["amount"].try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def amount() -> Column:
    """The exact part of an event's purchase amount; missing or malformed text gives NULL.

    It is 0 for a finite amount of more digits before the point than MONEY has.
    """
    exact = F.col("event_data")["amount"].try_cast(MONEY)
    return F.when(_finite().isNotNull(), F.coalesce(exact, F.lit(0).cast(MONEY)))


def beyond() -> Column:
    """What `amount` leaves out of a finite amount, as a double: 0 for ordinary amounts, else
    the digits after MONEY's last place, or the whole of an amount too large for it."""
    number = _finite()
    exact = F.col("event_data")["amount"].try_cast(MONEY).cast("double")
    return number - F.coalesce(exact, F.lit(0.0))


def paid() -> Column:
    """The exact part of a purchase's amount, and 0 for every other event.

    Means over this column are spread over all events, not over purchases only.
    """
    return F.when(is_type("purchase"), amount()).otherwise(F.lit(0))


def paid_beyond() -> Column:
    """The rest of a purchase's amount, and 0 for every other event."""
    return F.when(is_type("purchase"), beyond()).otherwise(F.lit(0.0))


def total_of(exact: Column, rest: Column) -> Column:
    """A total of amounts from the sums of their two parts."""
    return exact.cast("double") + rest


def mean_of(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def risk_band(probability: Column) -> Column:
    return (F.when(probability >= schema.HIGH_RISK, "HIGH")
            .when(probability >= schema.MEDIUM_RISK, "MEDIUM")
            .when(probability.isNotNull(), "LOW"))


def rule_score(events: Column, purchases: Column) -> Column:
    return (F.when(events < 2, F.lit(schema.QUIET_SCORE))
            .when(purchases == 0, F.lit(schema.NO_PURCHASE_SCORE))
            .otherwise(F.lit(schema.ACTIVE_SCORE)))


def churn_label(inactive_days: int = schema.INACTIVE_DAYS) -> Column:
    return (F.col("days_since_last_activity") > inactive_days).cast("int")


def iso_text(moment: Column) -> Column:
    """ISO-8601 text with microseconds; the fraction is left out when it is zero."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))
