"""Data-quality suites: all rules of a suite in one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import schema


@dataclass(frozen=True)
class Rule:
    """A check of one column.

    `holds` maps the column to a condition; None asks only that the column exists.
    Rows with NULL are left out unless `checks_null`.
    """
    name: str
    column: str
    holds: Callable[[Column], Column] | None = None
    checks_null: bool = False


def exists(column: str) -> Rule:
    return Rule("column_exists", column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda value: value.isNotNull(), checks_null=True)


def in_set(column: str, values: Sequence[str]) -> Rule:
    return Rule("in_set", column, lambda value: value.isin(list(values)))


def length_between(column: str, low: int, high: int) -> Rule:
    return Rule("length_between", column, lambda value: F.char_length(value).between(low, high))


def at_least(column: str, low: float) -> Rule:
    return Rule("at_least", column, lambda value: value >= low)


EVENT_SUITE = [
    exists("customer_id"),
    exists("timestamp"),
    exists("event_type"),
    not_null("customer_id"),
    not_null("timestamp"),
    in_set("event_type", schema.EVENT_TYPES),
    length_between("customer_id", *schema.CUSTOMER_ID_LENGTH),
]

# Scoring input: the stored features are required, the recent ones default to 0.
SCORING_SUITE = [
    rule
    for name in ["customer_id", *schema.STORED_FEATURES]
    for rule in (exists(name), not_null(name))
] + [
    at_least(name, 1 if name == "customer_lifetime_days" else 0)
    for name in schema.FEATURES
]


def scoring_input_report(features: DataFrame) -> DataFrame:
    """The scoring rules, after the optional numbers have taken their default."""
    absent = {name: F.lit(0) for name in schema.RECENT_FEATURES if name not in features.columns}
    if absent:
        features = features.withColumns(absent)
    return quality_report(features.fillna(0, schema.RECENT_FEATURES), SCORING_SUITE)


def quality_report(rows: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows evaluated, rows that break it, and whether it holds."""
    present = set(rows.columns)
    lines, counts = [], []
    for place, rule in enumerate(suite):
        known = rule.column in present
        if known and rule.holds is not None:
            value = F.col(rule.column)
            counts += [
                (F.count("*") if rule.checks_null else F.count(value)).alias(f"seen_{place}"),
                F.count(F.when(~rule.holds(value), 1)).alias(f"broken_{place}"),
            ]
            seen, broken = F.col(f"seen_{place}"), F.col(f"broken_{place}")
            success = broken == 0
        else:
            seen = broken = F.lit(0).cast("long")
            success = F.lit(known)
        lines.append(F.struct(
            F.lit(place).alias("position"), F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column"), seen.alias("evaluated"),
            broken.alias("unexpected"), success.alias("success")))
    totals = rows.agg(*counts) if counts else rows.agg(F.count("*"))
    return totals.select(F.inline(F.array(*lines)))


def quality_summary(report: DataFrame) -> DataFrame:
    """Overall outcome of a report: success, rule totals and percentage."""
    held = F.count(F.when(F.col("success"), 1))
    return report.agg(
        (held == F.count("*")).alias("success"),
        F.count("*").alias("evaluated_rules"),
        held.alias("successful_rules"),
        (F.count("*") - held).alias("unsuccessful_rules"),
        F.try_divide(held * 100, F.count("*")).alias("success_percent"))
