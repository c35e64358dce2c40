from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, operators, plan_of
from tidewatch.functions.values import amount, is_type
from tidewatch.operators.profile import (
    behavioral_features, customer_features, customer_profile, time_features,
)


def test_lifetime_features_of_the_sample(sample, by_customer):
    rows = by_customer(customer_features(sample, AS_OF))
    assert len(rows) == 2
    first, second = rows["customer_1"], rows["customer_2"]
    assert first["total_events"] == 3
    assert first["purchase_count"] == 1
    assert first["unique_event_types"] == 3
    assert first["total_purchase_amount"] == 100.0
    assert first["avg_purchase_amount"] == pytest.approx(100 / 3)
    assert first["days_since_last_activity"] == 1
    assert first["customer_lifetime_days"] == 5
    assert first["events_per_day"] == pytest.approx(0.6)
    assert first["purchase_frequency"] == pytest.approx(0.2)
    assert second["avg_purchase_amount"] == 25.0
    assert second["days_since_last_activity"] == 2
    assert second["customer_lifetime_days"] == 9
    assert second["events_per_day"] == pytest.approx(2 / 9)


def test_recent_features_of_the_sample(sample, by_customer):
    rows = by_customer(time_features(sample, AS_OF, 30))
    assert len(rows) == 2
    assert rows["customer_1"]["events_last_30d"] == 3
    assert rows["customer_2"]["purchases_last_30d"] == 1
    assert rows["customer_1"]["active_days_last_30d"] == 3


def test_amounts_missing_malformed_and_fractional(make_events, by_customer):
    moment = datetime(2024, 1, 30)
    rows = by_customer(customer_features(make_events(
        ("fractional", moment, "purchase", "100.5"), ("fractional", moment, "login", None),
        ("fractional", moment, "login", "7"),
        ("missing", moment, "purchase", None), ("missing", moment, "purchase", "10"),
        ("malformed", moment, "purchase", "ten"),
    ), AS_OF))
    assert rows["fractional"]["avg_purchase_amount"] == 33.5
    assert rows["missing"]["avg_purchase_amount"] == 10.0
    assert rows["missing"]["purchase_count"] == 2
    assert rows["malformed"]["total_purchase_amount"] is None


def test_recent_window_starts_at_the_exact_instant(make_events, by_customer):
    start = AS_OF - timedelta(days=30)
    rows = by_customer(time_features(make_events(
        ("at", start, "login", None), ("before", start - timedelta(microseconds=1), "login", None),
    ), AS_OF, 30))
    assert set(rows) == {"at"}


def test_clock_buckets_ties_and_single_events(make_events, by_customer):
    day = datetime(2024, 1, 29)  # a Monday
    hours = [8, 9, 17, 18, 23, 0]
    rows = by_customer(behavioral_features(make_events(
        *[("bounds", day + timedelta(hours=hour), "login", None) for hour in hours],
        ("single", datetime(2024, 1, 28, 23, 59, 59), "login", None),
        ("tie", day + timedelta(hours=20), "login", None),
        ("tie", day + timedelta(hours=4), "login", None),
        ("untimed", None, "login", None))))
    assert (rows["bounds"]["business_hours_activity"], rows["bounds"]["evening_activity"]) == (2, 2)
    assert rows["single"]["activity_time_variance"] is None
    assert rows["single"]["weekend_activity"] == 1
    assert rows["single"]["preferred_day"] == 1
    assert rows["tie"]["preferred_hour"] == 4
    assert rows["tie"]["activity_time_variance"] == pytest.approx(128 ** 0.5)
    assert rows["untimed"]["preferred_hour"] is None


def _separate(events, days):
    """The profile as three plain aggregates and two outer joins."""
    paid = F.when(is_type("purchase"), amount()).otherwise(F.lit(0))
    hour, weekday = F.hour("timestamp"), F.dayofweek("timestamp")
    mean = F.sum(paid).cast("double") / F.count(paid)
    keyed = events.where("customer_id is not null")
    lifetime = keyed.groupBy("customer_id").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("event_type").alias("unique_event_types"),
        F.count_if(is_type("purchase")).alias("purchase_count"),
        mean.alias("avg_purchase_amount"))
    recent = keyed.where(F.col("timestamp") >= F.lit(str(AS_OF - timedelta(days=days)))).groupBy(
        "customer_id").agg(
        F.count("*").alias(f"events_last_{days}d"),
        F.count_distinct(F.to_date("timestamp")).alias(f"active_days_last_{days}d"),
        mean.alias(f"avg_purchase_amount_last_{days}d"))
    clock = keyed.groupBy("customer_id").agg(
        F.mode(hour, True).alias("preferred_hour"), F.mode(weekday, True).alias("preferred_day"),
        F.round(F.stddev(hour), 9).alias("activity_time_variance"),
        F.count_if(hour.between(9, 17)).alias("business_hours_activity"),
        F.count_if(hour.between(18, 23)).alias("evening_activity"),
        F.count_if(weekday.isin(1, 7)).alias("weekend_activity"))
    return (lifetime.join(recent, "customer_id", "outer").join(clock, "customer_id", "outer")
            .fillna(0))


@pytest.mark.parametrize("days", [1, 30, 63, 64, 90, 200])
def test_profile_equals_the_separate_aggregates(make_events, by_customer, days):
    # Unknown types, late days, both at once, long gaps, NULLs.
    rows = []
    for number in range(400):
        customer = [f"c{number % 7}", "busy"][number % 3 == 0]
        kind = ["purchase", "page_view", "refund", "login", "gift", None][number % 6]
        moment = AS_OF - timedelta(hours=number * 13 - 120, minutes=number % 59)
        rows.append((customer, moment, kind, [None, "x", f"{number}.25"][number % 3]))
    rows += [("old", datetime(2020, 1, 1), "login", None), (None, AS_OF, "login", None),
             ("c1", None, "login", None), ("old", None, "gift", None)]
    events = make_events(*rows)
    expected = _separate(events, days)
    actual = customer_profile(events, AS_OF, days).select(
        *[F.round(c, 9).alias(c) if c == "activity_time_variance" else c for c in expected.columns])
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


def test_profile_matches_the_single_operators(sample, by_customer):
    whole = by_customer(customer_profile(sample, AS_OF))
    for part in (customer_features(sample, AS_OF), time_features(sample, AS_OF),
                 behavioral_features(sample)):
        for customer, row in by_customer(part).items():
            for name in part.columns:
                assert whole[customer][name] == row[name]


def test_no_finite_amount_is_dropped(make_events, by_customer):
    events = make_events(
        ("a", AS_OF, "purchase", "1000000000000000000"), ("a", AS_OF, "login", None),
        ("b", AS_OF, "purchase", "1e20"), ("b", AS_OF, "purchase", "1e20"),
        ("c", AS_OF, "purchase", "0.00000000004"), ("d", AS_OF, "purchase", "NaN"),
        ("d", AS_OF, "purchase", "Infinity"), ("d", AS_OF, "purchase", "8"))
    rows = by_customer(customer_profile(events, AS_OF))
    totals = {customer: (row["total_purchase_amount"], row["avg_purchase_amount"])
              for customer, row in rows.items()}
    assert totals == {"a": (1e18, 5e17), "b": (2e20, 1e20), "c": (4e-11, 4e-11), "d": (8.0, 8.0)}
    recent = by_customer(time_features(events, AS_OF))
    assert recent["b"]["avg_purchase_amount_last_30d"] == 1e20
    assert recent["c"]["avg_purchase_amount_last_30d"] == 4e-11


def test_empty_input(make_events):
    empty = make_events(("x", AS_OF, "login", None)).where("false")
    assert customer_profile(empty, AS_OF).count() == 0


def test_profile_needs_two_exchanges_and_no_join(spark, sample, tmp_path):
    sample.write.parquet(str(tmp_path / "events"))
    profile = customer_profile(spark.read.parquet(str(tmp_path / "events")), AS_OF)
    assert operators(profile, "Exchange") == 2
    for absent in ("Expand", "BroadcastHashJoin", "SortMergeJoin", "ObjectHashAggregate",
                   "SortAggregate"):
        assert operators(profile, absent) == 0
    assert plan_of(profile).count("FileScan") == 1


def test_recent_filter_prunes_date_partitions(spark, sample, tmp_path):
    path = str(tmp_path / "dated")
    sample.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(path)
    plan = plan_of(time_features(spark.read.parquet(path), AS_OF, 2))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "(event_date" in plan and ">= 2024-01-29)" in plan
