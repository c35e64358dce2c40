"""Profiles from stored counters, against profiles over all events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import sum_of_scans
from tidewatch.operators import counters, profile
from tidewatch.plans import jobs
from tidewatch.sources import tables

MIDNIGHT = datetime(2024, 1, 31)


@pytest.fixture
def batches():
    """Three batches, out of order, with unknown types, odd amounts, no times and no customers."""
    draw = random.Random(11)
    kinds = ["purchase", "page_view", "support_ticket", "login", "logout", "refund", "", "all", None]
    rows = []
    for _ in range(900):
        moment = MIDNIGHT - timedelta(days=draw.choice([0, 1, 3, 29, 30, 31, 60, 126, -1, 90]),
                                      seconds=draw.randrange(86_400), microseconds=draw.randrange(10 ** 6))
        rows.append((draw.choice(["a", "b", "c", "day 003", None]), moment if draw.random() < 0.97 else None,
                     draw.choice(kinds), draw.choice(["1.5", "0.0000000001", "x", None, "1e30", "NaN", "12345.6789012345"])))
    return [rows[:300], rows[300:350], rows[350:]]


def _text(frame, columns):
    shown = [F.format_number(c, 6) if frame.schema[c].dataType.typeName() == "double" else F.col(c).cast("string")
             for c in columns]
    return sorted(map(str, frame.select(*shown).collect()))


def test_counted_batches_equal_one_run_over_all_events(spark, batches, make_events, tmp_path):
    state, table = str(tmp_path / "state"), str(tmp_path / "profiles")
    for number, rows in enumerate(batches):
        jobs.run_incremental_feature_job(make_events(*rows), state, table, MIDNIGHT, ("w", number))
    jobs.run_incremental_feature_job(make_events(*batches[1]), state, table, MIDNIGHT, ("w", 1))  # once more
    everything = make_events(*[row for rows in batches for row in rows])
    wanted = profile.customer_profile(everything, MIDNIGHT)
    assert _text(tables.read_table(spark, table), wanted.columns) == _text(wanted, wanted.columns)
    week = profile.customer_profile(everything, "2024-01-10", 7)
    assert _text(counters.profile_of(tables.read_table(spark, state), "2024-01-10", 7), week.columns) == _text(
        week, week.columns)


def test_a_run_reads_new_events_only(spark, batches, make_events, tmp_path):
    state = str(tmp_path / "state")
    for number, rows in enumerate(batches):
        make_events(*rows).write.parquet(f"{tmp_path}/events-{number}")
        counted = counters.event_counters(spark.read.parquet(f"{tmp_path}/events-{number}"))
        counted.collect()
        assert sum_of_scans(counted) == len(rows)
        tables.upsert(counted, state, counters.KEYS, counters.merge_rules(), batch=("w", number))
    # A row for the lifetime, one for each unknown type, and one for each of the last days.
    per_customer = tables.read_table(spark, state).groupBy("customer_id").count().agg(F.max("count")).first()[0]
    assert per_customer <= 1 + 3 + counters.RING


def test_days_share_places(spark, make_events, tmp_path):
    """A day goes when its place is needed, an older one that comes late changes only the lifetime."""
    state = str(tmp_path / "state")
    old, new = MIDNIGHT - timedelta(days=counters.RING), MIDNIGHT + timedelta(hours=5)
    events = [make_events(("a", old, "purchase", "1")), make_events(("a", new, "purchase", "2"), ("a", old, "login", None)),
              make_events(("a", old, "purchase", "4"))]
    for part in events:
        tables.upsert(counters.event_counters(part), state, counters.KEYS, counters.merge_rules())
    row = counters.profile_of(tables.read_table(spark, state), MIDNIGHT).first()
    assert (row["total_events"], row["events_last_30d"], row["total_purchase_amount"]) == (4, 1, 7.0)
    with pytest.raises(Exception, match="replaced"):
        counters.profile_of(tables.read_table(spark, state), old + timedelta(days=1), 30).collect()


def test_windows_start_with_a_day(spark, sample):
    counted = counters.event_counters(sample)
    with pytest.raises(ValueError, match="start of one"):
        counters.profile_of(counted, "2024-01-31 12:00:00")
    with pytest.raises(ValueError, match="shorter"):
        counters.profile_of(counted, MIDNIGHT, counters.RING)
    assert counters.event_counters(sample.limit(0)).count() == 0
    assert counters.profile_of(counted.limit(0), MIDNIGHT).count() == 0
