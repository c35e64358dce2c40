import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, operators, plan_of, sum_of_scans
from tidewatch.operators.rolling import cohort_features, first_purchase, rolling_aggregations

DAYS = (7, 30)


def _brute_force(rows, days):
    def price(row):
        if row[2] != "purchase":
            return 0.0
        try:
            return float(row[3])
        except (TypeError, ValueError):
            return None

    results = []
    for customer, moment, kind, amount in rows:
        line = [str(customer), str(moment), str(kind), str(amount)]
        for n in days:
            frame = [other for other in rows if other[0] == customer and (
                other[1] is None if moment is None
                else other[1] is not None and moment - timedelta(days=n) <= other[1] <= moment)]
            prices = [price(other) for other in frame if price(other) is not None]
            line += [len(frame), sum(other[2] == "purchase" for other in frame),
                     round(sum(prices), 6) if prices else None]
        results.append(tuple(line))
    return sorted(results, key=str)


def _collected(frame, days):
    results = []
    for row in frame.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).collect():
        line = [str(row["customer_id"]), str(row["timestamp"]), str(row["event_type"]),
                str(row["event_data"].get("amount"))]
        for n in days:
            revenue = row[f"rolling_revenue_{n}d"]
            line += [row[f"rolling_events_{n}d"], row[f"rolling_purchases_{n}d"],
                     None if revenue is None else round(revenue, 6)]
        results.append(tuple(line))
    return sorted(results, key=str)


def _rows():
    draw = random.Random(5)
    rows = []
    for _ in range(260):
        customer = draw.choice(["busy", "busy", "a", "b", None])
        moment = datetime(2024, 1, 1) + timedelta(hours=6 * draw.randrange(0, 240))
        if draw.random() < 0.2:
            moment += timedelta(microseconds=draw.choice([-1, 1]))
        if draw.random() < 0.05:
            moment = None
        kind = draw.choice(["purchase", "login", "page_view", None])
        rows.append((customer, moment, kind, draw.choice([None, "x", "10", "2.25"])))
    rows += [("unpriced", AS_OF, "purchase", "x")]
    return rows


@pytest.mark.parametrize("busy_rows", [1_000_000, 0])
def test_no_finite_amount_is_dropped(make_events, busy_rows):
    at = lambda days: AS_OF + timedelta(days=days)
    events = make_events(("a", at(0), "purchase", "1e20"), ("a", at(1), "purchase", "1e18"),
                         ("b", at(0), "purchase", "4e-11"), ("b", at(40), "purchase", "2.5"))
    rows = rolling_aggregations(events, (7,), busy_rows).collect()
    got = sorted((r["customer_id"], r["rolling_revenue_7d"]) for r in rows)
    assert got == [("a", 1e20), ("a", 1.01e20), ("b", 4e-11), ("b", 2.5)]


@pytest.mark.parametrize("busy_rows", [1_000_000, 0])
def test_counts_and_moves_are_made_once(spark, tmp_path, busy_rows):
    path = str(tmp_path / "events")
    spark.range(1000).selectExpr(
        "CAST(id % 3 AS STRING) AS customer_id", "TIMESTAMP '2024-01-01' + make_dt_interval(0, id) AS timestamp",
        "'purchase' AS event_type", "map('amount', '1') AS event_data").write.parquet(path)
    frame = rolling_aggregations(spark.read.parquet(path), busy_rows=busy_rows, busy_parts=10 ** 9)
    assert frame.count() == 1000
    observed = rolling_aggregations(spark.read.parquet(path), busy_rows=busy_rows, busy_parts=10 ** 9)
    observed.collect()
    read = sum_of_scans(observed)
    # None busy: the counts and the events. Busy: also the ticks and the join with them.
    assert read <= (2000 if busy_rows else 3000 + 1000)


@pytest.mark.parametrize("busy_rows, slice_seconds", [
    (1_000_000, 900), (0, 900), (0, 3600), (0, 7), (60, 900)])
def test_rolling_equals_brute_force(make_events, busy_rows, slice_seconds):
    rows = _rows()
    result = rolling_aggregations(make_events(*rows), DAYS, busy_rows, slice_seconds)
    assert _collected(result, DAYS) == _brute_force(rows, DAYS)


@pytest.mark.parametrize("busy_rows", [0, 100])
def test_both_ends_of_the_window_count(make_events, busy_rows):
    end = datetime(2024, 1, 20)
    edge = end - timedelta(days=7)
    frame = rolling_aggregations(make_events(
        ("in", edge, "login", None), ("in", end, "login", None), ("in", end, "login", None),
        ("out", edge - timedelta(microseconds=1), "login", None), ("out", end, "login", None)),
        (7,), busy_rows)
    last = {row["customer_id"]: row["rolling_events_7d"] for row in frame.where(
        F.col("timestamp") == F.lit(str(end)).cast("timestamp")).collect()}
    assert last == {"in": 3, "out": 1}


def test_input_columns_are_kept_and_empty_input_works(make_events):
    events = make_events(("a", AS_OF, "login", None)).withColumn("extra", F.lit(1))
    result = rolling_aggregations(events)
    assert result.columns[:6] == events.columns
    assert len(result.columns) == 6 + 9
    assert rolling_aggregations(events.where("false")).count() == 0


def test_ordinary_customers_are_sorted_once(make_events):
    from tidewatch.operators.rolling import _by_customer
    result = _by_customer(make_events(("a", AS_OF, "login", None)), (7, 30, 90))
    assert operators(result, "Window") == 1
    assert operators(result, "Exchange") == 1
    assert operators(result, "Sort") == 1


def test_busy_customers_are_spread_over_tasks(spark):
    """One customer with a third of all events does not end up in one window task."""
    from tidewatch.operators.rolling import _moves
    ticks = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.timestamp_seconds(F.col("id") * 60 + 1704067200).alias("timestamp"),
        *[F.lit(1).alias(name) for name in ("events", "purchases", "revenue", "beyond", "priced")])
    moves = _moves(ticks.where("customer_id = 'hot'"), (7,), 900)
    largest = moves.groupBy("customer_id", "slice").count().agg(F.max("count")).first()[0]
    assert largest <= 15


@pytest.mark.parametrize("busy_rows", [0, 100])
def test_first_purchase_and_cohort(make_events, busy_rows):
    first = datetime(2024, 1, 10, 23, 59)
    events = make_events(
        ("a", datetime(2024, 1, 9), "login", None), ("a", first, "purchase", "1"),
        ("a", datetime(2024, 1, 11, 0, 1), "login", None), ("a", datetime(2024, 2, 1), "purchase", "2"),
        ("b", first, "login", None), (None, first, "purchase", "1"))
    assert {row[0] for row in first_purchase(events).collect()} == {"a", None}
    rows = sorted((str(row["customer_id"]), str(row["days_since_first_purchase"]),
                   str(row["cohort_month"])) for row in cohort_features(events, busy_rows).collect())
    assert rows == sorted([("a", "-1", "2024-01"), ("a", "0", "2024-01"), ("a", "1", "2024-01"),
                           ("a", "22", "2024-01"), ("b", "None", "None"), ("None", "None", "None")])


def test_busy_customers_join_their_cohort_without_a_shuffle(spark, tmp_path):
    """With a third of all events in one customer, no exchange carries them."""
    path = str(tmp_path / "events")
    (spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.timestamp_seconds(F.col("id") * 7 + 1704067200).alias("timestamp"),
        F.when(F.col("id") % 2 == 0, "purchase").otherwise("login").alias("event_type"))
     .write.parquet(path))
    events = spark.read.parquet(path)
    split = cohort_features(events, busy_rows=5000)
    assert "SortMergeJoin" not in plan_of(split)
    assert (sorted(map(str, split.collect()))
            == sorted(map(str, events.join(first_purchase(events), "customer_id", "left").withColumns({
                "days_since_first_purchase": F.date_diff("timestamp", "first_purchase_date"),
                "cohort_month": F.date_format("first_purchase_date", "yyyy-MM")}).collect())))
    # The largest partition of the window holds ordinary customers only.
    from tidewatch.operators.rolling import _split_busy
    ordinary, busy = _split_busy(events, 5000)
    assert (ordinary.count(), busy.count()) == (20000, 10000)


def test_many_events_at_one_instant_are_split_in_the_last_join(spark, tmp_path):
    """Half of a busy customer's events share one time; AQE cuts that join partition."""
    from tidewatch.operators.rolling import _by_slice
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    path = str(tmp_path / "events")
    (spark.range(0, 60000, 1, 8).select(
        F.lit("hot").alias("customer_id"),
        F.timestamp_seconds(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") * 7)
                            + 1704067200).alias("timestamp"),
        F.lit("login").alias("event_type"),
        F.create_map(F.lit("note"), F.md5(F.col("id").cast("string"))).alias("event_data"))
     .write.parquet(path))
    previous = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = _by_slice(spark.read.parquet(path), (7,), 900)
        assert len(result.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in plan_of(result)
    finally:
        for key, value in previous.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
