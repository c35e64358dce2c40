"""Time the plain forms of three operators against the ones in this repository.

`python tools/compare_forms.py [sf_dir] [copies] [name]`: with `copies`, every customer
is repeated that many times, which scales the events without changing their pattern;
with `name`, only the forms whose name contains it are timed.
"""

import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Window, functions as F

from tidewatch import schema
from tidewatch.functions.values import days_before, is_type, paid
from tidewatch.operators import profile, rolling
from tidewatch.session import build_session, scratch_path
from tidewatch.sources.events import from_activity_log

AS_OF = "2024-01-31"


def plain_profile(events):
    """Three aggregates and two outer joins."""
    def count(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    price = paid().cast("double")
    lifetime = events.groupBy("customer_id").agg(
        F.count("*"), F.count_distinct("event_type"), F.min("timestamp"), F.max("timestamp"),
        count(is_type("purchase")), count(is_type("page_view")), count(is_type("support_ticket")),
        F.avg(price), F.sum(price))
    recent = events.where(F.col("timestamp") >= days_before(AS_OF, 30)).groupBy("customer_id").agg(
        F.count("*"), count(is_type("purchase")), count(is_type("page_view")),
        F.count_distinct(F.date_format("timestamp", "yyyy-MM-dd")), F.avg(price))
    hour, weekday = F.hour("timestamp"), F.dayofweek("timestamp")
    clock = events.groupBy("customer_id").agg(
        F.mode(hour, True), F.mode(weekday, True), F.stddev(hour), count(hour.between(9, 17)),
        count(hour.between(18, 23)), count(weekday.isin(1, 7)))
    return lifetime.join(recent, "customer_id", "outer").join(clock, "customer_id", "outer")


def plain_rolling(events):
    """Three columns per window size, added one after the other."""
    for days in schema.ROLLING_DAYS:
        frame = (Window.partitionBy("customer_id").orderBy(F.unix_micros("timestamp"))
                 .rangeBetween(-days * 86400 * 10 ** 6, 0))
        events = (events.withColumn(f"events_{days}", F.count("*").over(frame))
                  .withColumn(f"purchases_{days}", F.sum(F.when(is_type("purchase"), 1).otherwise(0)).over(frame))
                  .withColumn(f"revenue_{days}", F.sum(paid().cast("double")).over(frame)))
    return events


def cohort_by_window(events):
    """The first purchase as a window over the whole customer."""
    first = F.min(F.when(is_type("purchase"), F.col("timestamp"))).over(
        Window.partitionBy("customer_id"))
    return events.withColumn("first_purchase_date", first).withColumns({
        "days_since_first_purchase": F.date_diff("timestamp", "first_purchase_date"),
        "cohort_month": F.date_format("first_purchase_date", "yyyy-MM")})


def main(sf_dir="/root/testdata/sf0.1", copies="1", only=""):
    spark = build_session(spark__master="local[8]", spark__sql__shuffle__partitions="16",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    log = spark.read.parquet(f"{sf_dir}/events.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(int(copies) - 1)))
    path = scratch_path(spark, "events")
    repeated = log.withColumn("copy", copy).withColumn(
        "user_id", F.col("user_id") * int(copies) + F.col("copy"))
    from_activity_log(repeated).repartition(16).write.parquet(path)
    events = spark.read.parquet(path)
    print("events", events.count(), flush=True)
    forms = {
        "customer_profile plain": lambda: plain_profile(events),
        "customer_profile": lambda: profile.customer_profile(events, AS_OF),
        "rolling plain": lambda: plain_rolling(events),
        "rolling": lambda: rolling.rolling_aggregations(events),
        "rolling by slice": lambda: rolling.rolling_aggregations(events, busy_rows=0),
        "cohort by window": lambda: cohort_by_window(events),
        "cohort": lambda: rolling.cohort_features(events),
    }
    for name, form in forms.items():
        if only not in name or (name == "rolling by slice" and int(copies) > 10):
            continue
        times = []
        for _ in range(4):
            started = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        print(f"{name}: first {times[0]:.2f} s, median of next three "
              f"{statistics.median(times[1:]):.2f} s", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
