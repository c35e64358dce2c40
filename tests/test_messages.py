import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from tidewatch.operators import quality, validation
from tidewatch.sources.events import decode, encode, keys

GOOD = ('{"customer_id":"a","timestamp":"2024-01-01T00:00:00.123456","event_type":"purchase",'
        '"event_data":{"amount":12.5},"schema_version":"1.0"}')
CASES = {
    GOOD: [],
    GOOD.replace(',"schema_version":"1.0"', ""): [],
    GOOD.replace('"schema_version":"1.0"', '"schema_version":null'): ["bad_schema_version"],
    GOOD.replace('"event_type":"purchase",', ""): ["missing_event_type"],
    GOOD.replace('"purchase"', "null"): ["missing_event_type"],
    GOOD.replace('"purchase"', '"refund"'): ["bad_event_type"],
    GOOD.replace('"purchase"', '"purchases"'): ["bad_event_type"],
    GOOD.replace('"customer_id":"a"', '"customer_id":5'): [],
    GOOD.replace('"customer_id":"a"', '"customer_id":""'): ["customer_id_length"],
    GOOD.replace('"customer_id":"a"', f'"customer_id":"{"x" * 51}"'): ["customer_id_length"],
    GOOD.replace('"customer_id":"a"', f'"customer_id":"{"é" * 50}"'): [],
    GOOD.replace('"2024-01-01T00:00:00.123456"', '"bad"'): ["bad_timestamp"],
    GOOD.replace('"2024-01-01T00:00:00.123456"', "1704067200"): ["bad_timestamp"],
    GOOD.replace('"2024-01-01T00:00:00.123456"', '"2024-13-01"'): ["bad_timestamp"],
    GOOD.replace("00:00:00.123456", "00:00:00+02:00"): [],
    GOOD.replace('{"amount":12.5}', '"text"'): ["bad_event_data"],
    GOOD.replace('{"amount":12.5}', "{}"): [],
    GOOD[:-1] + ',"x":1}': ["extra_fields"],
    "garbage": ["bad_json"],
    "[1, 2]": ["bad_json"],
    "": ["bad_json"],
    '{"customer_id":5,"timestamp":"bad"}':
        ["missing_event_type", "missing_event_data", "bad_timestamp"],
}


@pytest.fixture
def messages(spark):
    return spark.createDataFrame([(text,) for text in CASES] + [(None,)], "value string")


def test_reasons(messages):
    found = {row["value"]: row["reasons"]
             for row in validation.check_messages(messages).collect()}
    assert found == {**CASES, None: ["bad_json"]}


def test_accepted_rejected_and_totals(messages):
    checked = validation.check_messages(messages)
    accepted = sum(not reasons for reasons in CASES.values())
    assert validation.valid_events(checked).count() == accepted
    assert validation.rejected_messages(checked).count() == len(CASES) + 1 - accepted
    totals = validation.validation_stats(checked).first()
    assert tuple(totals) == (accepted, len(CASES) + 1 - accepted, len(CASES) + 1)
    assert {row[0] for row in validation.valid_events(checked).select("schema_version").collect()} == {"1.0"}


def test_decode(spark):
    texts = [GOOD, "garbage", '{"customer_id":5,"timestamp":"bad"}']
    frame = spark.createDataFrame([(bytearray(text, "utf-8"), None) for text in texts],
                                  "value binary, key binary")
    good, garbage, partial = decode(frame).select(
        "*", F.col("timestamp").cast("string").alias("text")).collect()
    assert good["event_data"] == {"amount": "12.5"}
    assert good["text"] == "2024-01-01 00:00:00.123456"
    assert garbage["customer_id"] is None and garbage["event_data"] is None
    assert partial["customer_id"] == "5" and partial["timestamp"] is None
    assert keys(frame).first()["key"] is None


def test_encoded_events_are_valid_and_come_back(sample):
    whole = sample.withColumn("timestamp", F.col("timestamp") + F.expr("interval 5 microseconds"))
    for events in (sample, whole):
        checked = validation.check_messages(encode(events))
        assert validation.valid_events(checked).count() == 5
        assert (sorted(map(str, decode(encode(events)).collect()))
                == sorted(map(str, events.collect())))


def test_quality_report(make_events):
    events = make_events(
        ("a", AS_OF, "login", None), (None, AS_OF, "refund", None),
        ("x" * 51, None, None, None), ("", AS_OF, "purchase", "1"))
    report = {(row["rule"], row["column"]): (row["evaluated"], row["unexpected"], row["success"])
              for row in quality.quality_report(events, quality.EVENT_SUITE).collect()}
    assert report[("column_exists", "event_type")] == (0, 0, True)
    assert report[("not_null", "customer_id")] == (4, 1, False)
    assert report[("not_null", "timestamp")] == (4, 1, False)
    assert report[("in_set", "event_type")] == (3, 1, False)
    assert report[("length_between", "customer_id")] == (3, 2, False)
    summary = quality.quality_summary(quality.quality_report(events, quality.EVENT_SUITE)).first()
    assert (summary["success"], summary["successful_rules"], summary["unsuccessful_rules"]) == (False, 3, 4)


def test_quality_report_of_a_missing_column_and_of_no_rows(make_events):
    events = make_events(("a", AS_OF, "login", None))
    report = quality.quality_report(events.drop("event_type"), quality.EVENT_SUITE)
    failed = {(row["rule"], row["column"]) for row in report.where("not success").collect()}
    assert failed == {("column_exists", "event_type"), ("in_set", "event_type")}
    assert quality.quality_report(events.where("false"), quality.EVENT_SUITE).where("not success").count() == 0


def test_scoring_rules(spark):
    from tidewatch import schema
    columns = ["customer_id", *schema.STORED_FEATURES]
    rows = spark.createDataFrame(
        [("ok", *[1.0] * 11), ("zero", *[0.0] * 11), ("minus", *[-1.0] * 11)], columns)
    failed = {(row["column"], row["unexpected"])
              for row in quality.scoring_input_report(rows).where("not success").collect()}
    assert failed == {(name, 2 if name == "customer_lifetime_days" else 1)
                      for name in schema.STORED_FEATURES}
