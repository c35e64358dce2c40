import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidewatch import schema
from tidewatch.operators import predictions, validation
from tidewatch.plans.jobs import run_stream_job
from tidewatch.sources import tables
from tidewatch.sources.events import decode, encode, follow_messages
from tidewatch.streaming import consumer, newest, sinks
from tidewatch.streaming.features import score_messages, window_features, window_scores, with_rule_score

NOON = datetime(2024, 1, 1, 12)


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "checkpoint", "outcomes")}


@pytest.fixture
def send(make_events, folders):
    def write(*rows):
        encode(make_events(*rows)).select("value").coalesce(1).write.mode("append").text(folders["in"])

    return write


def _run(spark, folders):
    run_stream_job(follow_messages(spark, folders["in"]), folders["out"], folders["checkpoint"],
                   available_now=True).awaitTermination()
    frame = spark.read.parquet(folders["out"])
    return {(row["start"], row["customer_id"]): row["event_count"] for row in frame.select(
        F.date_format("window.start", "HH:mm").alias("start"), "customer_id", "event_count").collect()}


def test_windows_close_once_and_late_events_are_dropped(spark, folders, send):
    at = lambda minutes: NOON + timedelta(minutes=minutes)
    send(("a", at(1), "login", None), ("a", at(4), "login", None), ("a", at(12), "login", None),
         ("b", at(16), "login", None))
    # 12:16 less ten minutes: the window ending 12:05 is closed, the one from 12:10 is not.
    assert _run(spark, folders) == {("12:00", "a"): 2}
    # Late for the closed window, in time for the open one; 12:40 closes both.
    send(("a", at(2), "login", None), ("a", at(13), "login", None), ("c", at(40), "login", None))
    assert _run(spark, folders) == {("12:00", "a"): 2, ("12:10", "a"): 2, ("12:15", "b"): 1}


def test_restart_repeats_nothing(spark, folders, send):
    send(("a", NOON, "login", None), ("b", NOON + timedelta(hours=1), "login", None))
    first = _run(spark, folders)
    assert _run(spark, folders) == first
    assert spark.read.parquet(folders["out"]).count() == len(first) == 1


def test_window_scores(make_events):
    scores = window_scores(make_events(
        ("quiet", NOON, "purchase", "4"),
        ("window", NOON, "login", None), ("window", NOON + timedelta(minutes=5), "login", None),
        ("browsing", NOON, "page_view", None), ("browsing", NOON + timedelta(seconds=299), "login", None),
        ("buying", NOON, "purchase", "x"), ("buying", NOON, "purchase", "9"), ("buying", NOON, "login", None)))
    rows = {(row["customer_id"], row["event_count"]): row for row in scores.collect()}
    assert rows[("quiet", 1)]["churn_score"] == schema.QUIET_SCORE
    assert rows[("window", 1)]["churn_score"] == schema.QUIET_SCORE
    assert rows[("browsing", 2)]["churn_score"] == schema.NO_PURCHASE_SCORE
    assert rows[("buying", 3)]["churn_score"] == schema.ACTIVE_SCORE
    assert rows[("buying", 3)]["avg_purchase_amount"] == 4.5
    assert scores.columns == ["window", "customer_id", "event_count", "purchase_count",
                              "page_view_count", "avg_purchase_amount", "churn_score",
                              "prediction_timestamp"]
    message = score_messages(scores.where("customer_id = 'quiet'")).first()
    assert message["key"] == "quiet"
    assert list(json.loads(message["value"])) == ["customer_id", "churn_score", "prediction_timestamp"]


def test_decoded_stream_is_appended(spark, folders, send):
    send(("a", NOON, "login", None), ("b", NOON, "purchase", "1"))
    stream = decode(follow_messages(spark, folders["in"]))
    sinks.append_to_table(stream, folders["out"], folders["checkpoint"], available_now=True).awaitTermination()
    assert spark.read.parquet(folders["out"]).count() == 2


def _only_logins():
    # A nested function travels to the workers by value; they cannot import this file.
    def handle(message):
        if message["event_type"] != "login":
            raise ValueError("not a login")

    return handle


def test_failing_messages_become_dead_letters(spark, folders, send):
    send(("a", NOON, "login", None), ("b", NOON, "purchase", "1"))
    spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(folders["in"])

    def run():
        consumer.consume(follow_messages(spark, folders["in"]), _only_logins(), folders["checkpoint"],
                         folders["outcomes"], available_now=True).awaitTermination()

    run()
    letters = consumer.dead_letters(spark, folders["outcomes"])
    assert {row["error"] for row in letters.collect()} == {"ValueError: not a login", "not JSON"}
    totals = consumer.progress(spark, folders["outcomes"])
    assert totals.agg(F.sum("processed"), F.sum("failed")).first()[:] == (1, 2)
    send(("c", NOON, "login", None))
    run()
    assert consumer.progress(spark, folders["outcomes"]).agg(F.sum("processed")).first()[0] == 2
    assert consumer.dead_letters(spark, folders["outcomes"]).count() == 2


def test_messages_without_text_are_dead_letters(spark):
    messages = spark.createDataFrame([(None,), ('{"event_type": "login"}',)], "value string")
    errors = [row["error"] for row in consumer.apply_handler(messages, _only_logins()).collect()]
    assert errors == ["not JSON", None]


def test_the_day_grain_uses_the_same_code(make_events):
    rows = with_rule_score(window_features(make_events(
        ("a", NOON, "login", None), ("a", NOON + timedelta(hours=3), "login", None)), "1 day")).collect()
    assert [row["churn_score"] for row in rows] == [schema.NO_PURCHASE_SCORE]


def test_validation_works_on_a_stream(spark, folders, send):
    send(("a", NOON, "login", None), ("b", NOON, "refund", "1"))
    checked = validation.check_messages(follow_messages(spark, folders["in"]))
    for name, part in {"good": validation.valid_events(checked),
                       "bad": validation.rejected_messages(checked)}.items():
        sinks.append_to_table(part, f"{folders['out']}/{name}", f"{folders['checkpoint']}/{name}",
                              available_now=True).awaitTermination()
    assert [row["customer_id"] for row in spark.read.parquet(folders["out"] + "/good").collect()] == ["a"]
    assert [row["reasons"] for row in spark.read.parquet(folders["out"] + "/bad").collect()] == [["bad_event_type"]]


def test_a_stream_reports_its_validation_totals(spark, folders, send):
    send(("a", NOON, "login", None), ("b", NOON, "refund", "1"), ("c", NOON, "logout", "1"))
    observed = validation.observe_validation(
        validation.check_messages(follow_messages(spark, folders["in"])))
    query = sinks.append_to_table(validation.valid_events(observed), folders["out"],
                                  folders["checkpoint"], available_now=True)
    query.awaitTermination()
    totals = [tuple(progress["observedMetrics"]["validation"].values()) if isinstance(
        progress["observedMetrics"]["validation"], dict) else tuple(progress["observedMetrics"]["validation"])
        for progress in query.recentProgress if progress["observedMetrics"]]
    assert (2, 1, 3) in totals


def test_many_unordered_files_lose_nothing(spark, folders, make_events):
    """More files than a fixed batch limit would take, in no order of time."""
    rows = [(f"c{n % 5}", NOON + timedelta(minutes=(n * 37) % 1010), "login", None) for n in range(1010)]
    encode(make_events(*rows)).select("value").repartition(1010).write.text(folders["in"])
    many = _run(spark, folders)
    single = {name: f"{place}-1" for name, place in folders.items()}
    encode(make_events(*rows)).select("value").coalesce(1).write.text(single["in"])
    assert many == _run(spark, single)
    assert sum(many.values()) > 900


def test_a_table_of_several_files_streams_whole(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "one" / "events.parquet"))
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    (tmp_path / "file").mkdir()
    part = next((tmp_path / "one" / "events.parquet").glob("*.parquet"))
    (tmp_path / "file" / "events.parquet").write_bytes(part.read_bytes())
    for name in ("one", "many", "file"):
        stream = contract._stream_of(spark, str(tmp_path / name), "events.parquet")
        out, checkpoint = str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint")
        sinks.append_to_table(stream, out, checkpoint, available_now=True).awaitTermination()
        whole = spark.read.parquet(str(tmp_path / name / "events.parquet")).count()
        assert spark.read.parquet(out).count() == whole > 0


def test_window_amounts_have_no_range(make_events):
    rows = window_features(make_events(("a", NOON, "purchase", "1e20"), ("b", NOON, "purchase", "4e-11"))).collect()
    assert {r["customer_id"]: r["avg_purchase_amount"] for r in rows} == {"a": 1e20, "b": 4e-11}


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _predictions(spark, *rows):
    frame = spark.createDataFrame([(who, p, str(day), "1") for who, p, day in rows],
                                  "customer_id string, churn_probability double, prediction_date string, model_version string")
    return frame.withColumn("prediction_date", F.to_timestamp(F.concat(F.lit("2024-01-"), F.lpad("prediction_date", 2, "0"))))


def test_newest_predictions_survive_restarts_and_late_rows(spark, rocks, tmp_path):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("rows", "table", "checkpoint"))
    batches = [[("a", 0.5, 3), ("a", 0.7, 5), ("b", 0.1, 1), (None, 0.3, 9), ("c", 0.2, 2)],
               [("a", 0.9, 4), ("b", 0.4, 1), ("d", 0.6, 7)], [("a", 0.7, 5), ("c", 0.1, 2), ("b", 0.0, 2)]]
    versions = []
    for rows in batches:
        _predictions(spark, *rows).write.mode("append").parquet(folder)
        followed = spark.readStream.schema(_predictions(spark).schema).parquet(folder)
        newest.keep_newest(followed, path, checkpoint, available_now=True).awaitTermination(120)
        versions.append(len(tables.versions(spark, path)))
    got = {r["customer_id"]: (r["churn_probability"], r["prediction_date"].day) for r in tables.read_table(spark, path).collect()}
    assert got == {"a": (0.7, 5), "b": (0.0, 2), "c": (0.2, 2), "d": (0.6, 7)}
    whole = predictions.latest_predictions(_predictions(spark, *[r for rows in batches for r in rows if r[0]]))
    assert sorted(map(str, whole.collect())) == sorted(map(str, tables.read_table(spark, path).select(*whole.columns).collect()))
    assert versions == [1, 2, 3]


def test_forgotten_customers_lose_nothing(spark, rocks, tmp_path):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("rows", "table", "checkpoint"))
    for rows in [[("a", 0.5, 9)], [("a", 0.1, 2), ("b", 0.1, 2)]]:
        _predictions(spark, *rows).write.mode("append").parquet(folder)
        followed = spark.readStream.schema(_predictions(spark).schema).parquet(folder)
        newest.keep_newest(followed, path, checkpoint, True, expire_hours=0.0000003).awaitTermination(120)
    got = {r["customer_id"]: r["prediction_date"].day for r in tables.read_table(spark, path).collect()}
    assert got == {"a": 9, "b": 2}


def test_a_crash_between_rows_and_commit_adds_nothing_twice(spark, tmp_path, monkeypatch):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("rows", "table", "checkpoint"))

    def run(n):
        spark.createDataFrame([(n, )], "n int").write.mode("append").parquet(folder)
        return sinks.append_to_versions(spark.readStream.schema("n int").parquet(folder), path, checkpoint, True)

    run(1).awaitTermination(120)
    plain = tables.append

    def crash(*arguments):
        plain(*arguments)
        raise OSError("lost after the rows were committed")

    monkeypatch.setattr(tables, "append", crash)
    with pytest.raises(Exception, match="lost"):
        run(2).awaitTermination(120)
    monkeypatch.undo()
    run(3).awaitTermination(120)
    assert sorted(r["n"] for r in tables.read_table(spark, path).collect()) == [1, 2, 3]
    assert tables.last_batch(spark, path, tables.stream_name(spark, checkpoint)) == 2
