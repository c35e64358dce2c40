from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, operators, plan_of
from tidewatch import schema
from tidewatch.functions.values import instant, iso_text, risk_band, rule_score
from tidewatch.operators import predictions
from tidewatch.sources.relational import run_query


@pytest.fixture
def stored(spark):
    rows = [
        ("a", 0.4, AS_OF - timedelta(hours=1)), ("a", 0.7, AS_OF - timedelta(minutes=5)),
        ("b", 0.9, AS_OF - timedelta(hours=1, microseconds=1)),
        ("c", 0.2, AS_OF), ("c", 0.71, AS_OF), ("d", 0.39, AS_OF - timedelta(days=3)),
    ]
    frame = spark.createDataFrame([(k, p, str(t), "1.0", None) for k, p, t in rows],
                                  "customer_id string, churn_probability double, "
                                  "prediction_date string, model_version string, features string")
    return frame.withColumn("prediction_date", F.col("prediction_date").cast("timestamp"))


def test_latest_predictions(stored):
    newest = {row["customer_id"]: row["churn_probability"]
              for row in predictions.latest_predictions(stored).collect()}
    assert newest == {"a": 0.7, "b": 0.9, "c": 0.71, "d": 0.39}
    assert predictions.latest_prediction(stored, "c").first()["churn_probability"] == 0.71
    assert predictions.latest_prediction(stored, "nobody").count() == 0


def test_latest_predictions_are_reduced_before_the_shuffle(stored):
    plan = plan_of(predictions.latest_predictions(stored))
    assert operators(predictions.latest_predictions(stored), "WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_metrics_of_the_last_hour(stored):
    row = predictions.prediction_metrics(stored, AS_OF).first()
    assert (row["total_predictions"], row["high_risk_count"]) == (4, 1)
    assert row["avg_churn_score"] == pytest.approx((0.4 + 0.7 + 0.2 + 0.71) / 4)
    assert tuple(predictions.prediction_metrics(stored.where("false"), AS_OF).first()) == (0, None, None)


def test_risk_bands_include_their_lower_end(spark):
    rows = spark.createDataFrame([(0.7,), (0.69,), (0.4,), (0.39,), (None,)], "p double")
    assert [row[0] for row in rows.select(risk_band(F.col("p"))).collect()] == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW", None]


def test_rule_score(spark):
    rows = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "n int, p int")
    assert [row[0] for row in rows.select(rule_score(F.col("n"), F.col("p"))).collect()] == [0.8, 0.6, 0.2]


def test_lookup_by_list_and_by_table(spark, tmp_path):
    path = str(tmp_path / "features")
    spark.range(2000).select(F.col("id").cast("string").alias("customer_id"), *[
        F.col("id").cast("double").alias(name) for name in schema.FEATURES]).write.parquet(path)
    features = spark.read.parquet(path)
    short = predictions.feature_lookup(features, ["5", "7", "none"])
    assert short.columns == ["customer_id", *schema.STORED_FEATURES]
    assert {row[0] for row in short.collect()} == {"5", "7"}
    assert "In(customer_id, [5,7,none])" in plan_of(short)
    assert "events_last_30d" not in plan_of(short)
    assert predictions.feature_lookup(features, map(str, range(1500))).count() == 1500
    assert predictions.feature_lookup(features, features.where("customer_id < '2'")).count() == 1112


def test_defaults(spark):
    rows = spark.createDataFrame([("a", 0.5)], "customer_id string, churn_probability double")
    row = predictions.with_prediction_defaults(rows, AS_OF).first()
    assert (row["model_version"], row["features"]) == ("1.0", None)
    filled = predictions.with_feature_defaults(
        spark.createDataFrame([("a", None)], "customer_id string, total_events bigint"), AS_OF)
    assert [f.dataType for f in filled.schema] == [f.dataType for f in schema.STORED_FEATURE_ROW]
    assert filled.first()["total_events"] == 0 and filled.first()["last_updated"] is not None


def test_parameterised_query(spark, stored):
    found = run_query(spark, "SELECT customer_id FROM {rows} WHERE churn_probability > :floor",
                      {"floor": 0.7}, rows=stored)
    assert {row[0] for row in found.collect()} == {"b", "c"}
    hostile = run_query(spark, "SELECT * FROM {rows} WHERE customer_id = :key",
                        {"key": "x' OR '1'='1"}, rows=stored)
    assert hostile.count() == 0


def test_instants_and_iso_text(spark):
    zoned = datetime(2024, 1, 31, 13, tzinfo=timezone(timedelta(hours=1)))
    row = spark.range(1).select(
        (instant(zoned) == instant("2024-01-31 12:00:00")).alias("same"),
        iso_text(instant("2024-01-31 12:00:00")).alias("whole"),
        iso_text(instant("2024-01-31 12:00:00.000120")).alias("part")).first()
    assert tuple(row) == (True, "2024-01-31T12:00:00", "2024-01-31T12:00:00.000120")
