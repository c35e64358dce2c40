from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from tidewatch import schema
from tidewatch.operators.model import load_model, model_inputs
from tidewatch.plans.jobs import run_feature_job, run_scoring_job, run_training_job
from tidewatch.sources.tables import read_table


@pytest.fixture
def events(make_events):
    rows = []
    for number in range(60):
        for step in range(1 + number % 5):
            moment = AS_OF - timedelta(days=(number % 2) * 40 + step, hours=number % 24)
            rows.append((f"c{number}", moment, ["purchase", "page_view"][step % 2], "12.5"))
    return make_events(*rows)


def test_features_training_and_scoring(spark, events, tmp_path):
    table, model_path = str(tmp_path / "features"), str(tmp_path / "model")
    rolling, cohort = str(tmp_path / "rolling"), str(tmp_path / "cohort")
    run_feature_job(events, table, AS_OF, rolling_path=rolling, cohort_path=cohort)
    run_feature_job(events.where("customer_id = 'c1'").unionByName(
        events.where("customer_id = 'c2'").withColumn("customer_id", F.lit("new"))), table, AS_OF)
    assert read_table(spark, table).count() == 61
    assert spark.read.parquet(rolling).count() == spark.read.parquet(cohort).count() == events.count()

    metrics = run_training_job(spark, table, model_path, str(tmp_path / "training"),
                               exclude_label_source=True, settings={"maxIter": 2, "maxDepth": 2})
    assert {"accuracy", "auc_score"} <= set(metrics.columns)
    assert model_inputs(load_model(model_path)) == [
        name for name in schema.FEATURES if name != "days_since_last_activity"]

    stored = str(tmp_path / "predictions")
    scored = run_scoring_job(spark, table, model_path, AS_OF,
                             lambda rows: rows.write.mode("append").parquet(stored))
    assert scored.count() == 61
    some = run_scoring_job(spark, table, model_path, AS_OF,
                           lambda rows: rows.write.mode("append").parquet(stored), ["c1", "c9", "none"])
    assert some.count() == 2
    whole = {row["customer_id"]: row["churn_probability"] for row in scored.collect()}
    assert all(whole[row["customer_id"]] == row["churn_probability"] for row in some.collect())
    assert spark.read.parquet(stored).count() == 63
    assert spark.read.parquet(stored).columns == [field.name for field in schema.PREDICTION]


def test_training_on_a_label_table(spark, events, tmp_path):
    table = str(tmp_path / "features")
    run_feature_job(events, table, AS_OF)
    labels = read_table(spark, table).select(
        "customer_id", (F.col("total_events") > 2).cast("int").alias("is_churned"))
    metrics = run_training_job(spark, table, str(tmp_path / "model"), str(tmp_path / "training"),
                               labels, settings={"maxIter": 2, "maxDepth": 2})
    assert metrics.first()["accuracy"] == 1.0


def test_dated_labels_meet_what_was_known(spark, events, tmp_path):
    table, history = str(tmp_path / "features"), str(tmp_path / "history")
    earlier = AS_OF - timedelta(days=20)
    for moment, part in [(earlier, events.where(F.col("timestamp") < F.lit(str(earlier)).cast("timestamp"))),
                         (AS_OF, events), (AS_OF, events)]:
        run_feature_job(part, table, moment, history=history)
    before = read_table(spark, history).where(F.col("known_at") < F.lit(str(AS_OF)).cast("timestamp"))
    known = before.count()
    assert read_table(spark, history).count() == known + 60 and 0 < known < 60
    labels = read_table(spark, table).select(
        "customer_id", F.lit(str(AS_OF - timedelta(days=1))).cast("timestamp").alias("labelled_at"),
        (F.col("total_events") > 2).cast("int").alias("is_churned"))
    training = str(tmp_path / "training")
    run_training_job(spark, table, str(tmp_path / "model"), training, labels,
                     settings={"maxIter": 2, "maxDepth": 2}, history=history)
    rows = {r["customer_id"]: r["total_events"] for r in spark.read.parquet(training).collect()}
    assert rows == {r["customer_id"]: r["total_events"] for r in before.collect()}
    with pytest.raises(ValueError, match="labelled_at"):
        run_training_job(spark, table, str(tmp_path / "model"), training, labels.drop("labelled_at"), history=history)
