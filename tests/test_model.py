import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import AS_OF
from tidewatch import schema
from tidewatch.operators import boosting, model

FEW = {"maxIter": 8, "maxDepth": 4}
METRICS = ["accuracy", "precision", "recall", "f1_score", "auc_score"]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    draw = np.random.RandomState(42)
    n = 1000
    # The ranges of the sample columns, in model order.
    whole = {"total_events": (1, 100), "unique_event_types": (1, 5), "purchase_count": (0, 20),
             "page_view_count": (0, 50), "support_ticket_count": (0, 5),
             "days_since_last_activity": (0, 30), "customer_lifetime_days": (30, 365),
             "events_last_30d": (0, 50), "purchases_last_30d": (0, 10),
             "page_views_last_30d": (0, 30), "active_days_last_30d": (0, 30)}
    real = {"avg_purchase_amount": (10, 500), "total_purchase_amount": (0, 1000),
            "events_per_day": (0.1, 5), "purchase_frequency": (0, 1),
            "avg_purchase_amount_last_30d": (0, 300)}
    data = {name: draw.randint(*whole[name], n) if name in whole else draw.uniform(*real[name], n)
            for name in schema.FEATURES}
    frame = pd.DataFrame(data)
    risk = (0.3 * (frame.days_since_last_activity > 15) + 0.4 * (frame.purchase_count == 0)
            + 0.3 * (frame.events_last_30d < 5))
    frame["is_churned"] = (risk > 0.5).astype("int32")
    frame["customer_id"] = [f"customer_{i}" for i in range(n)]
    path = str(tmp_path_factory.mktemp("model") / "rows")
    spark.createDataFrame(frame).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def fitted(rows):
    return model.train(rows, settings=FEW)


def test_training_reports_five_metrics(fitted, rows):
    metrics = model.evaluate(fitted, rows).first()
    assert all(0 <= metrics[name] <= 1 for name in METRICS)
    assert metrics["accuracy"] > 0.5
    assert metrics["auc_score"] > 0.8


def test_scoring(fitted, rows):
    scored = model.score(fitted, rows, AS_OF, "2.0").collect()
    assert len(scored) == 1000
    for row in scored:
        assert row["prediction"] in (0, 1)
        assert 0 <= row["churn_probability"] <= 1
        assert row["risk_level"] == ("HIGH" if row["churn_probability"] >= 0.7 else
                                     "MEDIUM" if row["churn_probability"] >= 0.4 else "LOW")
        assert row["model_version"] == "2.0"


def test_importance_covers_every_feature(spark, fitted):
    rows = model.feature_importance(spark, fitted).collect()
    assert [row["feature"] for row in rows] == schema.FEATURES
    assert sum(row["importance"] for row in rows) == pytest.approx(1)


def test_same_seed_same_model(fitted, rows):
    again = model.train(rows, settings=FEW)
    probabilities = [[row["churn_probability"] for row in model.score(m, rows, AS_OF).orderBy("customer_id").collect()]
                     for m in (fitted, again)]
    assert probabilities[0] == probabilities[1]


def test_save_and_load(spark, fitted, rows, tmp_path):
    path = str(tmp_path / "model")
    model.save_model(fitted, path)
    model.save_model(fitted, path)
    loaded = model.load_model(path)
    assert model.model_inputs(loaded) == schema.FEATURES
    before, after = (sorted(map(str, model.score(m, rows, AS_OF).collect())) for m in (fitted, loaded))
    assert before == after


def test_default_settings_are_the_full_ones():
    assert schema.TREE_SETTINGS["maxIter"] == 100
    assert len(schema.FEATURES) == 16


def test_features_keep_their_width(spark):
    frame = spark.createDataFrame([("a", None, float("nan"))],
                                  "customer_id string, total_events bigint, events_per_day double")
    result = model.model_features(frame)
    assert result.columns == ["customer_id", *schema.FEATURES]
    assert set(result.first()[1:]) == {0}
    with pytest.raises(ValueError):
        model.model_features(spark.range(1).withColumn("customer_id", F.lit("a")))


def test_split_is_stable_and_proportional(rows):
    split = model.with_split(rows)
    shares = {row[0]: row[1] for row in split.groupBy("is_churned").agg(
        F.avg(F.col("is_validation").cast("int"))).collect()}
    assert all(0.12 < share < 0.28 for share in shares.values())
    again = model.with_split(rows.repartition(7))
    assert (sorted(map(str, split.select("customer_id", "is_validation").collect()))
            == sorted(map(str, again.select("customer_id", "is_validation").collect())))


def test_standardised_columns(spark):
    frame = spark.createDataFrame([("a", 1.0, 5.0, False), ("b", 3.0, 5.0, False), ("c", 9.0, 6.0, True)],
                                  "customer_id string, x double, flat double, is_validation boolean")
    values = {row["customer_id"]: (row["x"], row["flat"])
              for row in model.standardise(frame, ["x", "flat"]).collect()}
    assert values == {"a": (-1.0, 0.0), "b": (1.0, 0.0), "c": (7.0, 1.0)}


def test_ratios_without_a_denominator_are_zero(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0)], "is_churned int, prediction int")
    row = model.classifier_metrics(frame).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (0.5, 0, 0, 0)
    assert model.classifier_metrics(frame.where("false")).first()["accuracy"] == 0


def test_label_threshold(spark):
    frame = spark.createDataFrame([("a", 30), ("b", 31)], "customer_id string, days_since_last_activity int")
    assert [row[1] for row in model.churn_labels(frame).collect()] == [0, 1]


def test_a_short_dip_does_not_stop_training():
    dip = [0.9, 0.8, 0.85, 0.7, 0.6, 0.65]
    assert model.best_round(dip, 10) == 5
    assert model.best_round(dip, 1) == 2
    assert model.best_round([0.5] + [0.6] * 12 + [0.1], 10) == 1
    assert model.best_round([0.5] + [0.6] * 9 + [0.1], 10) == 11
    assert model.best_round([0.4]) == 1


def _trees(fitted):
    return fitted.stages[-1].trees


def test_training_keeps_the_trees_up_to_the_best_round(rows, monkeypatch):
    monkeypatch.setattr(model, "best_round", lambda errors, patience: 3)
    short = model.train(rows, settings=FEW)
    monkeypatch.setattr(model, "best_round", lambda errors, patience: len(errors))
    whole = model.train(rows, settings=FEW)
    assert [len(_trees(short)), len(_trees(whole))] == [3, 8]
    assert [t.toDebugString.split("\n", 1)[1] for t in _trees(short)] == [
        t.toDebugString.split("\n", 1)[1] for t in _trees(whole)[:3]]


def _features_used(tree):
    return {int(n) for n in re.findall(r"feature (\d+)", tree.toDebugString)}


def test_no_tree_sees_all_columns(rows):
    fitted = model.train(rows, settings={**FEW, "maxDepth": 6}, patience=100)
    used = [_features_used(tree) for tree in _trees(fitted)]
    for k, own in enumerate(used):
        drawn = boosting.columns_of(k, 16, 0.8, schema.SEED)
        assert len(drawn) == 12 and own <= set(drawn)
    assert len(set().union(*used)) > 8
    assert len({tuple(boosting.columns_of(k, 16, 0.8, 1)) for k in range(20)}) > 10
    assert boosting.columns_of(0, 3, 0.1, 1) != []


def test_leaves_are_newton_steps(rows, spark):
    """The first tree's leaves are the sums of gradients over the sums of curvatures of their rows."""
    settings = {**schema.TREE_SETTINGS, "maxIter": 1, "maxDepth": 3}
    vector = VectorAssembler(inputCols=schema.FEATURES, outputCol="v").transform(
        model.with_split(rows)).withColumn("_margin", F.lit(0.4))
    tree = boosting._fit(vector, "is_churned", "v", 16, 0, settings, 200.0)
    p = 1 / (1 + math.exp(-0.4))
    drawn = tree.setFeaturesCol("v").transform(vector.where(boosting._is_drawn(0, 0.8, schema.SEED)))
    for row in drawn.groupBy("prediction").agg(F.avg("is_churned").alias("share")).collect():
        assert row["prediction"] == pytest.approx((row["share"] - p) / (p * (1 - p)))


def _area(scores, labels):
    pairs = [(s > t) + (s == t) / 2 for s, a in zip(scores, labels) if a for t, b in zip(scores, labels) if not b]
    return sum(pairs) / len(pairs) if pairs else None


def test_areas_equal_all_pairs(spark):
    draw = np.random.RandomState(3)
    rows = [(k, float(s), int(y)) for k in range(4) for s, y in zip(draw.randint(0, [5, 400, 2, 9][k], 300), draw.randint(0, 2, 300))]
    rows += [(9, 1.0, 1), (9, 2.0, 1), (10, 0.5, 0)]
    frame = spark.createDataFrame(rows, "round int, score double, label int")
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = {r["round"]: r["area"] for r in boosting.areas_under_curve(frame).collect()}
        for k in (0, 1, 2, 3):
            own = [r for r in rows if r[0] == k]
            assert got[k] == pytest.approx(_area([r[1] for r in own], [r[2] for r in own]), abs=1e-12)
        assert got[9] is None and got[10] is None
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_best_round_has_the_largest_area_even_where_its_loss_is_not_least(rows, monkeypatch):
    """Labels with noise: areas and losses of all rounds by hand, from the trees themselves."""
    noisy = rows.withColumn("is_churned", F.when(F.xxhash64("customer_id") % 10 < 3, 1 - F.col("is_churned"))
                            .otherwise(F.col("is_churned")))
    settings = {"maxIter": 15, "maxDepth": 5, "stepSize": 0.3}
    plain = model.best_round
    monkeypatch.setattr(model, "best_round", lambda errors, patience: len(errors))
    whole = model.train(noisy, settings=settings)
    monkeypatch.setattr(model, "best_round", plain)
    fitted = model.train(noisy, settings=settings, patience=100)
    held_out = model.with_split(model.model_features(noisy, keep=("customer_id", "is_churned"))).where("is_validation")
    scaled = whole.stages[1].transform(whole.stages[0].transform(held_out)).collect()
    labels = [row["is_churned"] for row in scaled]
    margin, areas, losses = np.zeros(len(scaled)), [], []
    for tree in _trees(whole):
        margin = margin + 0.3 * np.array([tree.predict(row["scaled_features"]) for row in scaled])
        areas.append(_area(margin.tolist(), labels))
        losses.append(float(np.mean(np.log1p(np.exp(-margin * (2 * np.array(labels) - 1))))))
    assert len(areas) == 15
    assert len(_trees(fitted)) == int(np.argmax(areas)) + 1
    assert int(np.argmax(areas)) != int(np.argmin(losses))
    probability = 1 / (1 + np.exp(-margin))
    scored = {r["customer_id"]: r["churn_probability"] for r in model.score(whole, noisy, AS_OF).collect()}
    assert [scored[row["customer_id"]] for row in scaled] == pytest.approx(probability.tolist())


def test_training_without_validation_rows_keeps_all_trees(rows):
    fitted = model.train(rows, settings={"maxIter": 2, "maxDepth": 2}, percent=0)
    assert len(_trees(fitted)) == 2
    one_class = model.train(rows.where("is_churned = 0"), settings={"maxIter": 2, "maxDepth": 2})
    assert model.score(one_class, rows, AS_OF).agg(F.max("churn_probability")).first()[0] < 0.5


def test_exact_split_takes_each_share_to_the_row(spark):
    rows = spark.range(1_237).select(F.col("id").cast("string").alias("customer_id"),
                                     (F.col("id") % 11 == 0).cast("int").alias("is_churned"))
    split = model.with_exact_split(rows)
    counts = {tuple(row[:2]): row["count"] for row in split.groupBy("is_churned", "is_validation").count().collect()}
    assert counts == {(1, True): 23, (1, False): 90, (0, True): 225, (0, False): 899}  # of 113 and 1,124
    assert sorted(split.collect()) == sorted(model.with_exact_split(rows.repartition(5)).collect())
    assert model.with_exact_split(rows, 0).where("is_validation").isEmpty()
    assert model.with_exact_split(rows, 100).where("NOT is_validation").isEmpty()
    odd = spark.createDataFrame([(None, 1), ("a", None), ("b", 1), ("b", 1), ("c", 1), ("c", 1)],
                                "customer_id string, is_churned int")
    marks = sorted(((r[0] or "", r[2]) for r in model.with_exact_split(odd, 50).collect()))
    assert marks[:2] == [("", False), ("a", False)] and len({marks[2], marks[3]}) == len({marks[4], marks[5]}) == 1
    assert sum(taken for _, taken in marks) == 2
    assert model.with_exact_split(odd.limit(0)).count() == 0


def test_training_needs_rows(rows):
    with pytest.raises(ValueError, match="training rows"):
        model.train(rows.where("false"), settings=FEW)
    with pytest.raises(ValueError, match="training rows"):
        model.standardise(model.with_split(model.model_features(rows.where("false"))))
