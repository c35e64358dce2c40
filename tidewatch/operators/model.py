"""Attrition model on Spark ML: inputs, split, training, metrics, scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch import schema
from tidewatch.functions.values import churn_label, instant, risk_band
from tidewatch.operators import boosting, selection
from tidewatch.operators.asof import asof_join

LABEL = "is_churned"
_VALIDATION = "is_validation"


def model_features(rows: DataFrame, features: Sequence[str] = tuple(schema.FEATURES),
                   keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    """The model's columns in their fixed order; absent columns and gaps are 0.

    The width never changes, so a model sees the same vector in training and scoring.
    """
    if not set(features) & set(rows.columns):
        raise ValueError("the table has none of the model's features")
    absent = {name: F.lit(0.0) for name in features if name not in rows.columns}
    full = rows.withColumns(absent) if absent else rows
    return full.select(*keep, *features).fillna(0, list(features))


def churn_labels(features: DataFrame, inactive_days: int = schema.INACTIVE_DAYS) -> DataFrame:
    return features.select("customer_id", churn_label(inactive_days).alias(LABEL))


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of labelled customers."""
    return features.join(labels.select("customer_id", LABEL), "customer_id")


def training_set_as_of(features: DataFrame, labels: DataFrame, known_at: str, labelled_at: str) -> DataFrame:
    """Dated labels, each with its customer's newest features known at that time.

    `features` has a row for each time a customer's features became known. Labels without earlier
    features are left out.
    """
    return asof_join(labels, features, "customer_id", labelled_at, known_at, how="inner")


def is_validation(percent: int = schema.VALIDATION_PERCENT, seed: int = schema.SEED) -> Column:
    """Whether a customer belongs to the validation rows.

    A hash of the customer decides, so the split needs no shuffle and is the same in
    every run and on every retry. Both classes are split in the same proportion up to
    chance.
    """
    digest = F.md5(F.concat(F.col("customer_id"), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent


def with_split(rows: DataFrame, percent: int = schema.VALIDATION_PERCENT,
               seed: int = schema.SEED) -> DataFrame:
    return rows.withColumn(_VALIDATION, is_validation(percent, seed))


def with_exact_split(rows: DataFrame, percent: int = schema.VALIDATION_PERCENT,
                     seed: int = schema.SEED) -> DataFrame:
    """Rows marked for validation so that each class has its share to the row, rounded half up.

    Of each class the customers with the smallest digests are taken; rows of one customer stay
    together. Rows without a customer or a label are training rows.
    """
    digest = F.conv(F.substring(F.md5(F.concat(F.col("customer_id"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("bigint")
    limits = selection.smallest(rows.select(F.col(LABEL).alias("class"), digest.alias("digest")),
                                lambda count: (count * percent + 50) // 100)
    is_taken = F.lit(False)
    for name, limit in limits.items():
        is_taken = is_taken | (F.col(LABEL) == F.lit(name)) & (digest < F.lit(limit))
    return rows.withColumn(_VALIDATION, F.coalesce(is_taken, F.lit(False)))


def standardise(rows: DataFrame, features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """Columns as (x - mean) / deviation, both taken from the training rows.

    A column without spread is only centred. The fitted values are two numbers per
    column, so they travel to the tasks as literals.
    """
    fitted = rows.where(~F.col(_VALIDATION)).agg(
        F.count("*").alias("training_rows"),
        *[F.avg(name).alias(f"mean_{name}") for name in features],
        *[F.stddev_pop(name).alias(f"spread_{name}") for name in features]).first()
    if not fitted["training_rows"]:
        raise ValueError("there are no training rows")
    others = [name for name in rows.columns if name not in features]
    return rows.select(*others, *[
        ((F.col(name) - F.lit(fitted[f"mean_{name}"]))
         / F.lit(fitted[f"spread_{name}"] or 1.0)).alias(name)
        for name in features])


def train(rows: DataFrame, features: Sequence[str] = tuple(schema.FEATURES),
          settings: Mapping[str, Any] | None = None,
          percent: int = schema.VALIDATION_PERCENT,
          patience: int = schema.PATIENCE,
          split: Callable[[DataFrame, int], DataFrame] = with_split) -> PipelineModel:
    """Fit boosted trees on labelled rows, and keep the trees up to the best round.

    The best round has the largest area under the ROC curve of the validation rows; fitting ends
    `patience` rounds after it. Nothing is fitted twice: the model takes the first trees. `split`
    marks the validation rows. `rows` is read many times and should be a stored table.
    """
    spark = rows.sparkSession
    chosen = {**schema.TREE_SETTINGS, **(settings or {})}
    marked = split(model_features(rows, features, ("customer_id", LABEL)), percent)
    if marked.where(~F.col(_VALIDATION)).isEmpty():
        raise ValueError("there are no training rows")
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    assembled = assembler.transform(marked)
    scaler = StandardScaler(inputCol="raw_features", outputCol="scaled_features",
                            withMean=True, withStd=True).fit(assembled.where(~F.col(_VALIDATION)))
    start = scaler.transform(assembled).select(
        "customer_id", F.col(LABEL).cast("int").alias(LABEL), _VALIDATION, "scaled_features")
    trees, areas = boosting.grow(start, LABEL, _VALIDATION, "scaled_features", len(features), chosen,
                                 lambda areas: len(areas) - best_round([-a for a in areas], patience) >= patience)
    if areas:
        trees = trees[:best_round([-area for area in areas], patience)]
    model = boosting.joined(spark, trees, len(features), chosen["stepSize"])
    return PipelineModel([assembler, scaler, model.setFeaturesCol("scaled_features")])


def best_round(errors: Sequence[float], patience: int = schema.PATIENCE) -> int:
    """The number of rounds with the least error, looking no further than `patience` rounds
    beyond the best one so far."""
    best = 0
    for place, error in enumerate(errors):
        if error < errors[best]:
            best = place
        elif place - best >= patience:
            break
    return best + 1


def classifier_metrics(predictions: DataFrame, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, in one pass.

    A ratio without a denominator is 0.
    """
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = predictions.agg(
        F.count(F.when(actual & guess, 1)).alias("true_positives"),
        F.count(F.when(~actual & guess, 1)).alias("false_positives"),
        F.count(F.when(actual & ~guess, 1)).alias("false_negatives"),
        F.count(F.when(~actual & ~guess, 1)).alias("true_negatives"))
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return counts.select(
        "*",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def evaluate(model: PipelineModel, rows: DataFrame,
             percent: int = schema.VALIDATION_PERCENT) -> DataFrame:
    """The metrics and the area under the ROC curve on the validation rows."""
    features = model_inputs(model)
    held_out = with_split(model_features(rows, features, ("customer_id", LABEL)), percent).where(
        F.col(_VALIDATION))
    predicted = model.transform(held_out)
    area = BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol="rawPrediction", numBins=0).evaluate(predicted)
    return classifier_metrics(predicted).withColumn("auc_score", F.lit(area))


def importance_weights(model: PipelineModel) -> list[float]:
    """The weight of each model input; they sum to 1."""
    return [float(weight) for weight in model.stages[-1].featureImportances.toArray()]


def model_inputs(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def score(model: PipelineModel, features: DataFrame, as_of: str | datetime,
          model_version: str = schema.MODEL_VERSION) -> DataFrame:
    """Class, churn probability and risk level of every customer of a feature table."""
    scored = model.transform(model_features(features, model_inputs(model)))
    probability = vector_to_array("probability")[1]
    return scored.select(
        "customer_id",
        F.col("prediction").cast("int").alias("prediction"),
        probability.alias("churn_probability"),
        risk_band(probability).alias("risk_level"),
        instant(as_of).alias("prediction_timestamp"),
        F.lit(model_version).alias("model_version"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per model input."""
    rows = list(zip(model_inputs(model), importance_weights(model)))
    return spark.createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    """Store the fitted stages, their inputs and their settings."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
