"""Boosted trees on Spark ML regression trees, and the exact area under ROC curves.

Each round fits one tree to the gradients of the logistic loss, weighted by its curvature. A
leaf's weighted mean is then its Newton step, and the tree's own aggregate computes it. A tree
sees a draw of rows, by a hash of the customer, and a draw of columns: the others are 0, so that
no split can use them, and columns keep their numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any
from uuid import uuid4

import numpy as np
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.session import scratch_path, shared_folder

# Rounds whose trees are added to the margins, and whose areas are measured, at once.
GROUP = 5
# Least curvature of a leaf; four rows of even odds have as much.
LEAST_WEIGHT = 1.0
_SHARE_STEPS = 10_000


def columns_of(round_: int, width: int, share: float, seed: int) -> list[int]:
    """The columns a tree may use."""
    count = max(1, int(share * width))
    return sorted(np.random.default_rng([seed, round_]).choice(width, count, replace=False).tolist())


def _is_drawn(round_: int, share: float, seed: int) -> Column:
    return F.pmod(F.xxhash64("customer_id", F.lit(f"{seed}:{round_}")), F.lit(_SHARE_STEPS)) < int(share * _SHARE_STEPS)


def _stored(frame: DataFrame) -> DataFrame:
    path = scratch_path(frame.sparkSession, "margins")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _fit(rows: DataFrame, label: str, features: str, width: int, round_: int, settings: Mapping[str, Any],
         weight: float) -> DecisionTreeRegressionModel:
    """One tree for the gradients at the present margins; `weight` is the rows' whole curvature."""
    drawn = columns_of(round_, width, settings["columnsPerTree"], settings["seed"])
    mask = Vectors.dense([1.0 if k in drawn else 0.0 for k in range(width)])
    odds = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
    curvature = F.greatest(odds * (F.lit(1.0) - odds), F.lit(1e-6))
    target = rows.where(_is_drawn(round_, settings["subsamplingRate"], settings["seed"])).select(
        features, ((F.col(label) - odds) / curvature).alias("_step"), curvature.alias("_curvature"))
    shown = ElementwiseProduct(scalingVec=mask, inputCol=features, outputCol="_shown").transform(target)
    least = min(LEAST_WEIGHT / (settings["subsamplingRate"] * weight), 0.49) if weight > 0 else 0.0
    tree = DecisionTreeRegressor(featuresCol="_shown", labelCol="_step", weightCol="_curvature",
                                 maxDepth=settings["maxDepth"], seed=settings["seed"],
                                 minWeightFractionPerNode=least)
    # A fit reads its rows several times; what is lost with an executor is made anew.
    kept = shown.persist()
    try:
        return tree.fit(kept)
    finally:
        kept.unpersist()


def grow(rows: DataFrame, label: str, validation: str, features: str, width: int, settings: Mapping[str, Any],
         is_enough: Callable[[Sequence[float]], bool]) -> tuple[list[DecisionTreeRegressionModel], list[float]]:
    """Trees, and the area under the ROC curve of the validation rows after each of them.

    `rows` has customer_id, a label of 0 and 1, whether a row validates, and its vector. Fitting
    ends after `maxIter` trees, when `is_enough` says so of the areas, or when the margins leave
    too little curvature for a split. There are no areas if the validation rows lack a class.
    """
    # Trees checkpoint there.
    shared_folder(rows.sparkSession)
    margins = _stored(rows.withColumn("_margin", F.lit(0.0)))
    both = margins.where(validation).agg(F.countDistinct(label)).first()[0] == 2
    trees: list[DecisionTreeRegressionModel] = []
    areas: list[float] = []
    while len(trees) < settings["maxIter"] and not (areas and is_enough(areas)):
        added = []
        present = margins
        odds = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        weight = margins.where(~F.col(validation)).agg(F.sum(odds * (F.lit(1.0) - odds))).first()[0]
        if trees and weight < 2 * LEAST_WEIGHT:
            break  # too certain of all rows to cut them in two
        for _ in range(min(GROUP, settings["maxIter"] - len(trees))):
            training = present.where(~F.col(validation))
            tree = _fit(training, label, features, width, len(trees), settings, weight)
            trees.append(tree)
            name = f"_round_{len(trees)}"
            added.append(name)
            present = tree.setFeaturesCol(features).setPredictionCol("_leaf").transform(present)
            present = present.withColumn("_margin", F.col("_margin") + F.lit(settings["stepSize"]) * F.col("_leaf"))
            present = present.withColumn(name, F.when(F.col(validation), F.col("_margin"))).drop("_leaf")
        margins = _stored(present)
        if both:
            measured = margins.where(validation).select(
                F.col(label).alias("label"), F.posexplode(F.array(*added)).alias("round", "score"))
            found = {row["round"]: row["area"] for row in areas_under_curve(measured).collect()}
            areas += [found[k] for k in range(len(added))]
        margins = margins.drop(*added)
    return trees, areas


def joined(spark: SparkSession, trees: Sequence[DecisionTreeRegressionModel], width: int,
           step: float) -> GBTClassificationModel:
    """The trees as Spark's model of boosted trees, which takes twice the sum for the log odds."""
    kind = spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    listed = spark.sparkContext._gateway.new_array(kind, len(trees))
    weights = spark.sparkContext._gateway.new_array(spark._jvm.double, len(trees))
    for k, tree in enumerate(trees):
        listed[k], weights[k] = tree._java_obj, step / 2
    return GBTClassificationModel(spark._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"boosted_{uuid4().hex[:12]}", listed, weights, width, 2))


def areas_under_curve(rows: DataFrame) -> DataFrame:
    """The exact area under the ROC curve of each round, from (round, score, label 0 or 1).

    Twice the number of pairs in which the positive row has the larger score, ties once, by ranks:
    equal scores are counted together, ranges of (round, score) are summed apart, and each range
    starts from the sums of those before. No round is ever in one task. The sums are whole
    numbers; a round without rows of both classes has a null area.
    """
    spark = rows.sparkSession
    ties = rows.groupBy("round", "score").agg(
        F.sum("label").cast("long").alias("ones"), F.sum(F.lit(1) - F.col("label")).cast("long").alias("zeros"))
    path = scratch_path(spark, "ranks")
    ranged = ties.repartitionByRange("round", "score").withColumn("place", F.spark_partition_id())
    ranged.write.parquet(path)
    # Stored, as ranges are drawn from a sample and must not change between the two uses.
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before = Window.partitionBy("round").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # At most a row for each range and round in it.
    starts = ranged.groupBy("round", "place").agg(F.sum("zeros").alias("zeros")).select(
        "round", "place", F.coalesce(F.sum("zeros").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("round", "place").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("zeros").over(inside), F.lit(0))
    whole = "decimal(20,0)"
    pairs = F.col("ones").cast(whole) * (2 * below + F.col("zeros")).cast("decimal(18,0)")
    summed = ranged.join(F.broadcast(starts), ["round", "place"]).select(
        "round", "ones", "zeros", pairs.alias("pairs")).groupBy("round").agg(
        F.sum("pairs").alias("pairs"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    return summed.select(
        "round", "ones", "zeros",
        F.try_divide(F.col("pairs").cast("double"), 2.0 * F.col("ones") * F.col("zeros")).alias("area"))
