"""As-of join: each row meets the newest earlier row of its key.

Both sides are ordered together by (key, time) in ranges, so a busy key is spread over many
ranges; no pairs are formed. In a range, a running "last row of the other side" answers most rows.
A key that goes on in the next range is carried there: each range hands on one row at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.session import scratch_path


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              how: str = "left", strict: bool = False, tie_by: Sequence[str] = ()) -> DataFrame:
    """Rows of `left`, each with the columns of the `right` row of its key whose time is the
    newest one not after its own (with `strict`: before its own).

    The result has the columns of `left`, then those of `right` but for the key. Rows without a
    match have nulls there, or are left out with `how="inner"`; a null key or time matches
    nothing. Of right rows of one key and time the last by `tie_by` counts, else any one.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    added = [name for name in right.columns if name != key]
    clash = set(left.columns) & set(added)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    spark = left.sparkSession
    kind = left.schema[key].dataType

    own = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    given = F.struct(*[F.col(f"`{name}`") for name in right.columns])
    blank_own, blank_given = F.lit(None).cast(left.schema), F.lit(None).cast(right.schema)
    usable = F.col(f"`{key}`").isNotNull()
    order_after = 1 if strict else 0  # left rows go before right ones of their time, or after them
    lefts = left.where(usable & F.col(f"`{left_time}`").isNotNull()).select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{left_time}`").cast("timestamp").alias("_time"),
        F.lit(1 - order_after).alias("_side"), own.alias("_left"), blank_given.alias("_right"), F.lit(True).alias("_asks"))
    rights = right.where(usable & F.col(f"`{right_time}`").isNotNull()).select(
        F.col(f"`{key}`").cast(kind).alias("_key"), F.col(f"`{right_time}`").cast("timestamp").alias("_time"),
        F.lit(order_after).alias("_side"), blank_own.alias("_left"), given.alias("_right"), F.lit(False).alias("_asks"))

    path = scratch_path(spark, "asof")
    ranged = lefts.unionByName(rights).repartitionByRange("_key", "_time", "_side")
    ranged = ranged.withColumn("_place", F.spark_partition_id())
    ranged.write.parquet(path)
    # Stored, as ranges are drawn from a sample and must not change between the two uses.
    ranged = spark.read.schema(ranged.schema).parquet(path)

    tied = [F.col("_right").getField(name) for name in tie_by]
    order = [F.col("_time"), F.col("_side"), *tied]
    # Of each range, its last key and that key's newest right row: one row for each range.
    newest = F.struct("_time", *[value.alias(f"_tie_{k}") for k, value in enumerate(tied)])
    ends = ranged.groupBy("_place").agg(F.max("_key").alias("_key"), F.min("_key").alias("_from"))
    last = (ranged.where("NOT _asks").join(F.broadcast(ends.drop("_from")), ["_place", "_key"])
            .groupBy("_place", "_key").agg(F.max_by("_right", newest).alias("_carried")))
    handed = ends.join(F.broadcast(last), ["_place", "_key"], "left")
    # Ranges of one last key follow each other; a range that only begins with the key gets the
    # newest row handed on before it.
    begins = (ends.select("_place", F.col("_from").alias("_key"), F.lit(True).alias("_begins"),
                          F.lit(None).cast(right.schema).alias("_carried"))
              .unionByName(handed.select("_place", "_key", F.lit(False).alias("_begins"), "_carried")))
    earlier = Window.partitionBy("_key").orderBy("_place", F.desc("_begins")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (begins.withColumn("_start", F.last("_carried", ignorenulls=True).over(earlier))
              .where("_begins AND _start IS NOT NULL").select("_place", "_key", "_start"))

    running = Window.partitionBy("_place", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.withColumn("_found", F.last("_right", ignorenulls=True).over(running)).where("_asks")
    found = found.join(F.broadcast(starts), ["_place", "_key"], "left")
    found = found.select("_left", F.coalesce("_found", "_start").alias("_found"))
    if how == "inner":
        found = found.where(F.col("_found").isNotNull())
    else:
        lost = left.where(~usable | F.col(f"`{left_time}`").isNull())
        found = found.unionByName(lost.select(own.alias("_left"), blank_given.alias("_found")))
    return found.select("_left.*", *[F.col("_found").getField(name).alias(name) for name in added])
