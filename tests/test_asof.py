import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import operators
from tidewatch.operators.asof import asof_join

START = datetime(2024, 1, 1)
LEFT, RIGHT = "who string, at timestamp, n int", "who string, seen timestamp, v int, m map<string,int>"


def _rows(keys, lefts=400, rights=200):
    draw = random.Random(2)

    def moment():
        return START + timedelta(minutes=draw.randrange(500)) if draw.random() < 0.97 else None

    left = [(draw.choice(keys), moment(), i) for i in range(lefts)]
    right = [(draw.choice(keys), moment(), i, {"v": i}) for i in range(rights)]
    return left, right


def _wanted(left, right, strict):
    result = []
    for who, at, n in left:
        known = [r for r in right if who is not None and r[0] == who and at and r[1] and (r[1] < at or r[1] == at and not strict)]
        best = max(known, key=lambda r: (r[1], r[2]), default=None)
        result.append((who, at, n, *(best[1:3] if best else (None, None))))
    return sorted(result, key=lambda r: r[2])


@pytest.mark.parametrize("keys", [["a"], ["a", "a", "a", "b", None], [str(i) for i in range(60)]])
@pytest.mark.parametrize("strict", [False, True])
def test_equals_brute_force(spark, keys, strict):
    left, right = _rows(keys)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        one, two = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
        joined = asof_join(one, two, "who", "at", "seen", strict=strict, tie_by=["v"])
        assert joined.columns == ["who", "at", "n", "seen", "v", "m"]
        got = joined.orderBy("n").collect()
        assert [tuple(r)[:5] for r in got] == _wanted(left, right, strict)
        assert all(r["m"] == (None if r["v"] is None else {"v": r["v"]}) for r in got)
        inner = asof_join(one, two, "who", "at", "seen", "inner", strict, ["v"]).orderBy("n").collect()
        assert [tuple(r)[:5] for r in inner] == [r for r in _wanted(left, right, strict) if r[3] is not None]
        assert operators(joined, "CartesianProduct") == operators(joined, "BroadcastNestedLoopJoin") == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sides_without_rows_and_other_types(spark):
    left, right = _rows(["1", "2"], 20, 10)
    one, two = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    assert asof_join(one.limit(0), two, "who", "at", "seen").count() == 0
    alone = asof_join(one, two.limit(0), "who", "at", "seen").collect()
    assert len(alone) == 20 and all(r["v"] is None for r in alone)
    numbers = two.withColumn("who", F.col("who").cast("int")).withColumn("seen", F.to_date("seen"))
    joined = asof_join(one, numbers, "who", "at", "seen")
    assert joined.where("v IS NOT NULL").count() == one.where("at IS NOT NULL").count()
    with pytest.raises(ValueError, match="both sides"):
        asof_join(one, two.withColumnRenamed("v", "n"), "who", "at", "seen")
    with pytest.raises(ValueError, match="how"):
        asof_join(one, two, "who", "at", "seen", "outer")
