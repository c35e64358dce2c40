from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import operators, sum_of_scans
from tidewatch.sources import relational, tables, topics

SHAPE = "id string, n int, note string"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def _rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_create_read_and_versions(spark, path):
    first = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SHAPE)
    assert tables.create_if_absent(first, path, ["n"])
    assert not tables.create_if_absent(first.limit(0), path)
    tables.upsert(spark.createDataFrame([("a", 9, "z")], SHAPE), path, ["id"])
    assert tables.versions(spark, path) == [0, 1]
    assert _rows(tables.read_table(spark, path, 0).select("id", "n", "note")) == [("a", 1, "x"), ("b", 2, "y")]
    assert _rows(tables.read_table(spark, path).select("id", "n", "note")) == [("a", 9, "z"), ("b", 2, "y")]
    with pytest.raises(ValueError):
        tables.read_table(spark, path, 7)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path + "-absent")


def test_upsert_creates_updates_inserts_and_keeps(spark, path):
    tables.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 0, "lost")], SHAPE),
                  path, ["id"])
    assert _rows(tables.read_table(spark, path)) == [("a", 1, "x"), ("b", 2, "y")]
    changes = spark.createDataFrame([("a", 5, "new"), ("c", 3, None), (None, 4, "lost")], SHAPE)
    tables.upsert(changes, path, ["id"], {"n": "target.n + source.n"})
    assert sorted(map(str, tables.read_table(spark, path).collect())) == sorted(
        ["Row(id='a', n=6, note='x')", "Row(id='b', n=2, note='y')", "Row(id='c', n=3, note=None)"])


def test_upsert_can_set_null(spark, path):
    tables.upsert(spark.createDataFrame([("a", 1, "x")], SHAPE), path, ["id"])
    tables.upsert(spark.createDataFrame([("a", None, None)], SHAPE), path, ["id"])
    assert _rows(tables.read_table(spark, path)) == [("a", None, None)]


def test_duplicate_source_keys_fail_and_leave_the_table(spark, path):
    tables.upsert(spark.createDataFrame([("a", 1, "x")], SHAPE), path, ["id"])
    with pytest.raises(Exception, match="one merge key"):
        tables.upsert(spark.createDataFrame([("a", 2, "y"), ("a", 3, "z")], SHAPE), path, ["id"])
    assert tables.versions(spark, path) == [0]
    assert _rows(tables.read_table(spark, path)) == [("a", 1, "x")]
    tables.upsert(spark.createDataFrame([("a", 4, "w")], SHAPE), path, ["id"])
    assert _rows(tables.read_table(spark, path)) == [("a", 4, "w")]


def test_missing_source_columns_fail(spark):
    target = spark.createDataFrame([("a", 1, "x")], SHAPE)
    with pytest.raises(ValueError, match="note"):
        tables.merged(target, target.drop("note"), ["id"])


def test_merge_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))
        assert operators(tables.merged(target, target, ["id"]), "Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partition_by", [[], ["n"]])
def test_compaction_keeps_rows_in_fewer_files(spark, path, partition_by):
    frame = spark.range(500).select(F.col("id").cast("string").alias("id"),
                                    (F.col("id") % 2).cast("int").alias("n"), F.lit("x").alias("note"))
    tables.create_if_absent(frame.repartition(10), path, partition_by)
    before = len(tables.read_table(spark, path).inputFiles())
    tables.compact(spark, path, partition_by)
    after = tables.read_table(spark, path)
    assert len(after.inputFiles()) < before
    assert _rows(after.select("id", "n", "note")) == _rows(frame)


def test_partition_values_keep_their_types(spark, path):
    frame = spark.createDataFrame([("007", "x", 1), ("1e2", "y", 2), ("08", "z", 3)],
                                  "code string, id string, n int")
    assert tables.create_if_absent(frame, path, ["code"])
    assert tables.read_table(spark, path).schema == frame.schema
    tables.upsert(spark.createDataFrame([("007", "x", 5), ("0x1", "w", 4)], frame.schema), path, ["id"])
    tables.compact(spark, path)
    table = tables.read_table(spark, path)
    assert table.columns == frame.columns
    assert sorted(map(tuple, table.collect())) == [
        ("007", "x", 5), ("08", "z", 3), ("0x1", "w", 4), ("1e2", "y", 2)]
    assert tables.partition_columns(spark, path) == ["code"]
    assert all("/code=" in name for name in table.inputFiles())


def test_no_table_is_taken_for_absent(spark, path):
    frame = spark.createDataFrame([("a", 1, "x")], SHAPE)
    tables.create_if_absent(frame, path)
    for marker in (Path(path) / "data").rglob("_SUCCESS"):  # as committers without markers leave it
        marker.unlink()
    assert not tables.create_if_absent(frame.limit(0), path)
    assert tables.read_table(spark, path).count() == 1
    other = f"{path}-other"
    frame.write.parquet(f"{other}/v=0")
    with pytest.raises(ValueError, match="without a log"):
        tables.create_if_absent(frame.limit(0), other)


def _files(path):
    return {str(file) for file in (Path(path) / "data").rglob("*.parquet")}


def test_one_changed_key_writes_one_slice(spark, path):
    frame = spark.range(5_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"),
                                      F.lit("x").alias("note"))
    tables.create_if_absent(frame, path, keys=["id"])
    before = _files(path)
    tables.upsert(spark.createDataFrame([("17", 4, "y")], SHAPE), path, ["id"], {"n": "target.n + source.n"})
    written = _files(path) - before
    assert len(written) == 1
    assert spark.read.parquet(*written).count() < 5_000 / 8
    rows = tables.read_table(spark, path)
    assert rows.count() == 5_000 and rows.agg(F.sum("n")).first()[0] == 5_004
    assert rows.where("id = '17'").first()["note"] == "x"
    assert tables.read_table(spark, path, 0).agg(F.sum("n")).first()[0] == 5_000
    tables.upsert(frame.withColumn("id", F.concat("id", F.lit("-new"))), path, ["id"])
    assert tables.read_table(spark, path).count() == 10_000


def test_keys_of_other_types_meet(spark, path):
    tables.create_if_absent(spark.createDataFrame([(1, "x")], "id long, note string"), path, keys=["id"])
    tables.upsert(spark.createDataFrame([(1, "y"), (2, "z")], "id int, note string"), path, ["id"])
    assert _rows(tables.read_table(spark, path)) == [(1, "y"), (2, "z")]


def _while_writing(monkeypatch, action):
    """Run `action` once, after a writer has written its rows and before it commits them."""
    plain, todo = tables._put_if_absent, [action]

    def put(*arguments):
        if todo:
            todo.pop()()
        return plain(*arguments)

    monkeypatch.setattr(tables, "_put_if_absent", put)


@pytest.mark.parametrize("other", ["8", "7"])
def test_two_merges_from_one_version_lose_nothing(spark, path, monkeypatch, other):
    """Of keys in different slices, and of one key."""
    tables.create_if_absent(spark.createDataFrame([(str(i), 1, "x") for i in range(50)], SHAPE), path, keys=["id"])
    update = {"n": "target.n + source.n"}
    _while_writing(monkeypatch, lambda: tables.upsert(
        spark.createDataFrame([(other, 100, "b")], SHAPE), path, ["id"], update))
    tables.upsert(spark.createDataFrame([("7", 10, "a")], SHAPE), path, ["id"], update)
    assert tables.versions(spark, path) == [0, 1, 2]
    changed = {row["id"]: row["n"] for row in tables.read_table(spark, path).where("n > 1").collect()}
    assert changed == ({"7": 11, "8": 101} if other == "8" else {"7": 111})
    assert tables.read_table(spark, path).count() == 50


def test_appends_and_compaction_beside_each_other(spark, path, monkeypatch):
    one = spark.createDataFrame([("a", 1, "x")], SHAPE)
    assert tables.append(one, path)
    _while_writing(monkeypatch, lambda: tables.append(one.withColumn("id", F.lit("b")), path))
    assert tables.append(one.withColumn("id", F.lit("c")).select("note", "n", "id"), path)
    _while_writing(monkeypatch, lambda: tables.append(one.withColumn("id", F.lit("d")), path))
    tables.compact(spark, path)
    assert _rows(tables.read_table(spark, path).select("id")) == [("a",), ("b",), ("c",), ("d",)]
    _while_writing(monkeypatch, lambda: tables.upsert(one.withColumn("id", F.lit("b")), path, ["id"]))
    with pytest.raises(RuntimeError, match="cut anew"):
        tables.append(one, path)
    assert tables.read_table(spark, path).count() == 4


def test_two_creators(spark, path, monkeypatch):
    one, two = (spark.createDataFrame([(name, 1, "x")], SHAPE) for name in "ab")
    _while_writing(monkeypatch, lambda: tables.create_if_absent(two, path))
    assert not tables.create_if_absent(one, path)
    assert _rows(tables.read_table(spark, path).select("id")) == [("b",)]


def test_entries_are_put_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    (tmp_path / "log").mkdir()
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda k: tables._put_if_absent(spark, f"{tmp_path}/log/1.json", f"text {k}"), range(24)))
    assert sum(done) == 1
    assert (tmp_path / "log" / "1.json").read_text() == f"text {done.index(True)}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_a_batch_counts_once(spark, path, monkeypatch):
    one = spark.createDataFrame([("a", 1, "x")], SHAPE)
    assert tables.append(one, path, ("w", 0))
    assert not tables.append(one, path, ("w", 0))
    assert tables.append(one, path, ("other", 0))

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(tables, "_put_if_absent", crash)
    with pytest.raises(OSError):
        tables.append(one, path, ("w", 1))
    monkeypatch.undo()
    assert tables.read_table(spark, path).count() == 2
    _while_writing(monkeypatch, lambda: tables.append(one, path, ("w", 1)))  # another run of the same writer
    assert not tables.append(one, path, ("w", 1))
    assert tables.read_table(spark, path).count() == 3
    merges = {"n": "target.n + source.n"}
    tables.upsert(one, f"{path}-m", ["id"], merges, batch=("w", 5))
    tables.upsert(one, f"{path}-m", ["id"], merges, batch=("w", 5))
    tables.upsert(one, f"{path}-m", ["id"], merges, batch=("w", 6))
    assert _rows(tables.read_table(spark, f"{path}-m")) == [("a", 2, "x")]


def test_old_versions_are_removed_with_what_only_they_need(spark, path):
    frame = spark.createDataFrame([(str(i), 1, "x") for i in range(200)], SHAPE)
    tables.create_if_absent(frame, path, keys=["id"])
    for i in range(3):
        tables.upsert(spark.createDataFrame([(str(i), 9, "y")], SHAPE), path, ["id"])
    wanted, files = _rows(tables.read_table(spark, path)), _files(path)
    assert tables.remove_old(spark, path, keep=2) == [0, 1]
    assert _files(path) == files  # younger than a week
    assert tables.remove_old(spark, path, keep=2, older_than_hours=-1) == []
    assert tables.versions(spark, path) == [2, 3]
    assert len(_files(path)) < len(files)
    assert _rows(tables.read_table(spark, path)) == wanted
    assert tables.read_table(spark, path, 2).where("n = 9").count() == 2
    with pytest.raises(ValueError):
        tables.read_table(spark, path, 0)
    tables.upsert(spark.createDataFrame([("7", 3, "z")], SHAPE), path, ["id"])
    assert tables.versions(spark, path) == [2, 3, 4]
    with pytest.raises(ValueError):
        tables.remove_old(spark, path, keep=0)


def test_lookups_read_few_rows(spark, path):
    frame = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("id"),
                                       F.col("id").cast("int").alias("n"), F.lit("x").alias("note"))
    tables.create_if_absent(frame, path, keys=["id"], slices=64)
    wanted = [row["id"] for row in frame.where("n IN (3, 40000)").collect()]
    found = tables.lookup(spark, path, [*wanted, "absent", None, wanted[0]])
    assert _rows(found.select("n")) == [(3,), (40_000,)]
    assert sum_of_scans(found) <= 0.05 * 60_000
    many = [row["id"] for row in frame.where("n < 3000").collect()]
    assert tables.lookup(spark, path, many).count() == 3_000
    assert tables.lookup(spark, path, frame.where("n < 3000").select("id").unionByName(
        frame.select(F.lit(None).cast("string").alias("id")).limit(2))).count() == 3_000
    assert tables.lookup(spark, path, []).count() == 0
    other = f"{path}-plain"
    tables.create_if_absent(frame.limit(3), other)
    with pytest.raises(ValueError, match="one key"):
        tables.lookup(spark, other, wanted)


def test_jdbc_reads_in_ranges():
    plain = relational.jdbc_options("u", "SELECT 1", user="x")
    assert plain == {"url": "u", "query": "SELECT 1", "user": "x"}
    ranged = relational.jdbc_options("u", "SELECT id FROM t", "id", (0, 9), 3)
    assert ranged == {"url": "u", "dbtable": "(SELECT id FROM t) AS asked", "partitionColumn": "id",
                      "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    with pytest.raises(ValueError):
        relational.jdbc_options("u", "SELECT id FROM t", "id")


def test_polls_bound_no_batch():
    assert "maxOffsetsPerTrigger" not in topics.poll_options("g", 1000)
    assert topics.poll_options("g", 1000, 5)["maxOffsetsPerTrigger"] == 5
    assert topics.poll_options("g", 1000)["kafka.max.poll.records"] == 1000
