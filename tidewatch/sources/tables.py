"""Versioned tables: create, append, merge, read a version, compact, remove old versions.

With the Delta Lake package on the classpath, pass `table_format="delta"`. Otherwise a table is a
folder of Parquet files and a log. `_log/<version>.json` names all that a version consists of: its
columns with their types, its partition columns, and the data folders it reads, most of which it
shares with the version before. Data folders are written first and never changed; the log entry
makes them count. An entry is put where none is, in one step, so of two writers who have read the
same version one has to look again. It then commits on top of the other's version, and does its
work again only if the other changed the very folders it has merged.

A table with keys is cut into slices by a hash of them. A merge reads and writes only slices in
which the source has keys; rows are sorted by key, with Bloom filters on the keys, so that
`lookup` opens one slice for each key and few row groups of it.

An entry also keeps the number of each writer's last batch: a batch that comes twice counts once.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FILE_BYTES = 256 * 1024 * 1024
SLICES = 16
_FOLDER, _SLICE = "_at", "_slice"
# Keys of a lookup that are written into the filter; more of them are joined.
_INLINE_KEYS = 1000

Entry = dict[str, Any]
# A data folder and, in a table with keys, the slice of it.
Part = tuple[str, int | None]
Batch = tuple[str, int]


# --- log --------------------------------------------------------------------------

def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was put there, whole; False if there is one.

    A draft takes the name in one step: by a hard link on a local disk, by a rename elsewhere.
    The store's rename must refuse a name that is taken, as that of HDFS does.
    """
    draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    files, source = _hadoop(spark, draft)
    out = files.create(source)
    out.write(bytearray(text.encode()))
    out.close()
    _, target = _hadoop(spark, path)
    if files.getUri().getScheme() != "file":
        done = not files.exists(target) and files.rename(source, target)
    else:
        def local(name):
            return spark._jvm.java.io.File(name.toUri().getPath()).toPath()

        try:
            spark._jvm.java.nio.file.Files.createLink(local(target), local(source))
            done = True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            done = False
    if files.exists(source):
        files.delete(source, False)
    return done


def _read_text(spark: SparkSession, path: str) -> str:
    files, target = _hadoop(spark, path)
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(target), "UTF-8"))
    try:
        return lines.readLine()
    finally:
        lines.close()


def versions(spark: SparkSession, path: str) -> list[int]:
    """The table's versions, oldest first."""
    return [int(name[:-5]) for name in _names(spark, f"{path}/_log")
            if name.endswith(".json") and name[:-5].isdigit()]


def _entry(spark: SparkSession, path: str, version: int) -> Entry:
    entry = json.loads(_read_text(spark, f"{path}/_log/{version:020d}.json"))
    entry["parts"] = [tuple(part) for part in entry["parts"]]
    return entry


def _newest(spark: SparkSession, path: str) -> tuple[int, Entry | None]:
    known = versions(spark, path)
    if known:
        return known[-1], _entry(spark, path, known[-1])
    if any(name.startswith("v=") for name in _names(spark, path)):
        raise ValueError(f"{path} holds snapshots without a log: read them as Parquet and create the table anew")
    return -1, None


def _commit(spark: SparkSession, path: str, prepare: Callable[[Entry | None], Entry | None]) -> int | None:
    """Put the entry that `prepare` makes of the newest one, as often as another writer is faster.

    Returns the version, or None if `prepare` has nothing to commit.
    """
    while True:
        version, base = _newest(spark, path)
        entry = prepare(base)
        if entry is None:
            return None
        if _put_if_absent(spark, f"{path}/_log/{version + 1:020d}.json", json.dumps(entry)):
            return version + 1


def _replaced(base: Entry, gone: Iterable[Part], parts: Iterable[Part], batch: Batch | None, **changes: Any) -> Entry:
    left = set(gone)
    batches = {**base["batches"], **({batch[0]: batch[1]} if batch else {})}
    return {**base, "parts": [p for p in base["parts"] if p not in left] + list(parts), "batches": batches, **changes}


def _is_done(base: Entry | None, batch: Batch | None) -> bool:
    return bool(base and batch and base["batches"].get(batch[0], -1) >= batch[1])


# --- data folders --------------------------------------------------------------------

def _slice_of(keys: Sequence[str], slices: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in keys]), F.lit(slices)).cast("int")


def _met(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of equal values together. AQE sizes these partitions by bytes, so a large group
    becomes several files; where it is off, as in stateful streams, they are dealt by hash."""
    dealt = [F.col(f"`{name}`") for name in columns]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *dealt)
    return df.repartition(*dealt)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], keys: Sequence[str], slices: int) -> list[Part]:
    """Write rows to a folder of their own; the parts it has. Nothing refers to it yet."""
    if {_FOLDER, _SLICE} & set(df.columns):
        raise ValueError(f"columns {_FOLDER} and {_SLICE} are the table's own")
    name = f"c{uuid.uuid4().hex}"
    place = f"{path}/data/{_FOLDER}={name}"
    if not slices:
        df.write.partitionBy(*partition_by).parquet(place)
        return [(name, None)]
    cut = _met(df.withColumn(_SLICE, _slice_of(keys, slices)), [_SLICE])
    evened = cut.sortWithinPartitions(*[F.col(f"`{name}`") for name in (_SLICE, *partition_by, *keys)])
    writer = evened.write.partitionBy(_SLICE, *partition_by)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(place)
    found = [folder.partition("=")[2] for folder in _names(df.sparkSession, place) if folder.startswith(f"{_SLICE}=")]
    return [(name, int(k)) for k in found]


def _frame(spark: SparkSession, path: str, entry: Entry, parts: Sequence[Part]) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    if not parts:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{_FOLDER}={name}" + ("" if k is None else f"/{_SLICE}={k}") for name, k in parts]
    # The table's own folder names are no columns of it.
    return (spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
            .select(*[f"`{name}`" for name in schema.names]))


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a stream's batches count: the id in its checkpoint."""
    return json.loads(_read_text(spark, f"{checkpoint}/metadata"))["id"]


def last_batch(spark: SparkSession, path: str, writer: str) -> int | None:
    """The number of a writer's last batch in the table."""
    _, entry = _newest(spark, path)
    return entry["batches"].get(writer) if entry else None


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The newest version's partition columns."""
    _, entry = _newest(spark, path)
    return entry["partition_by"] if entry else []


def key_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns by whose hash the newest version is cut into slices; none if it is not."""
    _, entry = _newest(spark, path)
    return entry["keys"] if entry and entry["slices"] else []


def _first(df: DataFrame, partition_by: Sequence[str], keys: Sequence[str], slices: int) -> Entry:
    """The entry of a table without rows."""
    return {"schema": df.schema.jsonValue(), "partition_by": list(partition_by), "keys": list(keys),
            "slices": slices if keys else 0, "parts": [], "batches": {}}


# --- operations ------------------------------------------------------------------------

def create_if_absent(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                     table_format: str = "parquet", keys: Sequence[str] = (), slices: int = SLICES) -> bool:
    """Write `df` as a new table; an existing table is left alone. True if written.

    With `keys` the table is cut into `slices`; they can't be partition columns or null.
    """
    spark = df.sparkSession
    if table_format == "delta":
        files, target = _hadoop(spark, f"{path}/_delta_log")
        if files.exists(target):
            return False
        df.write.format("delta").partitionBy(*partition_by).save(path)
        return True
    if _newest(spark, path)[1] is not None:
        return False
    entry = _first(df, partition_by, keys, slices)
    entry["parts"] = _write(df, path, partition_by, keys, entry["slices"])
    return _commit(spark, path, lambda base: entry if base is None else None) is not None


def read_table(spark: SparkSession, path: str, version: int | None = None,
               table_format: str = "parquet") -> DataFrame:
    """The table at `version`, or at its newest version."""
    if table_format == "delta":
        reader = spark.read.format("delta")
        return (reader if version is None else reader.option("versionAsOf", version)).load(path)
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no table at {path}")
    if version is None:
        version = known[-1]
    elif version not in known:
        raise ValueError(f"table at {path} has no version {version}")
    entry = _entry(spark, path, version)
    return _frame(spark, path, entry, entry["parts"])


def lookup(spark: SparkSession, path: str, keys: DataFrame | Iterable[Any]) -> DataFrame:
    """Rows of a table with one key column whose key is in a list, or in a table's first column.

    Only the slices of these keys are read. In their files, which are sorted by key, footers and
    Bloom filters rule out most row groups for a list of up to a thousand keys; more are joined.
    """
    _, entry = _newest(spark, path)
    if entry is None:
        raise FileNotFoundError(f"no table at {path}")
    if len(entry["keys"]) != 1:
        raise ValueError("a lookup needs a table with one key column")
    key = entry["keys"][0]
    kind = StructType.fromJson(entry["schema"])[key].dataType
    if isinstance(keys, DataFrame):
        wanted = None
        asked = keys.select(F.col(f"`{keys.columns[0]}`").cast(kind).alias(key)).distinct()
    else:
        wanted = list(dict.fromkeys(k for k in keys if k is not None))
        asked = spark.createDataFrame([(k,) for k in wanted], StructType().add(key, kind))
    # At most as many numbers as there are slices.
    touched = {row[0] for row in asked.select(_slice_of([key], entry["slices"])).distinct().collect()}
    rows = _frame(spark, path, entry, [part for part in entry["parts"] if part[1] in touched])
    if wanted is not None and len(wanted) <= _INLINE_KEYS:
        return rows.where(F.col(f"`{key}`").isin(wanted))
    return rows.join(asked, key, "left_semi").select(*[f"`{name}`" for name in rows.columns])


def append(df: DataFrame, path: str, batch: Batch | None = None, partition_by: Sequence[str] = ()) -> bool:
    """Add rows to a table, creating it when it is absent; False if the batch was there before.

    `batch` is a writer's name and a number that grows from batch to batch. It is committed
    together with the rows, so a batch repeated after a crash adds nothing. Columns are matched
    by name. Appends of several writers don't disturb each other.
    """
    spark = df.sparkSession
    _, base = _newest(spark, path)
    if _is_done(base, batch):
        return False
    shape = base or _first(df, partition_by, (), 0)
    rows = df if base is None else _in_shape(df, base)
    parts = _write(rows, path, shape["partition_by"], shape["keys"], shape["slices"])

    def prepare(newest: Entry | None) -> Entry | None:
        if _is_done(newest, batch):
            return None
        newest = newest or shape
        if any(newest[name] != shape[name] for name in ("keys", "slices", "partition_by")):
            raise RuntimeError(f"{path} was cut anew while rows were added; add them again")
        return _replaced(newest, (), parts, batch, operation="append")

    return _commit(spark, path, prepare) is not None


def _in_shape(df: DataFrame, entry: Entry) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    missing = set(schema.names) - set(df.columns)
    if missing:
        raise ValueError(f"source lacks columns {sorted(missing)}")
    return df.select(*[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in schema])


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update: Mapping[str, str] | None = None) -> DataFrame:
    """Target rows updated from matching source rows, plus the source rows without a match.

    `update` maps columns to SQL over the aliases `target` and `source`; by default
    every other column is taken from the source. Source rows with a NULL key match
    nothing and are left out. Two source rows with one key fail the job.
    """
    missing = set(target.columns) - set(source.columns)
    if missing:
        raise ValueError(f"source lacks columns {sorted(missing)}")
    values = [name for name in target.columns if name not in keys]
    if update is None:
        update = {name: f"source.`{name}`" for name in values}

    twice = F.raise_error(F.lit("several source rows with one merge key"))
    keyed = source.na.drop(subset=list(keys)).select(*keys, F.struct(*values).alias("row"))
    # Partial counts keep this one exchange on the keys, which the join then reuses.
    single = keyed.groupBy(*keys).agg(
        F.any_value("row").alias("row"), F.count("*").alias("copies"))
    single = single.select(*keys, "row.*", F.when(F.col("copies") > 1, twice)
                           .otherwise(F.lit(True)).cast("boolean").alias("_given"))

    left = target.withColumn("_kept", F.lit(True)).alias("target")
    same_key = [F.col(f"target.{key}") == F.col(f"source.{key}") for key in keys]
    both = left.join(single.alias("source"), same_key, "full")
    matched = F.col("source._given") & F.col("target._kept")

    def value(name: str):
        kept, given = F.col(f"target.{name}"), F.col(f"source.{name}")
        chosen = F.when(matched, F.expr(update[name])) if name in update else F.when(matched, kept)
        return chosen.when(F.col("source._given"), given).otherwise(kept).cast(
            target.schema[name].dataType).alias(name)

    return both.select(*[
        F.coalesce(f"target.{name}", f"source.{name}").alias(name) if name in keys else value(name)
        for name in target.columns])


def upsert(source: DataFrame, path: str, keys: Sequence[str],
           update: Mapping[str, str] | None = None, partition_by: Sequence[str] | None = None,
           table_format: str = "parquet", slices: int = SLICES, batch: Batch | None = None) -> None:
    """Merge `source` into the table at `path`, creating the table when it is absent.

    Without `partition_by` the table keeps its partition columns. Only slices with keys of the
    source are read and written. A table without slices, or with those of other keys or partition
    columns, is rewritten once, in `slices` of these keys. A `batch` that is already in the table
    changes nothing.
    """
    spark = source.sparkSession
    if table_format == "delta":
        _merge_delta(source, path, keys, update, partition_by or ())
        return
    _, base = _newest(spark, path)
    if _is_done(base, batch):
        return
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    # Written once: its keys are looked at before it is merged, and merged again after a conflict.
    source.na.drop(subset=list(keys)).write.parquet(staged)
    rows = spark.read.schema(source.schema).parquet(staged)
    merged_parts: dict[tuple[Part, ...], list[Part]] = {}

    def prepare(newest: Entry | None) -> Entry | None:
        if _is_done(newest, batch):
            return None
        entry = newest or _first(source, partition_by or (), keys, slices)
        folders = entry["partition_by"] if partition_by is None else list(partition_by)
        same_cut = list(entry["keys"]) == list(keys) and folders == entry["partition_by"]
        count = entry["slices"] if same_cut else slices
        old, types = entry["parts"], StructType.fromJson(entry["schema"])
        keyed = rows.withColumns({key: F.col(f"`{key}`").cast(types[key].dataType) for key in keys})
        if same_cut:
            # At most as many numbers as there are slices.
            touched = {row[0] for row in keyed.select(_slice_of(keys, count)).distinct().collect()}
            old = [part for part in old if part[1] in touched]
        if tuple(old) not in merged_parts:
            result = merged(_frame(spark, path, entry, old), keyed, keys, update)
            merged_parts[tuple(old)] = _write(result, path, folders, keys, count)
        return _replaced(entry, old, merged_parts[tuple(old)], batch, partition_by=folders,
                         keys=list(keys), slices=count, operation="merge")

    try:
        _commit(spark, path, prepare)
    finally:
        files, target = _hadoop(spark, staged)
        files.delete(target, True)


def _merge_delta(source: DataFrame, path: str, keys: Sequence[str], update: Mapping[str, str] | None,
                 partition_by: Sequence[str]) -> None:
    keyed = source.na.drop(subset=list(keys))
    create_if_absent(keyed.limit(0), path, partition_by, "delta")
    values = [name for name in source.columns if name not in keys]
    assignments = update or {name: f"source.`{name}`" for name in values}
    on = " AND ".join(f"target.`{key}` = source.`{key}`" for key in keys)
    changes = ", ".join(f"target.`{name}` = {text}" for name, text in assignments.items())
    source.sparkSession.sql(
        f"MERGE INTO delta.`{path}` AS target USING {{source}} AS source ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {changes} WHEN NOT MATCHED THEN INSERT *", source=keyed)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] | None = None,
            file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the newest version in files of about `file_bytes`; returns how many these take.

    Without `partition_by` the table keeps its partition columns. Rows that other writers add
    meanwhile stay as they are; if they change rewritten rows, the work is done again.
    """
    written: dict[tuple[Part, ...], list[Part]] = {}
    sizes: list[int] = []

    def prepare(base: Entry | None) -> Entry:
        if base is None:
            raise FileNotFoundError(f"no table at {path}")
        folders = base["partition_by"] if partition_by is None else list(partition_by)
        for old, parts in written.items():
            if set(old) <= set(base["parts"]) and folders == base["partition_by"]:
                return _replaced(base, old, parts, None, operation="compact")
        old = tuple(base["parts"])
        size = 0
        for name, k in old:
            files, target = _hadoop(spark, f"{path}/data/{_FOLDER}={name}" + ("" if k is None else f"/{_SLICE}={k}"))
            size += files.getContentSummary(target).getLength()
        sizes.append(max(1, math.ceil(size / file_bytes)))
        rows = _frame(spark, path, base, base["parts"])
        if not base["slices"]:
            # With partition columns, rows of one value must meet: AQE sizes and splits these by
            # bytes. Without, neighbouring input splits are joined, without a shuffle.
            rows = _met(rows, folders) if folders else rows.coalesce(sizes[-1])
        written[old] = _write(rows, path, folders, base["keys"], base["slices"])
        return _replaced(base, old, written[old], None, partition_by=folders, operation="compact")

    _commit(spark, path, prepare)
    return sizes[-1]


def remove_old(spark: SparkSession, path: str, keep: int = 10, older_than_hours: float = 168) -> list[int]:
    """Remove all versions but the newest `keep`, and the data that no version needs.

    Data younger than `older_than_hours` stays: a writer may be about to commit it, a reader may
    still read a version that is gone from the log. Returns the versions removed.
    """
    if keep < 1:
        raise ValueError("the newest version can't be removed")
    known = versions(spark, path)
    gone, kept = known[:-keep], known[-keep:]
    for version in gone:
        files, target = _hadoop(spark, f"{path}/_log/{version:020d}.json")
        files.delete(target, False)
    needed = {part for version in kept for part in _entry(spark, path, version)["parts"]}
    border = (time.time() - older_than_hours * 3600) * 1000
    files, _ = _hadoop(spark, path)
    places = []
    for folder in _names(spark, f"{path}/data"):
        name, inner = folder.partition("=")[2], _names(spark, f"{path}/data/{folder}")
        cut = [int(k.partition("=")[2]) for k in inner if k.startswith(f"{_SLICE}=")]
        own = [(name, k) for k in cut] or [(name, None)]
        if needed.isdisjoint(own):
            places.append(f"{path}/data/{folder}")
        else:
            places += [f"{path}/data/{folder}/{_SLICE}={k}" for _, k in own if (name, k) not in needed]
    places += [f"{path}/_staged/{name}" for name in _names(spark, f"{path}/_staged")]
    for place in places:
        _, target = _hadoop(spark, place)
        if files.getFileStatus(target).getModificationTime() <= border:
            files.delete(target, True)
    return gone
