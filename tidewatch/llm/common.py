"""Helpers shared by the training-data operators: inputs, Arrow batches, byte views."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.session import scratch_path

CHUNK_BYTES = 2_000_000
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, and a lost
    executor costs no recomputation of what stands before it."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def map_batches(frame: DataFrame, function: Callable, schema, rows: int = BATCH_ROWS) -> DataFrame:
    """`mapInArrow` with batches of at most `rows` rows. Rows here are whole texts or more, and the
    JVM and Python hold a batch each. The setting is the session's; it is read when a plan runs."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return frame.mapInArrow(function, schema)


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The batch's texts: a column of that name, or a field of packed rows."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")


def chunks(batches: Iterator[pa.RecordBatch], target: int = CHUNK_BYTES,
           values_of: Callable = text_of) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `target` bytes of text; a longer text stands alone."""
    for batch in batches:
        values = values_of(batch)
        if len(values) == 0:
            continue
        ends = np.cumsum(np.diff(offsets_of(filled(values))))
        first = 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + target, side="right")))
            yield batch.slice(first, last - first)
            first = last


def offsets_of(values: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) \
        else np.int32
    raw = np.frombuffer(values.buffers()[1], dtype=kind)
    return raw[values.offset:values.offset + len(values) + 1].astype(np.int64)


def filled(values: pa.Array) -> pa.Array:
    """The values with empty ones for null."""
    if pa.types.is_null(values.type):
        values = values.cast(pa.string())
    return values.fill_null(b"" if pa.types.is_binary(values.type) else "") if values.null_count else values


def byte_view(values: pa.Array, pad: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The values' bytes end to end, zero-padded by `pad`, and their boundaries; null is empty."""
    values = filled(values)
    offsets = offsets_of(values)
    data = values.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    view = np.zeros(offsets[-1] - offsets[0] + pad, np.uint8)
    view[:offsets[-1] - offsets[0]] = raw[offsets[0]:offsets[-1]]
    return view, offsets - offsets[0]


def packed(frame: DataFrame, *columns: Column) -> DataFrame:
    """Each row as one struct named row, beside `columns`: no name of the frame can clash."""
    whole = F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias("row")
    return frame.select(whole, *columns)


def unpacked(frame: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns of packed rows, some of them replaced or added."""
    names = [*columns, *(name for name in replaced if name not in columns)]
    return frame.select(*[replaced.get(name, F.col("row").getField(name)).alias(name) for name in names])


def with_text(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Packed rows with the new text beside them, n_chars set anew where there is one."""
    replaced = {"text": F.col("text")}
    if "n_chars" in columns:
        replaced["n_chars"] = F.char_length("text").cast("long")
    return unpacked(frame, columns, **replaced)
