"""WARC archives: segmented writing, revisits of equal payloads, and segment reassembly."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import map_batches, stored
from tidewatch.session import scratch_path

# Every record starts with its version, so Spark's text reader can split archives there. What a
# split has torn apart inside a record is joined again by the record's length.
RECORD_START = "WARC/1."
SEGMENT_CHARS = 16_384
CHUNK_CHARS = 4_096
REVISIT_BYTES = 1_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Pages come without the time of their capture; the format wants one.
NO_DATE = "1970-01-01T00:00:00Z"

_WRITTEN = pa.schema([("value", pa.string())])
_READ = ("record_id string, record_type string, target_uri string, date string, refers_id string, origin_id string, "
         "number int, total_length long, digest string, block binary")
_READ_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_OWN_ID = re.compile(r"<urn:page:(-?\d*):\d+>")


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, n_bytes, serial, refers_to and refers_serial for every page.

    Of equal payloads of at least `least_bytes` bytes, the largest page_id is stored and the
    others refer to it. A null html is an empty payload. Rows that repeat the largest page_id
    are all stored; so is a payload whose page_ids are all null.
    """
    body = F.coalesce("html", F.lit(""))
    known = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"),
                         F.octet_length(body).cast("long").alias("n_bytes"),
                         F.monotonically_increasing_id().alias("serial"))
    # Only payloads that occur again go on; each map task sends one row per payload.
    repeated = (known.where(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes")
                .agg(F.max(F.struct("page_id", "serial")).alias("kept"), F.count("*").alias("copies"))
                .where("copies > 1").select("digest", "n_bytes", "kept"))
    revisit = F.col("kept.page_id").isNotNull() & ~F.col("kept.page_id").eqNullSafe(F.col("page_id"))
    return (known.join(repeated, ["digest", "n_bytes"], "left")
            .select("page_id", "url", "html", "digest", "n_bytes", "serial",
                    F.when(revisit, F.col("kept.page_id")).alias("refers_to"),
                    F.when(revisit, F.col("kept.serial")).alias("refers_serial")))


def chunked(payload: str, size: int = CHUNK_CHARS) -> str:
    """Chunked transfer framing; a chunk border falls into every occurrence of RECORD_START."""
    borders = set(range(size, len(payload), size))
    borders.update(m.start() + 1 for m in re.finditer(re.escape(RECORD_START), payload))
    cuts = [0, *sorted(borders), len(payload)]
    parts = (payload[a:b] for a, b in zip(cuts, cuts[1:]) if a < b)
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload inside chunked framing; raises when the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError(f"chunk at byte {at} doesn't end where its size says")
        parts.append(body[at:at + size])
        at += size + 2


def _record(kind: str, fields: list[tuple[str, object]], block: str) -> str:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block.encode())}\r\n\r\n{block}"


def record_id(page_id: int | None, serial: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{serial}>"


def records_of(serial: int, page_id, url, html, digest, n_bytes, refers_to, refers_serial=None,
               segment: int = SEGMENT_CHARS, date: str = NO_DATE) -> list[str]:
    """The records of one page: a revisit, or a response with its continuations."""
    name = record_id(page_id, serial)
    about = [("WARC-Record-ID", name), ("WARC-Date", date),
             ("WARC-Target-URI", quote(url or "", safe=":/?#&=%+,;@")),
             ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n_bytes}\r\n\r\n"
        return [_record("revisit", [*about, ("WARC-Refers-To", record_id(refers_to, refers_serial)),
                                    ("WARC-Profile", PROFILE)], block)]
    block = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
             f"Transfer-Encoding: chunked\r\n\r\n{chunked(html)}")
    parts = [block[a:a + segment] for a in range(0, len(block), segment)]
    if len(parts) == 1:
        return [_record("response", about, block)]
    made = [_record("response", [*about, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [("WARC-Record-ID", f"<urn:segment:{serial}:{number}>"), ("WARC-Date", date),
                  ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", number)]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", len(block.encode())))
        made.append(_record("continuation", fields, part))
    return made


def write_archives(pages: DataFrame, path: str, least_bytes: int = REVISIT_BYTES,
                   segment: int = SEGMENT_CHARS, date: str = NO_DATE) -> None:
    """Write gzip archives of all pages below `path`; continuations may lie in other files.

    A file is one gzip stream, as Spark's text writer makes it; the format recommends one for
    each record, which only matters to readers that jump to a record.
    """
    columns = ("serial", "page_id", "url", "html", "digest", "n_bytes", "refers_to", "refers_serial")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200).to_pydict()
                texts = [text for row in zip(*(part[c] for c in columns))
                         for text in records_of(*row, segment=segment, date=date)]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], schema=_WRITTEN)

    (map_batches(with_revisits(pages, least_bytes), write, "value string").write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", 50_000).text(path))


# --- reading -----------------------------------------------------------------------

def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with a blank goes on with the last."""
    lines: list[str] = []
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        else:
            lines.append(line)
    pairs = (line.partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(record: bytes) -> int | None:
    """Where the record's block ends; None if not even its header is whole."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = re.search(rb"(?im)^content-length\s*:\s*(\d+)", record[:end])
    if not found:
        raise ValueError(f"a record without a length: {record[:80]!r}")
    return end + 4 + int(found[1])


def _parsed(record: bytes) -> tuple:
    """A whole record as a row of `_READ`, whatever the order and case of its fields."""
    end = record.index(b"\r\n\r\n")
    fields = _fields(record[:end])

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    return (fields.get("warc-record-id"), fields.get("warc-type", "").lower(), fields.get("warc-target-uri"),
            fields.get("warc-date"), fields.get("warc-refers-to"), fields.get("warc-segment-origin-id"),
            number("warc-segment-number"), number("warc-segment-total-length"), fields.get("warc-payload-digest"),
            bytes(record[end + 4:_length(record)]))


def _records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
    """Whole records from what stands between record starts, by file and in order: a start inside
    a record's own block or header has torn it."""
    start, torn, file, wanted = RECORD_START.encode(), bytearray(), None, None
    for name, piece in pieces:
        if torn and name != file:
            raise ValueError(f"{file}: a record is cut short: {bytes(torn[:200])!r}")
        if not torn and not piece.strip():
            continue  # what stands before the first record
        torn += start + piece
        file = name
        if wanted is None:
            wanted = _length(torn)
        if wanted is not None and len(torn) >= wanted:
            if torn[wanted:].strip():
                raise ValueError(f"{file}: a record is longer than it says: {bytes(torn[:200])!r}")
            yield bytes(torn)
            torn, wanted = bytearray(), None
    if torn:
        raise ValueError(f"{file}: a record is cut short: {bytes(torn[:200])!r}")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzip archives below `path`, continuations not yet joined.

    Archives of other writers are read as well: WARC 1.0 and 1.1, fields in any order and case,
    one gzip stream for each record or for the file, any bytes in blocks. A file is read by one task.
    """
    names = [part.split()[0] for part in _READ.split(", ")]
    schema = pa.schema([(part.split()[0], _READ_TYPES[part.split()[1]]) for part in _READ.split(", ")])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

        for record in _records(pieces(batches)):
            rows.append(_parsed(record))
            if len(rows) == 500:
                yield made()
                rows.clear()
        yield made()

    text = spark.read.option("lineSep", RECORD_START).text(path)
    return map_batches(text.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")),
                       read, _READ)


def payload_of(parts: list[tuple[int | None, bytes]], total: int | None) -> tuple[bytes, bytes]:
    """Join segments by number, verify count and total length, and undo HTTP and chunk framing.

    Returns the payload, and the body as it was sent.
    """
    block = b"".join(piece for _, piece in parts)
    if total is not None and (len(block) != total or [n for n, _ in parts] != list(range(1, len(parts) + 1))):
        raise ValueError(f"segments {[n for n, _ in parts]} hold {len(block)} of {total} bytes")
    if not block.startswith(b"HTTP/"):
        return block, block
    head, _, body = block.partition(b"\r\n\r\n")
    is_chunked = re.search(rb"(?im)^transfer-encoding\s*:\s*chunked", head)
    return (dechunked(body) if is_chunked else body), body


def _is_digest(text: str, data: bytes) -> bool:
    """Whether `algorithm:digest`, in hexadecimal or base 32, is that of the data; one of an
    algorithm that is not known here says nothing."""
    kind, _, value = text.partition(":")
    if kind.lower().replace("-", "") not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(kind.lower().replace("-", ""), data)
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _sha1_of(text: str | None) -> str | None:
    """The hexadecimal form of a SHA-1 `sha1:digest`; null for another algorithm or none."""
    kind, _, value = (text or "").partition(":")
    if kind.lower().replace("-", "") != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


_DECODED = "record_id string, record_type string, refers_id string, digest string, payload_bytes long, payload binary"


def _decoded(records: DataFrame, with_payload: bool) -> DataFrame:
    """Responses, resources and revisits with their payloads' sizes and digests, verified."""
    names = [part.split()[0] for part in _DECODED.split(", ")]
    schema = pa.schema([(part.split()[0], _READ_TYPES[part.split()[1]]) for part in _DECODED.split(", ")])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for r in batch.slice(at, 200).to_pylist():
                    if r["record_type"] == "revisit":
                        rows.append((r["record_id"], "revisit", r["refers_id"], _sha1_of(r["digest"]), None, None))
                        continue
                    payload, body = payload_of([(p["number"], p["block"]) for p in r["parts"]], r["total_length"])
                    if r["digest"] and not (_is_digest(r["digest"], payload) or _is_digest(r["digest"], body)):
                        raise ValueError(f"record {r['record_id']}: its payload is not that of {r['digest']}")
                    rows.append((r["record_id"], r["record_type"], None, hashlib.sha1(payload).hexdigest(),
                                 len(payload), payload if with_payload else None))
                columns = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    part = F.struct("number", "block").alias("part")
    kept = records.where("record_type IN ('response', 'resource', 'revisit', 'continuation')")
    whole = kept.where("number is null").select("record_id", "record_type", "refers_id", "digest", "total_length",
                                                F.array(part).alias("parts"))
    joined = (kept.where("number is not null").groupBy(F.coalesce("origin_id", "record_id").alias("record_id"))
              .agg(F.max(F.when(F.col("record_type") != "continuation", F.col("record_type"))).alias("record_type"),
                   F.max("refers_id").alias("refers_id"), F.max("digest").alias("digest"),
                   F.coalesce(F.max("total_length"), F.lit(-1)).alias("total_length"),
                   F.sort_array(F.collect_list(part)).alias("parts")))
    return map_batches(whole.unionByName(joined), decode, _DECODED)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, complete: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (and payload) per record.

    Whole records are decoded where they are read; only segments are shuffled, grouped by
    origin, which is one page each. A revisit has the size and digest of the record it refers to;
    that record must have the revisit's digest, and must be there unless the archives are not
    `complete`. A missing segment, a wrong length, broken chunks or a digest that differs fail
    the job. page_id and refers_to are null for records of other writers, whose names hold no
    page. An archive without records gives no rows.
    """
    found = stored(_decoded(read_records(spark, path), with_payload), "decoded")
    meant = found.where("record_type != 'revisit'").select(
        F.col("record_id").alias("refers_id"), F.col("digest").alias("meant"), F.col("payload_bytes").alias("size"))
    revisits = found.where("record_type = 'revisit'").join(meant, "refers_id", "left")

    def page(name: str):
        return F.regexp_extract(name, _OWN_ID.pattern, 1).try_cast("long")

    wrong = F.raise_error(F.concat(F.lit("revisit "), "record_id", F.lit(" does not agree with the record "),
                                   F.coalesce("refers_id", F.lit("it does not name"))))
    agrees = F.coalesce(F.col("digest") == F.col("meant"), F.col("meant").isNotNull() | F.lit(not complete))
    revisits = revisits.select(
        page("record_id").alias("page_id"), F.when(agrees, F.col("size")).otherwise(wrong.cast("long")).alias("payload_bytes"),
        F.coalesce("meant", "digest").alias("payload_digest"), "record_type", page("refers_id").alias("refers_to"),
        F.lit(None).cast("binary").alias("payload"))
    others = found.where("record_type != 'revisit'").select(
        page("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"), "payload")
    every = others.unionByName(revisits)
    return every if with_payload else every.drop("payload")


def round_trip(pages: DataFrame, least_bytes: int = REVISIT_BYTES,
               segment: int = SEGMENT_CHARS) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes, segment)
    return read_archives(spark, path)
