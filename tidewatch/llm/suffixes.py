"""Suffix-array dedup: bytes inside strings of a fixed length that also start somewhere else.

A window is the string of `LENGTH` bytes from one start. Its anchor is the smallest hash of the
`SEED`-byte strings in it, so equal windows have equal anchors, wherever they stand. Neighbouring
windows with one anchor form a run, and the bytes of a run are its context.

1. Runs are shuffled as (anchor, context hash, place). A run whose context occurs again is
   repeated as a whole. An anchor with one context only needs no more work.
2. For anchors with several contexts, one copy of each context is sent to the anchor's bucket.
3. Buckets are sorted one small block at a time: windows by their first bytes, long ties by the
   ranks of a difference-cover sample (Burkhardt and Karkkainen 2003), computed before. Neighbours
   in that suffix order that share the whole window are repeated.

Only step 3 looks at text, and its memory is a block, however long or frequent the repeats are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pyspark.sql.types import StringType, StructField, StructType

from tidewatch.llm.common import byte_view, chunks, map_batches, packed, stored, text_of, with_text

LENGTH = 200
SEED = 32
CHUNK_BYTES = 1_000_000
BLOCK_BYTES = 2_000_000
# From this many contexts on, an anchor's windows are spread over buckets of their own.
BUSY_CONTEXTS = 4_000
COPIES, TWICE, WHOLE = 1, 2, 4  # flags of a run

# A difference cover; every distance modulo the period occurs between two of them.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
RANK_WORDS = 4  # a sample suffix is ranked by 8 bytes times this; at least the period

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M1
    x ^= x >> np.uint64(32)
    x += b
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _words(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes from every position on as one number, in an array of one less than 8 fewer."""
    return np.ndarray((max(0, len(data) - 7),), f"{order}u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)


def _seeds(data: np.ndarray) -> np.ndarray:
    """Hashes of the SEED bytes from every position on."""
    hashes, width = _words(data), 8
    while width < SEED:
        hashes = _mix(hashes[:-width], hashes[width:])
        width *= 2
    return hashes


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbouring values."""
    least, reach = values, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[:len(least) - (width - reach)], least[width - reach:])


def _context_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: differences of prefix sums, moved to a common power."""
    table = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    power = np.full(len(data) + 1, _M2)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:-1], out=sums[1:])
    power[1:] = np.uint64(pow(int(_M2), -1, 1 << 64))
    np.cumprod(power, out=power)
    return _mix((sums[end] - sums[begin]) * power[begin], (end - begin).astype(np.uint64))


def runs_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, first window, number of windows, anchor, context hash and flags of each run.

    `data` is the texts' bytes end to end with some padding; matches never cross texts. A run has
    at most as many windows as contain one seed.
    """
    width = LENGTH - SEED + 1
    sizes = np.diff(bounds)
    count = np.maximum(0, sizes - LENGTH + 1)
    total = int(count.sum())
    if total == 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    of = np.repeat(np.arange(len(sizes)), count)
    starts = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + bounds[:-1][of]
    seeds = _seeds(data)
    anchors = _least(seeds, width)[starts]
    new = np.ones(total, bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])
    heads = np.nonzero(new)[0]
    within = np.arange(total) - np.repeat(heads, np.diff(np.append(heads, total)))
    heads = np.nonzero(within % width == 0)[0]
    lengths = np.diff(np.append(heads, total))
    begin, anchor, text = starts[heads], anchors[heads], of[heads]
    context = _context_hashes(data, begin, begin + lengths + LENGTH - 1)
    flags = np.zeros(len(heads), np.int64)
    # Where a seed stands twice among the seeds of a run, two of its windows may be equal.
    for at in range(0, len(heads), 2_000):
        some = slice(at, at + 2_000)
        place = begin[some, None] + np.arange(2 * width)
        inside = np.arange(2 * width) < (lengths[some] + width - 1)[:, None]
        equal = seeds[np.minimum(place, len(seeds) - 1)] == anchor[some, None]
        flags[some] |= np.where((equal & inside).sum(1) > 1, TWICE, 0)
    # Copies inside this piece of the corpus needn't be shuffled to be found.
    order = np.lexsort((np.arange(len(heads)), context, anchor))
    same = (anchor[order][1:] == anchor[order][:-1]) & (context[order][1:] == context[order][:-1])
    again = np.concatenate([[False], same])
    flags[order[again]] |= WHOLE
    flags[order[np.concatenate([same, [False]]) & ~again]] |= COPIES
    return text, begin - bounds[text], lengths, anchor, context, flags


def anchor_runs(keyed: DataFrame) -> DataFrame:
    """(anchor, context, row_key, place) of the runs of every text; place holds the first window,
    the number of windows and the flags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, CHUNK_BYTES):
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            text, first, count, anchor, context, flags = runs_of(*byte_view(batch.column("text"), LENGTH))
            own = keys[text]
            # Runs already known as repeated are only passed on: any partition will do.
            anchor = np.where(flags & WHOLE, _mix(own.view(np.uint64), first.astype(np.uint64)), anchor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(own),
                 pa.array((first << 16) | (count << 3) | flags)],
                names=["anchor", "context", "row_key", "place"])

    return map_batches(keyed.select("row_key", "text"), run,
                       "anchor long, context long, row_key long, place long")


def judged_runs(runs: DataFrame) -> DataFrame:
    """Runs that are repeated as a whole (`whole`), or whose context is to be compared with the
    anchor's other ones (`compare`); `busy` where there are many of these."""
    by_anchor = Window.partitionBy("anchor")
    in_turn = by_anchor.orderBy("context")
    flags = F.col("place").bitwiseAND(7)
    has = lambda flag: flags.bitwiseAND(flag) != 0
    near = runs.select(
        "*", F.lag("context").over(in_turn).alias("before"), F.lead("context").over(in_turn).alias("after"),
        F.min("context").over(by_anchor).alias("low"), F.max("context").over(by_anchor).alias("high"))
    first = ~F.col("before").eqNullSafe(F.col("context"))
    marked = near.withColumn("first", first)
    many = F.sum(F.col("first").cast("long")).over(by_anchor)
    again = F.col("before").eqNullSafe(F.col("context")) | F.col("after").eqNullSafe(F.col("context"))
    return (marked.withColumn("busy", many > BUSY_CONTEXTS)
            .withColumn("whole", again | has(COPIES) | has(WHOLE))
            .withColumn("compare", ~has(WHOLE) & F.col("first") & ((F.col("low") < F.col("high")) | has(TWICE)))
            .where("whole or compare")
            .select("anchor", "row_key", "whole", "compare", "busy",
                    F.shiftright("place", 16).alias("first"),
                    F.shiftright("place", 3).bitwiseAND(8191).alias("windows")))


def _refined(order: np.ndarray, head: np.ndarray, active: np.ndarray, key: np.ndarray) -> None:
    """Sort the active slots inside their groups by key; `head` marks the slots that start one."""
    group = np.cumsum(head)[active]
    place = np.lexsort((key, group))
    order[active] = order[active][place]
    key, same = key[place], group[1:] == group[:-1]
    head[active[1:]] |= same & (key[1:] != key[:-1])


def _tied(head: np.ndarray, done: np.ndarray | None = None) -> np.ndarray:
    """Slots of groups with more than one member."""
    alone = head & np.append(head[1:], True)
    return np.nonzero(~alone if done is None else ~(alone | done))[0]


def cover_ranks(words: np.ndarray, size: int) -> np.ndarray:
    """At the positions of the cover, ranks by the next 8 * RANK_WORDS bytes; zero elsewhere."""
    sample = np.nonzero(np.isin(np.arange(size) % PERIOD, COVER))[0]
    order, head = np.arange(len(sample)), np.zeros(len(sample), bool)
    if len(sample):
        head[0] = True
    for word in range(RANK_WORDS):
        active = _tied(head)
        _refined(order, head, active, words[sample[order[active]] + 8 * word])
    ranks = np.zeros(size, np.int32)
    ranks[sample[order]] = np.cumsum(head)
    return ranks


def _meeting() -> np.ndarray:
    """For two residues, the least step that takes both into the cover."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    a, b, step = np.ogrid[:PERIOD, :PERIOD, :PERIOD]
    return np.argmax(inside[(a + step) % PERIOD] & inside[(b + step) % PERIOD], axis=2)


def repeated_windows(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Which windows of a block equal another one of their bucket.

    `text` ends in padding of at least twice the window. Suffixes are sorted bucket by bucket,
    by words while these are shorter than the cover's period. What is still tied goes by ranks of
    the cover sample: both suffixes are moved by the least step that takes them into the cover,
    then on by whole periods. Groups are split around a pivot, all groups at once.
    """
    if not len(starts):
        return np.zeros(0, bool)
    words = _words(text, ">")
    order = np.argsort(bucket, kind="stable")
    head = np.ones(len(order), bool)
    head[1:] = bucket[order][1:] != bucket[order][:-1]
    for word in range((PERIOD + 7) // 8):
        active = _tied(head)
        _refined(order, head, active, words[starts[order[active]] + 8 * word])
    share = head.copy()  # groups that agree in the bytes compared so far
    ranks = cover_ranks(words, len(words) - 8 * RANK_WORDS)
    meeting, done = _meeting(), np.zeros(len(order), bool)
    while len(active := _tied(head, done)):
        group = np.cumsum(head) - 1
        begin = np.nonzero(head)[0]
        middle = begin + np.diff(np.append(begin, len(head))) // 2
        own, pivot = starts[order[active]], starts[order[middle[group[active]]]]
        at = meeting[own % PERIOD, pivot % PERIOD]
        side, open_ = np.ones(len(active), np.int8), np.arange(len(active))
        for step in range(0, LENGTH, PERIOD):
            move = at[open_] + step
            mine, its = ranks[own[open_] + move], ranks[pivot[open_] + move]
            side[open_] += np.sign(mine - its).astype(np.int8)
            open_ = open_[mine == its]
            if not len(open_):
                break
        equal = np.zeros(len(order), np.int8)
        equal[order[active]] = side
        _refined(order, head, active, side)
        done[active] = equal[order[active]] == 1
    # Neighbours that share all bytes of the window.
    later = np.nonzero(~share)[0]
    left, right = starts[order[later - 1]], starts[order[later]]
    for word in range(LENGTH // 8):
        agree = words[left + 8 * word] == words[right + 8 * word]
        later, left, right = later[agree], left[agree], right[agree]
    found = np.zeros(len(order), bool)
    found[order[later]] = True
    found[order[later - 1]] = True
    return found


def contexts(keyed: DataFrame, judged: DataFrame) -> DataFrame:
    """(bucket, row_key, first, context) of the runs to compare. A busy anchor's windows get a row
    and a bucket each, by the hash of all their bytes, without the bytes; `twice` marks those
    that occur again in the same piece of the corpus, of which one only is sent to the bucket."""
    wanted = (judged.where("compare").groupBy("row_key").agg(F.collect_list(
        F.struct("anchor", "first", "windows", "busy")).alias("runs")))
    joined = keyed.select("row_key", "text").join(wanted, "row_key")
    schema = "bucket long, row_key long, first long, twice boolean, context binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, CHUNK_BYTES):
            data, bounds = byte_view(batch.column("text"), LENGTH)
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            lists = batch.column("runs")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            anchor = flat.field("anchor").to_numpy()
            first, count = flat.field("first").to_numpy(), flat.field("windows").to_numpy()
            busy = flat.field("busy").to_numpy(zero_copy_only=False)
            begin = bounds[owner] + first
            raw = data.tobytes()
            plain = np.nonzero(~busy)[0]
            cut = [raw[a:b] for a, b in zip(begin[plain].tolist(), (begin + count + LENGTH - 1)[plain].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[plain]), pa.array(keys[owner[plain]]), pa.array(first[plain]),
                 pa.array(np.zeros(len(plain), bool)), pa.array(cut, pa.binary())],
                names=["bucket", "row_key", "first", "twice", "context"])
            many = np.nonzero(busy)[0]
            if len(many):
                run_of = np.repeat(many, count[many])
                step = np.arange(len(run_of)) - np.repeat(np.cumsum(count[many]) - count[many], count[many])
                place = begin[run_of] + step
                hashed = _mix(_context_hashes(data, place, place + LENGTH), anchor[run_of].view(np.uint64))
                _, lead, inverse, times = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
                copy = np.ones(len(hashed), bool)
                copy[lead] = False
                # Later copies are settled; the first one stands for all of them.
                bucket = np.where(copy, _mix(keys[owner[run_of]].view(np.uint64), place.astype(np.uint64)), hashed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), pa.array(keys[owner[run_of]]),
                     pa.array(first[run_of] + step), pa.array(times[inverse] > 1),
                     pa.nulls(len(hashed), pa.binary())],
                    names=["bucket", "row_key", "first", "twice", "context"])

    return map_batches(joined, run, schema)


def compared(rows: DataFrame) -> DataFrame:
    """(row_key, first, windows): ranges of repeated windows among the contexts' ones."""
    schema = "row_key long, first long, windows long"

    def settle(bucket, key, first, twice, texts) -> pa.RecordBatch:
        none = np.array([t is None for t in texts])
        # Windows by hash: equal buckets are equal windows.
        alone = np.nonzero(none)[0]
        _, inverse, times = np.unique(bucket[alone], return_inverse=True, return_counts=True)
        hit = alone[(times[inverse] > 1) | twice[alone]] if len(alone) else alone
        keys, firsts, counts = [key[hit]], [first[hit]], [np.ones(len(hit), np.int64)]
        full = np.nonzero(~none)[0]
        if len(full):
            size = np.array([len(texts[i]) for i in full])
            base = np.cumsum(size) - size
            text = np.frombuffer(b"".join([texts[i] for i in full]) + bytes(4 * LENGTH), np.uint8)
            windows = size - LENGTH + 1
            of = np.repeat(np.arange(len(full)), windows)
            step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            again = repeated_windows(text, base[of] + step, bucket[full][of])
            edge = np.ones(len(of) + 1, bool)
            edge[1:-1] = (of[1:] != of[:-1]) | (again[1:] != again[:-1])
            cut = np.nonzero(edge)[0]
            lead = cut[:-1]
            good = again[lead]
            keys.append(key[full][of[lead[good]]])
            firsts.append(first[full][of[lead[good]]] + step[lead[good]])
            counts.append(np.diff(cut)[good])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in (keys, firsts, counts)],
            names=["row_key", "first", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                new = [part.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "row_key", "first", "twice")]
                new.append(np.array(part.column("context").to_pylist() + [None], object)[:-1])
                waiting = [np.concatenate(c) for c in zip(waiting, new)] if waiting else new
                size += sum(len(t or b"") + 40 for t in new[4])
                if size < BLOCK_BYTES:
                    continue
                # The last bucket may go on. Of windows known by hash, one is enough to wait.
                split = int(np.searchsorted(waiting[0], waiting[0][-1]))
                if waiting[4][-1] is None and split < len(waiting[0]) - 1:
                    split = len(waiting[0])
                    last = [c[-1:] for c in waiting]
                    last[3] = np.array([True])
                else:
                    last = [c[split:] for c in waiting]
                if split:
                    yield settle(*(c[:split] for c in waiting))
                waiting, size = last, sum(len(t or b"") + 40 for t in last[4])
        if waiting:
            yield settle(*waiting)

    return map_batches(rows.repartition("bucket").sortWithinPartitions("bucket"), run, schema)


def repeated_ranges(documents: DataFrame) -> DataFrame:
    """row_key and ranges, an array of (first, windows), of the texts with repeated windows."""
    # Rows share a key only if id and text are equal; they lose the same bytes then.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))
    judged = stored(judged_runs(anchor_runs(keyed)), "runs")
    found = compared(contexts(keyed, judged))
    whole = judged.where("whole").select("row_key", F.col("first").cast("long").alias("first"),
                                         F.col("windows").cast("long").alias("windows"))
    return (found.unionByName(whole).groupBy("row_key")
            .agg(F.collect_list(F.struct("first", "windows")).alias("ranges")))


def removed_spans(ranges: np.ndarray) -> np.ndarray:
    """Sorted byte spans covered by windows, given as rows of (first, windows); touching spans
    are one."""
    order = np.argsort(ranges[:, 0], kind="stable")
    begin = ranges[order, 0]
    end = np.maximum.accumulate(begin + ranges[order, 1] + LENGTH - 1)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    heads = np.nonzero(new)[0]
    return np.stack([begin[heads], end[np.append(heads[1:] - 1, len(end) - 1)]], 1)


def with_spans(documents: DataFrame) -> DataFrame:
    """row (the packed input) and ranges, null where nothing is repeated."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = packed(documents, F.xxhash64("doc_id", text).alias("row_key"))
    return keyed.join(repeated_ranges(documents), "row_key", "left").drop("row_key")


def _spans_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    lists = batch.column("ranges")
    bounds = lists.offsets.to_numpy()
    flat = lists.flatten()
    pairs = np.stack([flat.field("first").to_numpy(), flat.field("windows").to_numpy()], 1)
    sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(bounds), 0)
    at = 0
    for size in sizes.tolist():
        yield removed_spans(pairs[at:at + size]) if size else np.zeros((0, 2), np.int64)
        at += size


def dedup_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    A null text is empty; texts shorter than a window lose nothing; of equal texts that are long
    enough nothing is left, repeated rows included. An empty table gives no rows.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, bounds = byte_view(batch.column("text"))
            raw, sizes, removed, spans, digests = data.tobytes(), np.diff(bounds), [], [], []
            for base, size, own in zip(bounds.tolist(), sizes.tolist(), _spans_of(batch)):
                edges = [0, *own.ravel().tolist(), size]
                kept = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2]):
                    kept.update(raw[base + a:base + b])
                removed.append(int((own[:, 1] - own[:, 0]).sum()))
                spans.append(len(own))
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_spans(documents.select("doc_id", "text"))
    return map_batches(rows.selectExpr("cast(row.doc_id as long) doc_id", "coalesce(row.text, '') text", "ranges"),
                       run, schema)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The documents without the bytes of repeated windows, and n_chars set anew.

    All rows stay, as do other columns. A character of which only some bytes are covered goes too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = text_of(batch).to_pylist()
            for i, own in enumerate(_spans_of(batch)):
                if len(own):
                    raw = texts[i].encode()
                    edges = [0, *own.ravel().tolist(), len(raw)]
                    texts[i] = "".join(raw[a:b].decode(errors="ignore") for a, b in zip(edges[::2], edges[1::2]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows = with_spans(documents)
    schema = StructType([rows.schema["row"], StructField("text", StringType())])
    return with_text(map_batches(rows, run, schema), documents.columns)
