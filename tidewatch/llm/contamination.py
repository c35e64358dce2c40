"""Benchmark decontamination with an FM-index per training shard.

A shard is a few megabytes of documents. Its words that occur in the benchmark become a sequence
of numbers; every other word ends a run. The sequence's suffix array gives the Burrows-Wheeler
transform, a wavelet matrix counts symbols in it, and all test phrases are searched backwards at
once. Occurrences are located by walking to sampled suffix positions, and overlapping ones are
merged to removal spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pyspark.sql.types import StringType, StructField, StructType

from tidewatch.llm.common import byte_view, chunks, map_batches, packed, text_of, with_text

WINDOW = 10
BLOCK_BYTES = 8_000_000
SHARD_BYTES = 2_000_000
SAMPLE_STEP = 8

_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
# Bytes of words, A-Z in lower case; zero for all others.
_LOWER = np.zeros(256, np.uint64)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and 64-bit hash of every word of texts laid end to end."""
    size = int(bounds[-1])
    values = _LOWER[data[:size]]
    inside = np.zeros(size + 1, bool)
    inside[:size] = values != 0
    before = np.concatenate([[False], inside[:-1]])
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    starts = np.nonzero(inside & (~before | edge))[0]
    ends = np.nonzero(before & (~inside | edge))[0]
    of = np.searchsorted(bounds, starts, side="right") - 1
    power = np.ones(size + 1, np.uint64)
    power[1:] = _BASE
    np.cumprod(power, out=power)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(values * power[:size], out=sums[1:])
    power[1:] = _BACK
    power[0] = 1
    np.cumprod(power, out=power)
    hashes = (sums[ends] - sums[starts]) * power[starts]
    return starts, ends, of, hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48))


class FMIndex:
    """Full-text index of a sequence of symbols. It ends in 0, which occurs only there, so no two
    of its rotations are equal; 1 separates runs. Neither is searched for."""

    def __init__(self, symbols: np.ndarray, alphabet: int, step: int = SAMPLE_STEP):
        self.length = len(symbols)
        order = _suffix_order(symbols)
        before = symbols[order - 1]  # the end stands before the first symbol
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet + 1))])
        self.bits = max(1, alphabet.bit_length())
        # Wavelet matrix: per bit, from the highest, the number of ones before each place.
        self.ones, self.zeros, level = [], [], before
        for bit in range(self.bits - 1, -1, -1):
            on = (level >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(on)]))
            self.zeros.append(int(len(on) - self.ones[-1][-1]))
            level = np.concatenate([level[on == 0], level[on == 1]])
        sampled = order % step == 0
        self.marked = sampled
        self.marked_before = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place of the transform."""
        begin, place = np.zeros_like(place), place.copy()
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, on = self.ones[level], ((symbol >> bit) & 1).astype(bool)
            one_place, one_begin = ones[place], ones[begin]
            place = np.where(on, self.zeros[level] + one_place, place - one_place)
            begin = np.where(on, self.zeros[level] + one_begin, begin - one_begin)
        return place - begin

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbol at each place of the transform."""
        symbol = np.zeros_like(place)
        for level in range(self.bits):
            ones = self.ones[level]
            on = ones[place + 1] - ones[place]
            place = np.where(on == 1, self.zeros[level] + ones[place], place - ones[place])
            symbol = (symbol << 1) | on
        return symbol

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each row of symbols, all rows of one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.length, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[:, column]
            low = self.counts[symbol] + self.rank(symbol, low)
            high = self.counts[symbol] + self.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """The position in the sequence of each suffix, by walking back to a sampled one."""
        found, left, walked = np.zeros(len(places), np.int64), np.arange(len(places)), 0
        places = places.copy()
        while len(left):
            done = self.marked[places]
            found[left[done]] = self.samples[self.marked_before[places[done]]] + walked
            left, places = left[~done], places[~done]
            symbol = self.at(places)
            places = self.counts[symbol] + self.rank(symbol, places)
            walked += 1
        return found


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all rotations in sorted order, by doubling the compared length until
    no two are equal."""
    rank, width, size = symbols.astype(np.int64), 1, len(symbols)
    while True:
        key = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(size, np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == size - 1:
            return order


@dataclass
class Phrases:
    """A block of the benchmark: its words and, per length, its distinct windows and their items."""

    hashes: np.ndarray
    windows: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]


def phrases_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    texts = pa.array([text for _, text in items], pa.string())
    _, _, of, hashes = words_of(*byte_view(texts))
    known = np.unique(hashes)
    numbers = np.searchsorted(known, hashes)
    owners: dict[int, dict[tuple, set[str]]] = {}
    bounds = np.searchsorted(of, np.arange(len(items) + 1))
    for i, (item_id, _) in enumerate(items):
        own = numbers[bounds[i]:bounds[i + 1]].tolist()
        width = min(window, len(own))
        for at in range(len(own) - width + 1 if own else 0):
            name = "" if item_id is None else str(item_id)
            owners.setdefault(width, {}).setdefault(tuple(own[at:at + width]), set()).add(name)
    return Phrases(known, {n: np.array(list(w), np.int64) for n, w in owners.items()},
                   {n: [sorted(names) for names in w.values()] for n, w in owners.items()})


def search_shard(phrases: Phrases, of: np.ndarray, hashes: np.ndarray) -> tuple[list, list, list, list]:
    """Occurrences of the phrases in a shard's words: (first word, length, phrase) as arrays."""
    near = np.zeros(1 << 16, bool)
    near[(phrases.hashes >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.nonzero(near[(hashes >> np.uint64(48)).astype(np.int64)])[0]
    place = np.searchsorted(phrases.hashes, hashes[maybe])
    place[place == len(phrases.hashes)] = 0
    hit = phrases.hashes[place] == hashes[maybe]
    words, numbers = maybe[hit], place[hit]
    none = [np.zeros(0, np.int64)] * 3
    if not len(words):
        return none
    # Runs of known words, long enough for the shortest phrase, each closed by a separator.
    cut = np.ones(len(words), bool)
    cut[1:] = (np.diff(words) != 1) | (of[words[1:]] != of[words[:-1]])
    run = np.cumsum(cut) - 1
    long = np.bincount(run)[run] >= min(phrases.windows)
    words, numbers, run = words[long], numbers[long], run[long]
    if not len(words):
        return none
    _, run = np.unique(run, return_inverse=True)
    symbols = np.ones(len(words) + int(run[-1]) + 2, np.int64)
    symbols[-1] = 0
    origin = np.zeros(len(symbols), np.int64)
    target = np.arange(len(words)) + run
    symbols[target], origin[target] = numbers + 2, words
    index = FMIndex(symbols, len(phrases.hashes) + 1)
    firsts, lengths, which = [], [], []
    for length, rows in phrases.windows.items():
        low, high = index.search(rows + 2)
        found = high - low
        phrase = np.repeat(np.arange(len(rows)), found)
        suffix = np.arange(len(phrase)) - np.repeat(np.cumsum(found) - found, found) + low[phrase]
        firsts.append(origin[index.locate(suffix)])
        lengths.append(np.full(len(phrase), length))
        which.append(phrase)
    return [np.concatenate(x).astype(np.int64) for x in (firsts, lengths, which)]


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    return starts[new], ends[np.append(np.nonzero(new)[0][1:] - 1, len(ends) - 1)] if len(ends) else ends


def blocks_of(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str]]]:
    """The benchmark's rows in blocks of about `limit` bytes, so that what is sent is bounded."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator(prefetchPartitions=False):
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def searched(documents: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> tuple[StructType, Callable]:
    """The schema of find_contamination, and the function that makes its rows of packed ones."""
    spark = documents.sparkSession
    sent = [spark.sparkContext.broadcast(phrases_of(block, window)) for block in blocks_of(benchmark, block_bytes)]
    schema = packed(documents, *[F.expr(e) for e in (
        "0L as n_words", "cast(array() as array<long>) as hit_words",
        "cast(array() as array<long>) as hit_bytes", "cast(array() as array<string>) as hit_items")]).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, SHARD_BYTES):
            data, bounds = byte_view(text_of(batch))
            starts, ends, of, hashes = words_of(data, bounds)
            count = np.bincount(of, minlength=batch.num_rows)
            base = np.concatenate([[0], np.cumsum(count)])
            spans, spots, items = ([[] for _ in range(batch.num_rows)] for _ in range(3))
            for phrases in (block.value for block in sent):
                if not phrases.windows:
                    continue
                first, length, which = search_shard(phrases, of, hashes)
                at = np.argsort(of[first], kind="stable")
                cuts = np.searchsorted(of[first][at], np.arange(batch.num_rows + 1))
                for i in np.nonzero(np.diff(cuts))[0]:
                    own = at[cuts[i]:cuts[i + 1]]
                    old = np.array(spans[i], np.int64).reshape(-1, 2)
                    a, b = _merged(np.concatenate([old[:, 0], first[own] - base[i]]),
                                   np.concatenate([old[:, 1], first[own] - base[i] + length[own]]))
                    spans[i] = np.stack([a, b], 1).ravel()
                    spots[i] = np.stack([starts[base[i] + a], ends[base[i] + b - 1]], 1).ravel() - bounds[i]
                    pairs = set(zip(length[own].tolist(), which[own].tolist()))
                    items[i] = sorted(set(items[i]).union(*(phrases.items[n][w] for n, w in pairs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(count, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(spots, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=names)

    return schema, run


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row (the packed input), n_words, hit_words (merged word ranges, as pairs of longs),
    hit_bytes (the same ranges in the text's UTF-8 bytes) and hit_items (ids as text).

    Documents are never shuffled; all blocks of the benchmark are searched in one pass over them,
    so a task has one Python worker. A null or empty text has no words; items without words have
    no windows; repeated rows are searched alike; a benchmark without rows hits nothing.
    """
    schema, run = searched(documents, benchmark, window, block_bytes)
    return map_batches(packed(documents), run, schema)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = find_contamination(documents.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate("hit_words", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
                        lambda t, v: F.struct((t["sum"] + t["sign"] * v).alias("sum"), (-t["sign"]).alias("sign")),
                        lambda t: t["sum"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with every hit span cut out of their texts, and n_chars set anew.

    A span goes from the start of its first word to the end of its last one. All rows stay, as
    do their other columns and texts without a hit. Spans are cut where they are found: a second
    Python stage would have a second worker with a memory of its own beside each task.
    """
    found, search = searched(documents, benchmark, window, block_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in search(batches):
            texts = []
            for text, spots in zip(text_of(batch).to_pylist(), batch.column("hit_bytes").to_pylist()):
                if spots:
                    raw = text.encode()
                    edges = [0, *spots, len(raw)]
                    text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    schema = StructType([found["row"], StructField("text", StringType())])
    return with_text(map_batches(packed(documents), cut, schema), documents.columns)
