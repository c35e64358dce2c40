"""Cross-tokenizer alignment: an inverted index from pairs of token ids to compressed document bitmaps.

Each text is encoded by two tokenizers. Byte offsets where tokens of both end cut the text into
groups; two tokens are linked if their bytes overlap. A shard of documents becomes a row that
holds, for each pair of ids linked there, bitmaps over the shard's documents: plane k has the
documents in which bit k of the pair's multiplicity is set. A plane stores a rare pair as a list
of places and a frequent one as bits. Planes merged by OR and popcounted give a pair's number of
documents; planes popcounted by their weights give its number of links.

Only (pair, shard) counts are shuffled, summed before they travel; what the corpus says about a
pair goes back to each shard that has it, whose postings hand it on to the documents.
"""

from __future__ import annotations

import base64
import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidewatch.llm.common import chunks, map_batches, stored

BYTE_VOCABULARY, BYTE_RANKS, PIECE_VOCABULARY = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
SHARD_BYTES = 8_000_000
CHUNK_BYTES = 1_000_000
# Places of documents in a shard are 16-bit numbers.
SHARD_DOCUMENTS = 65_536
BITS = 0xFFFFFFFF
# Rows of a batch are small numbers here, or shards, whose bytes Spark's own limit holds.
ROWS = 10_000

SHARD = ("shard long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
         "n_links array<long>, groups_sha256 array<string>, pairs binary, planes array<binary>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


# --- tokenizers --------------------------------------------------------------------

def _kind(category: str) -> str:
    return category[0] if category[0] in "LNZ" else "-"


class ByteTokenizer:
    """The byte-level vocabulary, by two libraries.

    tiktoken does the work where both split a text alike: they do if each character's class
    (letter, number, space or other) has been the same in all versions of Unicode, and a probe
    with the character gives equal ids. Other texts are encoded by the vocabulary's own file.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        self.exact = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.exact.encode_special_tokens = True
        with open(public_tokenizers.path(ranks), "rb") as lines:
            known = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known,
                                      special_tokens={})
        self.entries = byte_entries(vocabulary)
        self.alike: dict[str, bool] = {}

    def _is_alike(self, char: str) -> bool:
        if char not in self.alike:
            old, new = (_kind(u.category(char)) for u in (unicodedata.ucd_3_2_0, unicodedata))
            probe = f" a{char}a1{char}1!{char}! {char}  {char}{char}\n{char}\n\n{char}"
            self.alike[char] = old == new and self.fast.encode_ordinary(probe) == self._exact(probe)
        return self.alike[char]

    def _exact(self, text: str) -> list[int]:
        return self.exact.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        odd = {char for char in set().union(*texts) if not self._is_alike(char)}
        return [self.fast.encode_ordinary(text) if not odd or odd.isdisjoint(text) else self._exact(text)
                for text in texts]


def byte_entries(vocabulary: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary.

    Printable characters of Latin-1 stand for their own byte, and those from 256 on for the other
    bytes in turn. An added token stands for its own text.
    """
    with open(public_tokenizers.path(vocabulary)) as file:
        content = json.load(file)
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in own}
    byte_of |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    entries = {i: bytes(byte_of[c] for c in entry) for entry, i in content["model"]["vocab"].items()
               if all(c in byte_of for c in entry)}
    entries |= {t["id"]: t["content"].encode() for t in content["added_tokens"]}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


class PieceTokenizer:
    """The vocabulary of pieces; the library itself puts a space before a text."""

    def __init__(self, vocabulary: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        size = self.model.get_piece_size()
        self.entries = [bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
                        for i, piece in ((i, self.model.id_to_piece(i)) for i in range(size))]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1) if texts else []


class Side(NamedTuple):
    """A tokenizer with its tables by id."""
    tokenizer: ByteTokenizer | PieceTokenizer
    entries: list[bytes]
    lengths: np.ndarray


@lru_cache(maxsize=2)
def _sides(names: tuple[str, str, str]) -> tuple[Side, Side, list[str]]:
    """Both tokenizers of a worker, and what a token adds to the text of groups: its id and one
    of `,` and `|` for the first side, `,`, `;` and nothing for the second."""
    sides = []
    for tokenizer in (ByteTokenizer(*names[:2]), PieceTokenizer(names[2])):
        sides.append(Side(tokenizer, tokenizer.entries, np.array([len(e) for e in tokenizer.entries])))
    a, b = (range(len(side.entries)) for side in sides)
    written = [f"{i}{mark}" for ids, marks in ((a, ",|"), (b, (",", ";", ""))) for mark in marks for i in ids]
    return *sides, written


# --- one chunk of texts ------------------------------------------------------------

class Aligned(NamedTuple):
    """Counts and digest of each text, and links as (first id, second id, text)."""
    counts: np.ndarray  # n_a, n_b, n_groups, n_links by text
    digests: list[str]
    a: np.ndarray
    b: np.ndarray
    place: np.ndarray


def _flat(lists: Sequence[Sequence[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def align_texts(texts: Sequence[str | None], names: tuple[str, str, str]) -> Aligned:
    """Groups and links of texts. A text without tokens (null, empty, or not the same bytes after
    either tokenizer) has zeros and an empty digest."""
    a, b, written = _sides(names)
    given = [k for k, text in enumerate(texts) if text]
    ids_a = a.tokenizer.encode([f" {texts[k]}" for k in given])
    ids_b = b.tokenizer.encode([texts[k] for k in given])
    whole = []
    for n, k in enumerate(given):
        raw = f" {texts[k]}".encode()
        if b"".join(map(a.entries.__getitem__, ids_a[n])) == raw == b"".join(map(b.entries.__getitem__, ids_b[n])):
            whole.append(n)
    given, ids_a, ids_b = ([side[n] for n in whole] for side in (given, ids_a, ids_b))
    counts, digests = np.zeros((4, len(texts)), np.int64), [""] * len(texts)
    if not given:
        none = np.zeros(0, np.int64)
        return Aligned(counts, digests, none, none, none)

    # All texts end to end: where tokens end is marked byte by byte, so nothing is sorted.
    flat_a, flat_b = _flat(ids_a), _flat(ids_b)
    ends_a, ends_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
    last_a, last_b = (np.cumsum([len(ids) for ids in lists]) for lists in (ids_a, ids_b))
    marks = np.zeros((2, ends_a[-1] + 1), bool)
    marks[0, ends_a] = marks[1, ends_b] = True
    before_a, before_b = np.cumsum(marks[0]), np.cumsum(marks[1])  # tokens that end there or earlier
    both = marks[0] & marks[1]
    group_ends = np.flatnonzero(both)
    before_groups = np.cumsum(both)
    text_ends = ends_a[last_a - 1]

    # Each stretch between two ends of either side lies in one token of both: a link.
    ends = np.flatnonzero(marks[0] | marks[1])
    link_a, link_b = before_a[ends] - marks[0, ends], before_b[ends] - marks[1, ends]
    text_of_link = np.searchsorted(text_ends, ends)
    counts[0, given], counts[1, given] = (np.diff(last, prepend=0) for last in (last_a, last_b))
    counts[2, given] = np.diff(before_groups[text_ends], prepend=0)
    counts[3, given] = np.bincount(text_of_link, minlength=len(given))

    # Tokens in written order: of each group those of the first side, then those of the second.
    group_a = before_groups[ends_a] - both[ends_a]
    group_b = before_groups[ends_b] - both[ends_b]
    starts = np.concatenate([[0], group_ends])
    order = np.empty(len(flat_a) + len(flat_b), np.int64)
    order[np.arange(len(flat_a)) + before_b[starts[group_a]]] = flat_a + both[ends_a] * len(a.entries)
    closing = both[ends_b].astype(np.int64)
    closing[last_b - 1] = 2
    order[np.arange(len(flat_b)) + before_a[group_ends[group_b]]] = (
        2 * len(a.entries) + flat_b + closing * len(b.entries))
    first = 0
    for k, last in zip(given, last_a + last_b):
        text = "".join(map(written.__getitem__, order[first:last].tolist()))
        digests[k] = hashlib.sha256(text.encode()).hexdigest()
        first = last
    return Aligned(counts, digests, flat_a[link_a], flat_b[link_b], np.array(given)[text_of_link])


# --- compressed bitmaps --------------------------------------------------------------

def compressed(row: np.ndarray, place: np.ndarray, rows: int, places: int) -> bytes:
    """A bitmap of `places` bits for each of `rows` rows, from its set bits in (row, place) order.

    A row is a sorted list of 16-bit places, or plain bits where these are shorter; a header of
    32-bit numbers holds the length of each list, all ones for plain bits.
    """
    counts = np.bincount(row, minlength=rows)
    width = (places + 7) // 8
    plain = 2 * counts > width
    listed = ~plain[row]
    bits = np.zeros((int(plain.sum()), 8 * width), np.uint8)
    bits[(np.cumsum(plain) - 1)[row[~listed]], place[~listed]] = 1
    header = np.where(plain, BITS, counts).astype("<u4")
    return (header.tobytes() + place[listed].astype("<u2").tobytes()
            + np.packbits(bits, axis=1, bitorder="little").tobytes())


def _parts(plane: bytes, rows: int, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Header, listed places and plain bytes of a compressed bitmap."""
    header = np.frombuffer(plane, "<u4", rows).astype(np.int64)
    listed = int(header[header != BITS].sum())
    places_of = np.frombuffer(plane, "<u2", listed, 4 * rows)
    plain = np.frombuffer(plane, np.uint8, -1, 4 * rows + 2 * listed).reshape(-1, (places + 7) // 8)
    return header, places_of, plain


def set_bits(plane: bytes, rows: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each set bit, in no promised order."""
    header, listed, plain = _parts(plane, rows, places)
    row = np.repeat(np.arange(rows), np.where(header == BITS, 0, header))
    k, place = np.nonzero(np.unpackbits(plain, axis=1, bitorder="little"))
    return (np.concatenate([row, np.flatnonzero(header == BITS)[k]]),
            np.concatenate([listed.astype(np.int64), place]))


def popcounts(plane: bytes, rows: int, places: int) -> np.ndarray:
    """The number of set bits of each row."""
    header, _, plain = _parts(plane, rows, places)
    counts = header.copy()
    counts[header == BITS] = np.bitwise_count(plain).sum(axis=1)
    return counts


def merged(planes: Sequence[bytes], rows: int, places: int) -> bytes:
    """The OR of bitmaps over the same rows and places."""
    if len(planes) == 1:
        return planes[0]
    found = [row * places + place for row, place in (set_bits(plane, rows, places) for plane in planes)]
    row, place = np.divmod(np.unique(np.concatenate(found)), max(places, 1))
    return compressed(row, place, rows, places)


# --- shards ------------------------------------------------------------------------

class _Shard:
    """What a task has aligned so far of one shard."""

    def __init__(self, second: int) -> None:
        self.second, self.size = second, 0
        self.ids: list = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: list, found: Aligned, size: int) -> None:
        keys = ((found.a * self.second + found.b) << 16) | (found.place + len(self.ids))
        keys, times = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.counts.append(found.counts)
        self.digests += found.digests
        self.ids += ids
        self.size += size

    def row(self, number: int) -> pa.RecordBatch:
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        pairs, row = np.unique(keys >> 16, return_inverse=True)
        place = keys & 0xFFFF
        planes = []
        for k in range(int(times.max(initial=0)).bit_length()):
            has = (times >> k) & 1 == 1
            planes.append(compressed(row[has], place[has], len(pairs), len(self.ids)))
        n_a, n_b, n_groups, n_links = np.concatenate(self.counts, axis=1).tolist()
        values = [number, self.ids, n_a, n_b, n_groups, n_links, self.digests, pairs.astype("<i8").tobytes(), planes]
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(values, _SHARD_TYPES.values())], list(_SHARD_TYPES))


_LONGS = pa.list_(pa.int64())
_SHARD_TYPES = {"shard": pa.int64(), "doc_id": _LONGS, "n_a": _LONGS, "n_b": _LONGS, "n_groups": _LONGS,
                "n_links": _LONGS, "groups_sha256": pa.list_(pa.string()), "pairs": pa.binary(),
                "planes": pa.list_(pa.binary())}


def index_shards(documents: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, byte_ranks: str = BYTE_RANKS,
                 piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """One row for each shard of some 8 MB of texts, stored: its documents' counts and digests,
    its pairs, and their planes. A longer text makes a shard of its own."""
    names = (byte_vocabulary, byte_ranks, piece_vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second = len(_sides(names)[1].entries)
        number, shard = TaskContext.get().partitionId() << 32, _Shard(second)
        for batch in chunks(batches, CHUNK_BYTES):
            texts = batch.column("text").to_pylist()
            size = sum(len(text) for text in texts if text)
            if shard.ids and (shard.size + size > SHARD_BYTES or len(shard.ids) + len(texts) > SHARD_DOCUMENTS):
                yield shard.row(number)
                number, shard = number + 1, _Shard(second)
            shard.add(batch.column("doc_id").to_pylist(), align_texts(texts, names), size)
        if shard.ids:
            yield shard.row(number)

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(map_batches(given, run, SHARD), "aligned-shards")


def shard_counts(shards: DataFrame, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """Documents and links of each pair in each shard, popcounted from the planes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path(piece_vocabulary)).get_piece_size()
        for batch in batches:
            for r in batch.select(["shard", "n_a", "pairs", "planes"]).to_pylist():
                pairs, places = np.frombuffer(r["pairs"], "<i8"), len(r["n_a"])
                if not len(pairs):
                    continue
                links = sum(popcounts(plane, len(pairs), places) << k for k, plane in enumerate(r["planes"]))
                present = popcounts(merged(r["planes"], len(pairs), places), len(pairs), places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), r["shard"])), pa.array(np.arange(len(pairs), dtype=np.int32)),
                     pa.array((pairs // second).astype(np.int32)), pa.array((pairs % second).astype(np.int32)),
                     pa.array(present), pa.array(links)],
                    ["shard", "place", "a_id", "b_id", "n_docs", "n_links"])

    return map_batches(shards, run, "shard long, place int, a_id int, b_id int, n_docs long, n_links long", ROWS)


def pair_counts(counts: DataFrame) -> DataFrame:
    """Each pair's documents and links in the whole corpus. Shards share no document, so merged
    bitmaps have the sum of their bits."""
    return counts.groupBy("a_id", "b_id").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one shard with what their pairs' postings return."""
    rows = left.to_pylist()
    place = right.column("place").to_numpy()
    totals, best = np.zeros((2, len(place)), np.int64)
    totals[place] = right.column("total").to_numpy()
    best[place] = right.column("best").to_numpy()
    parts = []
    for r in rows:
        n, documents = len(r["pairs"]) // 8, len(r["n_a"])
        sums, bests = np.zeros((2, documents), np.int64)
        for k, plane in enumerate(r["planes"]):
            pair, document = set_bits(plane, n, documents)
            np.add.at(sums, document, totals[pair] << k)
            np.add.at(bests, document, best[pair] << k)
        parts.append(pa.table({
            "doc_id": pa.array(r["doc_id"], pa.int64()),
            **{name: pa.array(r[name], pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(bests), "count_sum": pa.array(sums),
            "groups_sha256": pa.array(r["groups_sha256"], pa.string())}))
    return pa.concat_tables(parts)


def align(documents: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, byte_ranks: str = BYTE_RANKS,
          piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """Groups, links and corpus-wide pair scores of every document, whole texts.

    n_best counts links whose pair has the most links of all pairs with its second id (ties too);
    count_sum adds the pair's links over the document's links. Null and empty texts, and texts
    that either tokenizer changes, have zeros and an empty digest. Each row comes out once, with
    repeated or null ids too; repeated texts count each time. Columns but doc_id and text are not
    read. An empty table gives no rows.
    """
    shards = index_shards(documents, byte_vocabulary, byte_ranks, piece_vocabulary)
    counts = stored(shard_counts(shards, piece_vocabulary), "shard-counts")
    pairs = stored(pair_counts(counts), "pair-counts")
    # One row for each id of the second vocabulary at most: small whatever the corpus.
    highest = F.broadcast(pairs.groupBy("b_id").agg(F.max("n_links").alias("highest")))
    judged = pairs.join(highest, "b_id").select(
        "a_id", "b_id", F.col("n_links").alias("total"), (F.col("n_links") == F.col("highest")).cast("long").alias("best"))
    returned = counts.join(judged, ["a_id", "b_id"]).select("shard", "place", "total", "best")
    return shards.groupBy("shard").cogroup(returned.groupBy("shard")).applyInArrow(_scored, RESULT)
