"""Packing of documents into fixed-length sequences along a space-filling curve."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import byte_view, chunks, map_batches, offsets_of, stored

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS = 4, 12
HASHED = 512
# A generation of remembered words ends at so many words, or so many characters in them.
MEMO_WORDS, MEMO_CHARS = 250_000, 4_000_000
CALL_WORDS = 1_000
_ODD = re.compile(r"[^\x21-\x7e\xa1-\xff]|<\|")
# Kinds of bytes in UTF-8, as the vocabulary's own pattern of parts tells them apart; the bytes
# after 0xC2 are Latin-1's, those after 0xC3 letters but for two.
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
_KINDS = np.full(256, ODD, np.uint8)
_KINDS[0x21:0x7F] = _KINDS[0xA1:0xC0] = SIGN
for _kind, _of in ((SPACE, b"\t\n\r "), (DIGIT, b"0123456789\xb2\xb3\xb9\xbc\xbd\xbe"),
                   (LETTER, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ\xaa\xb5\xba")):
    _KINDS[list(_of)] = _kind
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Memory:
    """Packed ids of words, in two generations. A full newer one takes the place of the older, and
    words met again move from there to the newer: frequent words stay."""

    def __init__(self):
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def lacking(self, words: list[str]) -> list[str]:
        """Those of the distinct words that are not remembered; all others are in the newer generation."""
        if len(self.newer) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self.older, self.newer, self.chars = self.newer, {}, 0
        newer, older = self.newer, self.older
        missing = [word for word in words if word not in newer]
        self.chars += sum(map(len, missing))
        if older:
            newer.update([(word, older[word]) for word in missing if word in older])
            missing = [word for word in missing if word not in older]
        return missing


def parts_of(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The texts' parts end to end, and where each text's begin; white space is dropped.

    Words of plain Latin characters are put in lower case and cut to letters, digits and signs as
    the vocabulary's own pattern does; words with other characters, or with what may be a special
    token, are a part as they stand.
    """
    view, bounds = byte_view(texts)
    size = bounds[-1]
    first = np.zeros(size + 8, bool)  # where a text begins
    first[bounds] = True
    kinds, lows = _KINDS[view], view.copy()
    lows[(view >= 0x41) & (view <= 0x5A)] += 0x20
    after = np.flatnonzero(view[:size] == 0xC3) + 1
    signs = (view[after] == 0x97) | (view[after] == 0xB7)
    kinds[after] = np.where(signs, SIGN, LETTER)
    lows[after[(view[after] < 0x9F) & ~signs]] += 0x20
    lead = np.flatnonzero((view[:size] == 0xC2) | (view[:size] == 0xC3))
    kinds[lead] = kinds[lead + 1]
    kinds[:size][(view[:size] == 0x3C) & (view[1:size + 1] == 0x7C) & ~first[1:size + 1]] = ODD
    kinds[size:] = SPACE

    solid = kinds != SPACE
    starts = solid & first
    starts[1:] |= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    starts &= solid & (view & 0xC0 != 0x80)
    words = solid & first
    words[1:] |= solid[1:] & ~solid[:-1]
    # An apostrophe that begins a part takes some letters with it.
    at = np.flatnonzero(starts & (view == 0x27))
    at = at[~first[at + 1]]
    one, two = lows[at + 1], lows[at + 2]
    single = np.isin(one, list(b"stmd"))
    double = ((two == 0x65) & ((one == 0x72) | (one == 0x76)) | (one == 0x6C) & (two == 0x6C)) & ~first[at + 2]
    starts[at[single | double] + 1] = False
    starts[at[single] + 2] |= solid[at[single] + 2]
    starts[at[double] + 3] |= solid[at[double] + 3]
    odd = np.flatnonzero(kinds == ODD)
    if len(odd):
        begin = np.append(np.flatnonzero(words), size)
        own = np.unique(np.searchsorted(begin, odd, side="right") - 1)
        turn = np.zeros(size + 8, np.int8)
        turn[begin[own]] += 1
        turn[begin[own + 1]] -= 1
        inside = np.cumsum(turn, dtype=np.int8) > 0
        starts &= ~inside | words
        lows[inside] = view[inside]
    at = np.flatnonzero(starts)
    offsets = np.append((np.cumsum(solid, dtype=np.int32) - 1)[at], np.count_nonzero(solid)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(lows[solid]))
    return parts, np.searchsorted(at, bounds)


class WordEncoder:
    """Ids of texts, with each distinct part of a word encoded once.

    White space separates words for this tokenizer and is dropped by it, so a text's ids are
    those of its parts end to end. The tokenizer's model encodes parts of plain Latin characters;
    other words go through the tokenizer whole. What memory lacks of a batch's parts is encoded
    many at a time. Memory is bounded.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a part
        self.ends[[i for token, i in self.bare.get_vocab().items() if token.endswith("</w>")]] = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memory = Memory()
        # The byte-level alphabet: printable bytes stand for themselves, others follow from 256 on.
        # A space stays, as it stands between parts.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = sorted(set(range(256)) - set(plain))
        self.alphabet = np.arange(256, dtype="<u4")
        self.alphabet[others] = 256 + np.arange(len(others))
        self.alphabet[0x20] = 0x20

    def _packed(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        data = ids.astype(self.kind).tobytes()
        return [data[a:b] for a, b in pairwise([0, *(bounds * self.kind.itemsize).tolist()])]

    def _encoded(self, parts: list[str]) -> list[bytes]:
        mapped = self.alphabet[np.frombuffer(" ".join(parts).encode(), np.uint8)].tobytes().decode("utf-32-le")
        [whole] = self.bare.encode_batch_fast([mapped], add_special_tokens=False)
        ids = np.array(whole.ids)
        return self._packed(ids, np.flatnonzero(self.ends[ids]) + 1)

    def _encoded_whole(self, words: list[str]) -> list[bytes]:
        whole = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        bounds = np.searchsorted(np.array(whole.word_ids, np.int64), np.arange(1, len(words) + 1))
        return self._packed(np.array(whole.ids), bounds)

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        new = self.memory.lacking(parts)
        known = self.memory.newer
        odd = [part for part in new if _ODD.search(part)] if _ODD.search("".join(new)) else []
        kept = set(odd)
        for encoded, some in ((self._encoded, [part for part in new if part not in kept]),
                              (self._encoded_whole, odd)):
            for first in range(0, len(some), CALL_WORDS):
                group = some[first:first + CALL_WORDS]
                known.update(zip(group, encoded(group), strict=True))
        return known

    def encode(self, texts: pa.Array | list[str | None], end_id: int) -> list[bytes]:
        """Packed ids of each text with `end_id` after them."""
        parts, bounds = parts_of(pa.array(texts, pa.string()))
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._learn(distinct)
        ids = pa.array([known[part] for part in distinct], pa.large_binary()).take(coded.indices)
        data, end = ids.buffers()[2] or b"", np.array([end_id], self.kind).tobytes()
        return [bytes(data[a:b]) + end for a, b in pairwise(offsets_of(ids)[bounds].tolist())]


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> WordEncoder:
    """One encoder per worker process: its memory outlives the task, its ids don't depend on it."""
    return WordEncoder(vocabulary)


def hilbert_key(places: np.ndarray, bits: int) -> np.ndarray:
    """The position of each row of non-negative integers along a Hilbert curve (Skilling 2004)."""
    x = places.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of documents: hashed token counts, projected by fixed random directions."""
    directions = np.random.default_rng(7).standard_normal((HASHED, dimensions))
    counts = np.zeros((len(ids), HASHED))
    for row, own in enumerate(ids):
        hashed = (own.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(23)
        counts[row] = np.sqrt(np.bincount(hashed, minlength=HASHED)[:HASHED])
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
    # Projections of unit vectors: a logistic curve spreads them over the whole grid.
    places = (1 << bits) / (1 + np.exp(-1.7 * counts @ directions))
    return hilbert_key(np.clip(places.astype(np.int64), 0, (1 << bits) - 1), bits)


def encoded(documents: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """doc_id, curve key and packed ids of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in chunks(batches):
            packed = encoder.encode(batch.column("text"), end_id)
            keys = curve_keys([np.frombuffer(ids, encoder.kind) for ids in packed])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys), pa.array(packed, pa.binary()),
                 pa.array([encoder.kind.itemsize] * len(packed), pa.int32())],
                names=["doc_id", "curve", "ids", "width"])

    return map_batches(documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"),
                       run, "doc_id long, curve long, ids binary, width int")


def pack(documents: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of sequences of at most `length` ids, a power of two; no sequence has padding.

    Documents are sorted in ranges of their curve key, and each range is one run of ids cut
    every `length`; what is left at its end is cut at powers of two. A null or empty text is its
    end id alone. Equal keys are spread by doc_id and text, so copies don't meet in one task.
    Repeated rows are packed as often as they occur; an empty table gives no rows. sequence_id
    is unique, not dense.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        offset, rest = 0, []  # the pieces of the open sequence

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)],
                names=[part.split()[0] for part in PIECES.split(", ")])

        for batch in chunks(batches, values_of=lambda batch: batch.column("ids")):
            rows = []
            widths = batch.column("width").to_pylist()
            for doc_id, ids, width in zip(batch.column("doc_id").to_pylist(),
                                          batch.column("ids").to_pylist(), widths):
                own = np.frombuffer(ids, f"<u{width}").astype("<u4")
                at = 0
                while at < len(own):
                    take = min(len(own) - at, length - offset)
                    rest.append((doc_id, at, own[at:at + take], len(own), offset))
                    at, offset = at + take, offset + take
                    if offset == length:
                        rows += [(d, s, len(i), zlib.crc32(i.tobytes()), n, sequence, o) for d, s, i, n, o in rest]
                        rest, offset, sequence = [], 0, sequence + 1
            yield made(rows)
        rows, left = [], offset
        room = 1 << left.bit_length() >> 1
        offset = 0
        for doc_id, start, ids, n, _ in rest:
            at = 0
            while at < len(ids):
                take = min(len(ids) - at, room - offset)
                part = ids[at:at + take]
                rows.append((doc_id, start + at, take, zlib.crc32(part.tobytes()), n, sequence, offset))
                at, offset, left = at + take, offset + take, left - take
                if offset == room:
                    room, offset, sequence = 1 << left.bit_length() >> 1, 0, sequence + 1
        yield made(rows)

    # Stored, so that the sampling of ranges doesn't encode everything a second time.
    ready = stored(encoded(documents, vocabulary, end_id), "encoded")
    order = ["curve", "doc_id", F.xxhash64("ids")]
    return map_batches(ready.repartitionByRange(*order).sortWithinPartitions("curve", "doc_id"), run, PIECES)
