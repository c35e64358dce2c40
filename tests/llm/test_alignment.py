"""Cross-tokenizer alignment, against a plain version over the same vocabularies."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import alignment
from tidewatch.llm.common import table

SHAPE = "doc_id long, text string"
TEXTS = ["Hello wörld, hello.", "", None, "x", "  two  spaces \n\n\ttabs\r\n", "Hello wörld, hello.", "日本語 テキスト 😀 \U0001f9ff",
         "<s> [INST] <|endoftext|> </s> <unk>", "under▁score", "\u0000nul\u0085  ᠎ x", "ẞԱꙪ 12३४ Ⅷ½",
         "don't DON'T we'll'S", "é ‍​ ﻿", "퟿￿", "number " * 20_000, "a" * 300_000,
         "the the the and the"]


def _plain(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letter = {}
    spare = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letter[chr(byte)] = byte
        else:
            letter[chr(256 + spare)] = byte
            spare += 1
    words = {i: bytes(letter[c] for c in word) for word, i in a.get_vocab(with_added_tokens=False).items() if i != 50256}

    def piece(i):
        name = b.id_to_piece(i)
        return bytes.fromhex(name[3:5]) if b.is_byte(i) else name.replace("▁", " ").encode()

    links, found = defaultdict(int), []
    for doc_id, text in rows:
        if not text:
            found.append((doc_id, None))
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if b"".join(words[i] for i in ids_a) != raw or b"".join(map(piece, ids_b)) != raw:
            found.append((doc_id, None))
            continue
        owner_a = [k for k, i in enumerate(ids_a) for _ in words[i]]
        owner_b = [k for k, i in enumerate(ids_b) for _ in piece(i)]
        own = [(ids_a[x], ids_b[y]) for x, y in dict.fromkeys(zip(owner_a, owner_b))]
        ends = [k + 1 for k in range(len(raw)) if k + 1 == len(raw)
                or owner_a[k] != owner_a[k + 1] and owner_b[k] != owner_b[k + 1]]
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(owner[start:end]))
                                   for ids, owner in ((ids_a, owner_a), (ids_b, owner_b))))
            start = end
        for pair in own:
            links[pair] += 1
        found.append((doc_id, (len(ids_a), len(ids_b), groups, own)))
    highest = Counter()
    for (_, y), n in links.items():
        highest[y] = max(highest[y], n)
    result = []
    for doc_id, own in found:
        if own is None:
            result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = own
        result.append((doc_id, n_a, n_b, len(groups), len(pairs), sum(links[p] == highest[p[1]] for p in pairs),
                       sum(links[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(result, key=str), links, found


def _rows(frame):
    return sorted((tuple(r[name.split()[0]] for name in alignment.RESULT.split(", ")) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    return [*enumerate(TEXTS), (3, "x"), (None, "x y"), (None, None)]


def test_awkward_texts_equal_a_plain_version(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 AS shard", "'c' AS planes", "2 AS n_a")
    wanted, _, _ = _plain(rows)
    assert sum(r[1] == 0 for r in wanted) < len(rows) - 8
    assert _rows(alignment.align(frame)) == wanted
    monkeypatch.setattr(alignment, "SHARD_BYTES", 40)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 20)
    assert _rows(alignment.align(frame.repartition(3))) == wanted


def test_given_documents_equal_a_plain_version(spark):
    frame = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    wanted, links, found = _plain([tuple(r) for r in frame.collect()])
    assert _rows(alignment.align(frame)) == wanted
    counts = alignment.pair_counts(alignment.shard_counts(alignment.index_shards(frame))).collect()
    documents = Counter(p for _, own in found if own for p in set(own[3]))
    assert {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"]) for r in counts} == {
        pair: (documents[pair], n) for pair, n in links.items()}


def test_no_documents(spark):
    assert alignment.align(spark.createDataFrame([], SHAPE)).count() == 0
    got = alignment.align(spark.createDataFrame([(1, None), (2, "")], SHAPE)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_both_byte_tokenizers_agree_and_odd_characters_are_left_to_the_exact_one():
    tokenizer = alignment.ByteTokenizer(alignment.BYTE_VOCABULARY, alignment.BYTE_RANKS)
    draw = random.Random(1)
    texts = ["".join(chr(draw.choice([draw.randrange(32, 0x250), draw.randrange(0x250, 0xD800), 10, 32]))
                     for _ in range(60)) for _ in range(300)]
    assert tokenizer.encode(texts) == [tokenizer._exact(text) for text in texts]
    assert sum(tokenizer.alike.values()) > 4_000
    assert not tokenizer._is_alike("ẞ") and tokenizer._is_alike("é")
    ranks = {base64.b64decode(x): int(i) for x, i in map(bytes.split, open(
        public_tokenizers.path(alignment.BYTE_RANKS), "rb"))}
    assert tokenizer.entries[:50256] == sorted(ranks, key=ranks.get)
    assert tokenizer.entries[50256] == b"<|endoftext|>"


@pytest.mark.parametrize("rows, places, share", [(50, 1_000, 0.001), (50, 1_000, 0.3), (3, 65_536, 0.5), (7, 1, 0.5), (4, 9, 0)])
def test_bitmaps(rows, places, share):
    draw = np.random.default_rng(rows + places)
    tables = draw.random((3, rows, places)) < share * draw.random((1, rows, 1))
    planes = [alignment.compressed(*np.nonzero(t), rows, places) for t in tables]
    for plane, wanted in zip(planes, tables):
        back = np.zeros((rows, places), bool)
        back[alignment.set_bits(plane, rows, places)] = True
        assert (back == wanted).all()
        assert (alignment.popcounts(plane, rows, places) == wanted.sum(axis=1)).all()
    whole = alignment.merged(planes, rows, places)
    assert (alignment.popcounts(whole, rows, places) == tables.any(axis=0).sum(axis=1)).all()
    assert alignment.merged([whole, planes[0]], rows, places) == whole
