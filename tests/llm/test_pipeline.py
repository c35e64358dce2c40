"""The corpus pipeline from end to end: each stage, on all that the one before it kept, against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidewatch.llm.common import stored

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _documents():
    draw = random.Random(12)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(draw.randrange(2, 8))) for _ in range(900)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n)) + "."

    passage, question = prose(60), " ".join(draw.choice(words) for _ in range(14))
    texts = [prose(draw.choice([12, 60, 200])) for _ in range(110)]
    texts += [prose(40) + " " + passage + " " + prose(30) for _ in range(4)]
    texts += [prose(15) + " " + question + " " + prose(25) for _ in range(3)]
    near = texts[1].split(" ")
    texts += [texts[0], texts[0], " ".join([*near[:-1], "other."]), prose(3_000)]
    junk = [" ".join([draw.choice(words)] * 30) + "!!! ###" * 5 for _ in range(60)]
    order = [(text, 1) for text in texts] + [(text, 0) for text in junk]
    draw.shuffle(order)
    rows = [(3 * k, text, "en", "web", len(text)) for k, (text, _) in enumerate(order)]
    labels = [(3 * k, good, 0) for k, (_, good) in enumerate(order)]
    return rows, labels, [(1, question)]


def _words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [(m[0], m.start(), m.end()) for m in WORD.finditer(lower)]


def _one_of_each_group(rows):
    sets = {i: {tuple(own[k:k + 5]) for k in range(max(len(own) - 4, 1))}
            for i, text in rows for own in [[w for w, _, _ in _words(text)]]}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i for i in sets if top(i) == i}


def _without_repeats(rows):
    seen = Counter(text[k:k + 200] for _, text in rows for k in range(len(text) - 199))
    result = {}
    for i, text in rows:
        gone = [False] * len(text)
        for k in range(len(text) - 199):
            if seen[text[k:k + 200]] > 1:
                gone[k:k + 200] = [True] * 200
        result[i] = "".join(c for c, g in zip(text, gone) if not g)
    return result


def _without_benchmark(rows, items):
    phrases = {tuple(own[k:k + n]) for _, text in items for own in [[w for w, _, _ in _words(text)]]
               for n in [min(10, len(own))] for k in range(len(own) - n + 1)}
    result = {}
    for i, text in rows:
        own, hit = _words(text), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(own) - n + 1):
                if tuple(w for w, _, _ in own[k:k + n]) in phrases:
                    hit.update(range(k, k + n))
        cut = [False] * len(text)
        for k in hit:
            end = own[k + 1][1] if k + 1 in hit else own[k][2]
            cut[own[k][1]:end] = [True] * (end - own[k][1])
        result[i] = "".join(c for c, g in zip(text, cut) if not g)
    return result


def _held(pieces, texts):
    """Every document's ids once and in order, sequences gapless and full but for the last of a power of two."""
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own, sequences = {}, {}
    for p in pieces:
        own.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(own) == set(texts)
    for i, text in texts.items():
        ids = words.encode(text, add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(own[i], key=lambda p: p["start"]):
            part = np.array(ids[at:at + p["length"]], "<u4")
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += p["length"]
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = _documents()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SHAPE).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_works_on_all_that_the_one_before_kept(spark, folder):
    rows, labels, items = _documents()
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "stage")
        assert docs.columns == [part.split()[0] for part in SHAPE.split(", ")]
        kept[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    texts = {row[0]: row[1] for row in rows}
    good = kept["quality classifier"]
    assert all(texts[i] == text for i, text in good)
    assert {i for i, _ in good} == {i for i, quality, _ in labels if quality}
    single = kept["near-duplicates"]
    assert {i for i, _ in single} == _one_of_each_group(good) and len(single) == len(good) - 3
    assert all(texts[i] == text for i, text in single)
    assert dict(kept["repeated passages"]) == _without_repeats(single)
    assert dict(kept["repeated passages"]) != dict(single)
    clean = _without_benchmark(kept["repeated passages"], items)
    assert dict(kept["decontamination"]) == clean != dict(kept["repeated passages"])

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    _held(pieces, clean)
    _held(corpus_pipeline.run(spark, folder).collect(), clean)
