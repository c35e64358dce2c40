"""Stages that filter or cut documents, against brute force and on awkward rows."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import contamination, near, packing, quality, suffixes
from tidewatch.llm.common import stored

WORDS = ["alpha", "beta", "gam", "d", "eé", "ω"]
SHAPE = "doc_id long, text string"


def _awkward(draw):
    """Null and empty texts, copies, repeated rows, periodic and very long texts, shared passages."""
    passages = [" ".join(draw.choice(WORDS) + str(draw.randrange(99)) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [draw.choice(passages)[draw.randrange(50):] + " " + " ".join(
            draw.choice(WORDS) + str(draw.randrange(500)) for _ in range(draw.randrange(80)))
            for _ in range(draw.randrange(4))]
        rows.append((i, "\n".join(parts)))
    return rows + [(100, None), (101, ""), (102, "a" * 199), (103, "b" * 200), (104, "c" * 201), (105, "xy" * 400),
                   (106, "x" * 5000), (107, passages[0] * 3), (107, passages[0] * 3), (None, passages[1]),
                   (None, None), (None, "zz"), (108, "longword" * 30_000), (109, "!!! ..."), (110, rows[5][1])]


@pytest.fixture(scope="module")
def rows():
    return _awkward(random.Random(3))


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


# --- suffix-array dedup ------------------------------------------------------------

def _repeats(rows):
    texts = [(i, (text or "").encode()) for i, text in rows]
    seen = Counter(raw[k:k + 200] for _, raw in texts for k in range(len(raw) - 199))
    result = []
    for i, raw in texts:
        gone = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        result.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


@pytest.mark.parametrize("busy", [4_000, 0])
def test_repeated_bytes_equal_brute_force(documents, rows, busy, monkeypatch):
    monkeypatch.setattr(suffixes, "BUSY_CONTEXTS", busy)
    short = [row for row in rows if len(row[1] or "") < 20_000]
    got = suffixes.dedup_digests(documents.where("length(coalesce(text, '')) < 20000"))
    assert sorted(map(tuple, got.collect()), key=str) == _repeats(short)


def test_small_blocks_sort_alike(documents, monkeypatch):
    wanted = sorted(map(tuple, suffixes.dedup_digests(documents).collect()), key=str)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 3_000)
    assert sorted(map(tuple, suffixes.dedup_digests(documents).collect()), key=str) == wanted


def test_cover_holds_every_distance():
    period, cover = suffixes.PERIOD, suffixes.COVER
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert 8 * suffixes.RANK_WORDS >= period


# --- decontamination -------------------------------------------------------------

def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_contamination_equals_brute_force(spark, documents, rows):
    draw = random.Random(8)
    items = [(1, " ".join(_words(rows[3][1])[4:40])), (2, "Alpha1"), (3, "gam5, D7!"), (4, None), (5, "..."),
             (10, " ".join(_words(rows[7][1])[:10])), (11, " ".join(_words(rows[7][1])[:10])), (12, "never seen here")]
    items += [(20 + k, " ".join(draw.choice(WORDS) + str(draw.randrange(99)) for _ in range(12))) for k in range(5)]
    owners = {}
    for item, text in items:
        own = _words(text)
        n = min(10, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            owners.setdefault(tuple(own[k:k + n]), set()).add(str(item))
    lengths = {len(w) for w in owners}
    wanted = []
    for doc_id, text in rows:
        own, hit, found = _words(text), set(), set()
        for n in lengths:
            for k in range(len(own) - n + 1):
                if (names := owners.get(tuple(own[k:k + n]))):
                    hit.update(range(k, k + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        wanted.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (10 ** 6, 60):  # one block, and several
        found = contamination.find_contamination(documents, benchmark, block_bytes=block)
        assert found.count() == len(rows)
    got = contamination.contamination(documents, benchmark).collect()
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert any(row["contaminated"] for row in got) and not all(row["contaminated"] for row in got)


def test_index_finds_what_a_scan_finds():
    import numpy as np

    draw = np.random.default_rng(0)
    for n, kinds in [(n, k) for n in (1, 2, 7, 30, 60) for k in (1, 2, 4)] * 3:
        symbols = np.append(draw.integers(1, kinds + 2, n), 0)
        if n == 60:
            symbols[:-1] = np.tile(symbols[:20], 3)  # periodic
        index = contamination.FMIndex(symbols, kinds + 1, step=3)
        for length in (1, 2, 5):
            phrases = draw.integers(2, kinds + 2, (6, length))
            for phrase, low, high in zip(phrases, *index.search(phrases)):
                wanted = [i for i in range(n + 1 - length) if (symbols[i:i + length] == phrase).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == wanted


def test_blocks_of_the_benchmark_add_up(spark, documents, rows):
    items = [(k, " ".join(_words(rows[k][1])[:12])) for k in range(8)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ("row.doc_id", "n_words", "hit_words", "hit_items")
    whole, parts = (sorted(map(str, contamination.find_contamination(documents, benchmark, block_bytes=b)
                               .select(*columns).collect())) for b in (10 ** 6, 40))
    assert whole == parts


def test_hit_spans_are_cut_out(spark):
    documents = spark.createDataFrame(
        [(1, "Keep this. One two three four five six seven eight nine ten! And that."), (2, "Clean é text")], SHAPE)
    benchmark = spark.createDataFrame([(1, "one TWO three four five six seven eight nine ten")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in contamination.decontaminate(documents, benchmark).collect()}
    assert got == {1: "Keep this. ! And that.", 2: "Clean é text"}


def test_one_worker_a_task_searches_all_blocks_and_cuts(spark, documents, rows):
    items = [(k, " ".join((text or "").split()[:14])) for k, (_, text) in enumerate(rows[:12])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = contamination.decontaminate(documents, benchmark)
    parts = contamination.decontaminate(documents, benchmark, block_bytes=50)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    found = contamination.find_contamination(documents, benchmark, block_bytes=50)
    for frame in (whole, parts, found):
        assert frame._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


# --- near duplicates ---------------------------------------------------------------

def _shingles(text):
    own = _words(text)
    return frozenset(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset({("=", text or "")})


def test_near_groups_equal_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for base in range(12):
        own = [draw.choice(WORDS) + str(draw.randrange(1000)) for _ in range(draw.choice([3, 30, 120, 300]))]
        rows.append((len(rows), " ".join(own)))
        for _ in range(draw.randrange(6)):
            copy = list(own)
            for _ in range(draw.randrange(6)):
                copy[draw.randrange(len(copy))] = "edited" + str(draw.randrange(1000))
            rows.append((len(rows), " ".join(copy).upper() if draw.random() < 0.3 else ", ".join(copy)))
    rows += [(900, None), (901, ""), (902, "!!!"), (903, "!!!"), (904, "?"), (905, "word"), (906, "Word."), (905, "word")]
    sets = [_shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    wanted = sorted((i, rows[top(k)][0]) for k, (i, _) in enumerate(rows))
    documents = spark.createDataFrame(rows, SHAPE)
    got = near.near_groups(documents)
    assert sorted((r["doc_id"], r["class_id"]) for r in got.collect()) == wanted
    kept = near.keep_one(documents)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in wanted})


def test_a_large_group_is_joined_without_its_pairs(spark):
    draw = random.Random(6)
    own = [f"w{draw.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(300):
        copy = list(own)
        copy[draw.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    documents = spark.createDataFrame(rows, SHAPE)
    groups = near.near_groups(documents)
    assert groups.select("class_id").distinct().count() == 1
    assert groups.agg(F.max("n_links")).first()[0] >= 1


def test_repeated_shingles_do_not_part_near_duplicates(spark):
    draw = random.Random(9)
    rows = []
    for pair in range(300):
        line, rest, own, other = ([f"w{draw.randrange(10 ** 6)}" for _ in range(n)] for n in (45, 40, 10, 10))
        rows += [(2 * pair, " ".join(line + line[:4] + rest + own)),
                 (2 * pair + 1, " ".join(line * 300 + line[:4] + rest + other))]
    a, b = _shingles(rows[0][1]), _shingles(rows[1][1])
    assert len(a & b) >= 0.8 * len(a | b)
    bands = {r["doc_id"]: set(r["bands"]) for r in near.sketches(spark.createDataFrame(rows, SHAPE)).collect()}
    assert [k for k in range(0, 600, 2) if not bands[k] & bands[k + 1]] == []


@pytest.mark.parametrize("block_texts", [512, 64])
def test_links_inside_a_large_template_group_are_all_found(spark, block_texts, monkeypatch):
    # Texts of one form at about 0.78, and pairs of them at about 0.82.
    monkeypatch.setattr(near, "BLOCK_TEXTS", block_texts)
    monkeypatch.setattr(near, "BLOCK_SHINGLES", block_texts * 1_000)
    draw = random.Random(12)
    form = [f"w{k}" for k in range(1_004)]
    rows = []
    for pair in range(300):
        places = draw.sample(range(0, 1_000, 6), 13 + 10)
        for own in (places[:13], places[:3] + places[13:]):
            copy = list(form)
            for place in own:
                copy[place] = f"field{pair}at{place}"
            rows.append((len(rows), " ".join(copy)))
    sets = [{hash(s) for s in _shingles(text)} for _, text in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a)
             if (c := len(sets[a] & sets[b])) >= 0.8 * (len(sets[a]) + len(sets[b]) - c)]
    assert 300 <= len(links) < 10_000
    degree = Counter(k for link in links for k in link)
    got = {r["doc_id"]: r for r in near.near_groups(spark.createDataFrame(rows, SHAPE)).collect()}
    assert all(got[a]["class_id"] == got[b]["class_id"] for a, b in links)
    assert {k: r["n_links"] for k, r in got.items()} == {k: degree[k] for k in got}


def test_signatures_estimate_likeness():
    import numpy as np

    draw = np.random.default_rng(2)
    shared, apart = draw.integers(0, 2 ** 63, 600, dtype=np.uint64), draw.integers(0, 2 ** 63, 400, dtype=np.uint64)
    value = np.concatenate([shared, apart[:200], shared, apart[200:]])
    of = np.repeat([0, 1], 800)
    kept = near.signatures(of, value, np.ones(len(value)), 2, registers=1024)
    assert abs((kept[0] == kept[1]).mean() - 0.6) < 0.06
    # Weights: elements of rate 3 against 1; sum of minima over sum of maxima of what is shared.
    weight = np.concatenate([np.full(600, 3.0), np.ones(200), np.full(600, 3.0), np.ones(200)])
    heavy = near.signatures(of, value, weight, 2, registers=1024)
    assert abs((heavy[0] == heavy[1]).mean() - 1800 / 2200) < 0.06


def test_block_numbers_start_no_python_rows(documents, monkeypatch):
    plans, read = [], stored(documents, "documents")
    monkeypatch.setattr(near, "stored", lambda frame, label: plans.append(
        frame._jdf.queryExecution().executedPlan().toString()) or stored(frame, label))
    near.near_groups(read).count()
    assert "LocalTableScan" in "".join(plans) and "ExistingRDD" not in "".join(plans)


# --- quality -------------------------------------------------------------------------

def test_quality_generalises(spark):
    draw = random.Random(1)

    def good():
        return " ".join(draw.choice(WORDS) + draw.choice("aeiou") for _ in range(draw.randrange(5, 80))) + "."

    def bad():
        word = draw.choice(WORDS)
        return draw.choice([" ".join([word] * 30), good().upper().replace(" ", "!! "), good().replace(" ", "### ")])

    rows = [(i, good() if i % 3 else bad()) for i in range(500)] + [(900, None), (901, ""), (902, "long " * 50_000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(500)] + [(3, 0, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(spark.createDataFrame(rows, SHAPE), labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 500]
    assert len(held) > 50
    assert sum(r["predicted"] == (r["doc_id"] % 3 > 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_quality_tells_very_long_texts_apart():
    import numpy as np
    import pyarrow as pa

    draw = random.Random(5)

    def text(letters, words):
        return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(3, 9))) for _ in range(words))

    kinds = ["nopqrstuvwxyzabc", "abcdefghijklmnop"]
    classes = [k % 2 for k in range(200)]
    model = quality.fit([text(kinds[k], 100) for k in classes], classes)
    long = pa.array([text(kinds[0], 40_000), text(kinds[1], 40_000)])
    row, feature = quality.indicators(*quality.byte_view(long))
    bad, good = model.scores(np.array([model.margin(feature[row == k]) for k in (0, 1)]))
    assert bad < 0.1 and good > 0.9
    assert np.bincount(row).max() < len(model.weights) / 4


def test_quality_without_labels_or_with_one_class(spark):
    documents = spark.createDataFrame([(1, "a"), (2, None)], SHAPE)
    labels = spark.createDataFrame([(5, 1, 0), (1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.classify(documents, labels.where("false")).collect()] == [0.5, 0.5]
    assert all(r["score"] > 0.5 for r in quality.classify(documents, labels).collect())


def test_quality_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


# --- all stages: columns, empty tables, order -----------------------------------------

CLASHING = ("doc_id long, text string, lang string, source string, n_chars long, row string, `row_key` int, "
            "ranges string, score string, bands int, class string, hit_words string, `odd.name` int, kept int, turn int")


def _stages():
    return [(name, stage) for name, stage in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(k, int(k % 2), 0) for k in range(40)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name, stage", _stages())
def test_stages_take_clashing_columns_and_null_values(spark, folder, rows, name, stage):
    wide = spark.createDataFrame(
        [(i, text, None, None, 1, "r", 1, "x", "s", 2, "c", "h", 3, 4, 5) for i, text in rows], CLASHING)
    result = stage(spark, wide, folder)
    if name == "packing":
        assert result.columns == [part.split()[0] for part in packing.PIECES.split(", ")]
        assert result.count() >= len(rows)
        return
    assert result.schema == wide.schema or result.columns == wide.columns
    got = result.collect()
    assert 0 < len(got) <= len(rows) and all(r["row"] == "r" and r["odd.name"] == 3 for r in got)
    if name in ("repeated passages", "decontamination"):
        assert len(got) == len(rows)
        assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] is not None)


@pytest.mark.parametrize("name, stage", _stages())
def test_stages_take_empty_tables(spark, folder, name, stage):
    assert stage(spark, spark.createDataFrame([], SHAPE), folder).count() == 0
