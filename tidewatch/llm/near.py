"""Near-duplicate documents: ProbMinHash signatures, banding, exact verification, groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import byte_view, chunks, map_batches, packed, stored, unpacked
from tidewatch.llm.contamination import words_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
CHUNK_BYTES = 1_000_000
# The pairs of a bucket of up to so many classes are verified one by one, those of larger ones in
# blocks of at most so many texts and about so many shingles.
SMALL_BUCKET = 8
BLOCK_TEXTS, BLOCK_SHINGLES, BLOCK_COLUMNS = 512, 400_000, 4_096
# The bitmap of wanted texts has at most 2 to this power bits: 8 MB.
FILTER_BITS = 26

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b) -> np.ndarray:
    x = (a ^ np.uint64(b)) * _M1 if np.isscalar(b) else (a ^ b) * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct word shingles of each text, sorted.

    Words are lower-cased runs of ASCII letters, digits and all other characters beyond ASCII. A
    text of fewer words than a shingle has one shingle, all its words; one without words has none.
    """
    _, _, of, words = words_of(data, bounds)
    if not len(of):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = np.bincount(of, minlength=len(bounds) - 1)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(of))  # words up to the text's end
    rank = np.repeat(size, size) - left
    padded = np.concatenate([words, np.zeros(SHINGLE_WORDS, np.uint64)])
    value = np.full(len(of), _M1)
    for k in range(SHINGLE_WORDS):
        value = _mix(value, np.where(left > k, padded[k:k + len(of)], np.uint64(k)))
    whole = (left >= SHINGLE_WORDS) | (rank == 0)
    of, value = of[whole], value[whole]
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    heads = np.nonzero(new)[0]
    return of[heads], value[heads], np.diff(np.append(heads, len(of)))


def signatures(of: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int,
               registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (Ertl 2020): a row of element hashes per text.

    Each element's arrivals are a Poisson process with its weight as rate, and each arrival goes
    to a register the element has not met yet, so the gaps grow as registers run out. A register
    keeps its earliest arrival. An element stops when it arrives later than its text's latest
    register. Two texts agree in a register with their elements' probability Jaccard likeness.
    """
    best = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    now = np.zeros(len(of))
    active = np.arange(len(of))
    first = (_mix(value, 11) >> np.uint64(40)).astype(np.int64)
    step = (_mix(value, 12) >> np.uint64(40)).astype(np.int64) | 1  # odd: meets each register once
    for turn in range(registers):
        own = value[active]
        uniform = ((_mix(own, 1_000 + turn) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        now[active] += -np.log(uniform) / weight[active] * registers / (registers - turn)
        latest = best.reshape(texts, registers).max(axis=1)
        active = active[now[active] < latest[of[active]]]
        if not len(active):
            break
        place = of[active] * registers + (first[active] + turn * step[active]) % registers
        sooner = now[active] < best[place]
        some, place = active[sooner], place[sooner]
        order = np.argsort(-now[some], kind="stable")  # of several, the earliest is written last
        best[place[order]] = now[some[order]]
        kept[place[order]] = value[some[order]]
    return kept.reshape(texts, registers)


def band_keys(kept: np.ndarray) -> np.ndarray:
    """A 64-bit key per text and band; bands don't share keys."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _M2, (len(kept), BANDS)).copy()
    for row in range(ROWS):
        keys = _mix(keys, kept[:, row::ROWS])
    return keys


def _row_key():
    return F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, class (a digest of the shingle set), n (its size) and bands of each text.

    A text without words gets the digest of its bytes, so only equal ones are of one class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, CHUNK_BYTES):
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                data, bounds = byte_view(part.column("text"))
                of, value, _ = shingles(data, bounds)
                size = np.bincount(of, minlength=part.num_rows)
                # Equal weights: links are judged by plain set likeness.
                keys = band_keys(signatures(of, value, np.ones(len(value)), part.num_rows))
                ends, raw, flat = np.cumsum(size), data.tobytes(), value.tobytes()
                names = [hashlib.blake2b(flat[8 * (e - n):8 * e] if n else b"=" + raw[a:b], digest_size=16).digest()
                         for e, n, a, b in zip(ends.tolist(), size.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]), pa.int32()),
                    pa.array(keys[size > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array(names, pa.binary()),
                     pa.array(size, pa.int64()), bands], names=["doc_id", "row_key", "class", "n", "bands"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), text.alias("text"))
    return map_batches(rows, run, "doc_id long, row_key long, class binary, n long, bands array<long>")


def buckets_of(classes: DataFrame) -> DataFrame:
    """rep, n, bucket, size (classes in the bucket) and degree (classes met) where buckets are shared."""
    posts = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = posts.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).where("size > 1")
    degree = shared.groupBy("rep").agg(F.sum("size").alias("degree"))
    return stored(shared.join(degree, "rep"), "buckets")


def candidates(shared: DataFrame) -> DataFrame:
    """(a, b): all pairs of classes that share a small bucket and may be alike in size."""
    in_turn = Window.partitionBy("bucket").orderBy("rep")
    near = [F.lead(F.struct("rep", "n"), k).over(in_turn) for k in range(1, SMALL_BUCKET)]
    met = shared.where(F.col("size") <= SMALL_BUCKET).select("rep", "n", F.array(*near).alias("partners"))
    pairs = met.select("rep", "n", F.explode("partners").alias("o")).where("o is not null and o.rep != rep")
    alike = F.least("n", "o.n") >= SIMILARITY * F.greatest("n", "o.n")
    return pairs.where(alike).select(F.least("rep", "o.rep").alias("a"), F.greatest("rep", "o.rep").alias("b")).distinct()


def blocks_of(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rep, n and block of every class in a large bucket, and the pairs of blocks (a <= b) that
    such a bucket joins and whose sizes allow links.

    Classes are sorted by the best connected class they share a large bucket with, then by size,
    so that the texts of one template stand in few blocks.
    """
    large = shared.where(F.col("size") > SMALL_BUCKET)
    centre = F.max(F.struct("degree", "rep")).over(Window.partitionBy("bucket"))
    crowd = large.withColumn("centre", centre).groupBy("rep").agg(F.max("centre").alias("home"), F.first("n").alias("n"))
    least = BLOCK_SHINGLES // BLOCK_TEXTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = done + np.cumsum(np.maximum(batch.column("n").to_numpy(), least))
            if len(ends):
                done = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), batch.column("n"), pa.array(np.full(len(ends), part)), pa.array(ends)],
                    names=["rep", "n", "part", "upto"])

    order = ("home", "n", "rep")
    placed = crowd.repartitionByRange(*order).sortWithinPartitions(*order).select("rep", "n")
    placed = stored(map_batches(placed, run, "rep long, n long, part long, upto long"), "placed")
    # A number per partition comes to the driver.
    totals = sorted(map(tuple, placed.groupBy("part").agg(F.max("upto")).collect()))
    starts = np.cumsum([0, *(total for _, total in totals)])
    # As Arrow data: rows from a Python list would start a second set of workers on the executors.
    offsets = placed.sparkSession.createDataFrame(
        pa.table({"part": pa.array([part for part, _ in totals], pa.int64()), "start": pa.array(starts[:-1], pa.int64())}))
    placed = stored(placed.join(F.broadcast(offsets), "part").select(
        "rep", "n", F.floor((F.col("start") + F.col("upto") - 1) / BLOCK_SHINGLES).alias("block")), "placed")

    joined = large.select("rep", "bucket").join(placed, "rep").groupBy("bucket").agg(
        F.sort_array(F.collect_set("block")).alias("blocks")).select("blocks").distinct()
    joined = joined.select(F.explode("blocks").alias("a"), "blocks").select("a", F.explode("blocks").alias("b"))
    joined = joined.where("a <= b").distinct()
    sizes = placed.groupBy("block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    for side in ("a", "b"):
        joined = joined.join(sizes.select(F.col("block").alias(side), F.col("low").alias(f"low_{side}"),
                                          F.col("high").alias(f"high_{side}")), side)
    alike = (F.col("high_a") >= SIMILARITY * F.col("low_b")) & (F.col("high_b") >= SIMILARITY * F.col("low_a"))
    return placed, stored(joined.where(alike).select("a", "b"), "block-pairs")


def not_in_blocks(pairs: DataFrame, placed: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) that no pair of blocks holds, so that each pair is compared once."""
    for side in ("a", "b"):
        own = placed.select(F.col("rep").alias(side), F.col("block").alias(f"block_{side}"))
        pairs = pairs.join(own, side, "left")
    held = joined.select(F.col("a").alias("low"), F.col("b").alias("high"))
    ends = ((F.least("block_a", "block_b") == F.col("low")) & (F.greatest("block_a", "block_b") == F.col("high"))
            & F.col("block_a").isNotNull() & F.col("block_b").isNotNull())
    return pairs.join(held, ends, "left_anti").select("a", "b")


def filter_of(keys: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A bitmap over the low bits of 64-bit keys, and their mask: a key whose bit is not set is
    absent. It has 16 bits a key up to 8 MB in all; beyond that more absent keys pass."""
    bits = 1 << max(16, min(FILTER_BITS, int(16 * count - 1).bit_length()))
    words = keys.selectExpr(f"shiftright(row_key & {bits - 1}L, 6) AS word",
                            "shiftleft(1L, cast(row_key & 63L AS int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bit").to_numpy()
    return bitmap, bits - 1


def sets_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and set, the sorted 64-bit hashes of the shingles, of the texts with a wanted row_key.

    A broadcast bitmap of bounded size keeps other texts where they are, and what passes it is
    joined as sets: texts are not shuffled.
    """
    wanted = stored(wanted, "wanted")
    spark = documents.sparkSession
    bitmap, mask = filter_of(wanted, wanted.count())
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy() & mask
            passed = (shared.value[keys >> 6] >> (keys & 63)) & 1 == 1
            for part in chunks(iter([batch.filter(pa.array(passed))]), CHUNK_BYTES):
                of, value, _ = shingles(*byte_view(part.column("text")))
                bounds = np.searchsorted(of, np.arange(part.num_rows + 1))
                packed_sets = [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(packed_sets, pa.binary())],
                                                 names=["key", "set"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = map_batches(documents.select(_row_key().alias("row_key"), text.alias("text")), run, "key long, set binary")
    return stored(rows.join(wanted.withColumnRenamed("row_key", "key"), "key", "left_semi"), "sets").dropDuplicates(["key"])


def verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard likeness of SIMILARITY or more."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(shared >= SIMILARITY * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))

    left = sets.select(F.col("key").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("right"))
    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"),
                       compare, "a long, b long")


def alike(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of the left have a Jaccard likeness of SIMILARITY or more with which of the right."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    of = [np.repeat(np.arange(len(side)), size) for side, size in zip((left, right), sizes)]
    value, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    at = place[:len(of[0])], place[len(of[0]):]
    both = np.isin(np.arange(len(value)), at[0]) & np.isin(np.arange(len(value)), at[1])
    column = np.cumsum(both) - 1
    kept = [(o[both[p]], column[p[both[p]]]) for o, p in zip(of, at)]
    kept = [(o[order], c[order]) for o, c in kept for order in [np.argsort(c, kind="stable")]]
    shared = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(both.sum()), BLOCK_COLUMNS):
        sides = []
        for (o, c), side in zip(kept, (left, right)):
            a, b = np.searchsorted(c, [first, first + BLOCK_COLUMNS])
            side_of = np.zeros((len(side), BLOCK_COLUMNS), np.float32)
            side_of[o[a:b], c[a:b] - first] = 1
            sides.append(side_of)
        shared += sides[0] @ sides[1].T
    return shared >= SIMILARITY * (sizes[0][:, None] + sizes[1][None, :] - shared.astype(np.float64))


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join what a symmetric table of links joins: each node with its component's first."""
    root = np.full(len(linked), -1)
    for node in np.nonzero(linked.any(axis=1))[0]:
        if root[node] < 0:
            fresh = np.array([node])
            while len(fresh):
                root[fresh] = node
                fresh = np.nonzero(linked[fresh].any(axis=0) & (root < 0))[0]
    ends = np.nonzero((root >= 0) & (root != np.arange(len(root))))[0]
    return root[ends], ends


def linked_in_blocks(sets: DataFrame, placed: DataFrame, joined: DataFrame) -> DataFrame:
    """(a, b, links) of all pairs of texts in the pairs of blocks: rows with b join a and b by
    chains of links, rows without it give the number of a's links there. Rows grow with the
    texts of a block pair and not with its pairs of texts."""
    whole = stored(sets.join(placed, F.col("key") == F.col("rep")).groupBy("block").agg(
        F.collect_list("key").alias("keys"), F.collect_list("set").alias("sets")), "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {name: batch.column(name)[i] for name in batch.schema.names}
                same = one["a"].as_py() == one["b"].as_py()
                keys = [one[name].values.to_numpy() for name in ("keys_a", "keys_b")]
                sides = [[np.frombuffer(s.as_buffer(), np.uint64) for s in one[name].values]
                         for name in ("sets_a", "sets_b")]
                found = alike(*sides)
                if same:
                    np.fill_diagonal(found, False)
                    linked, names = found, keys[0]
                else:
                    linked, names = np.zeros((sum(found.shape),) * 2, bool), np.concatenate(keys)
                    linked[:len(found), len(found):] = found
                    linked |= linked.T
                low, high = forest(linked)
                degree = linked.sum(axis=1)
                own = np.nonzero(degree)[0]
                a, b = np.concatenate([names[low], names[own]]), np.concatenate([names[high], names[own]])
                joins = np.arange(len(a)) < len(low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64(), mask=~joins),
                     pa.array(np.concatenate([np.zeros(len(low), np.int64), degree[own]]), pa.int64())],
                    names=["a", "b", "links"])

    rows = joined
    for side in ("a", "b"):
        rows = rows.join(whole.select(F.col("block").alias(side), F.col("keys").alias(f"keys_{side}"),
                                      F.col("sets").alias(f"sets_{side}")), side)
    rows = rows.select("a", "b", "keys_a", "sets_a", "keys_b", "sets_b")
    return stored(map_batches(rows, run, "a long, b long, links long", 2), "block-links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in a link: its component's least node.

    Large and small stars in turn (Kiveris et al. 2014), each round written to the shared folder,
    until the edges stay as they are. Only a count and a checksum come to the driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u != v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark"),
                          F.sum(F.xxhash64("u", "v") % 1_000_003).alias("sum")).first()
        if state == before or state["n"] == 0:
            break
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())


def near_groups(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, copy_id, class_id and n_links of every document.

    copy_id: the least doc_id with the same set of shingles. class_id: the least doc_id of all
    documents joined to it by chains of links, a link being a likeness of SIMILARITY or more.
    n_links: other copy classes linked to its own. Null texts are empty, and
    empty texts copies of each other; rows without doc_id count as copies, but give no id unless
    all of their class have none. Repeated rows are copies; an empty table gives no rows.
    """
    sketch = stored(sketches(documents), "sketches")
    classes = stored(sketch.groupBy("class").agg(
        F.min("row_key").alias("rep"), F.min("doc_id").alias("copy_id"), F.first("n").alias("n"),
        F.first("bands").alias("bands")), "classes")
    shared = buckets_of(classes)
    placed, joined = blocks_of(shared)
    pairs = stored(not_in_blocks(candidates(shared), placed, joined), "pairs")
    sets = sets_of(documents, pairs.select(F.col("a").alias("row_key")).union(pairs.select("b"))
                   .union(placed.select("rep")).distinct())
    links = stored(verified(sets, pairs), "links")
    in_blocks = linked_in_blocks(sets, placed, joined)
    roots = components(links.union(in_blocks.where("b is not null").select("a", "b")))
    ends = links.select(F.col("a").alias("rep"), F.lit(1).cast("long").alias("links")).union(
        links.select("b", F.lit(1).cast("long"))).union(in_blocks.where("b is null").select("a", "links"))
    ends = ends.groupBy("rep").agg(F.sum("links").alias("n_links"))
    known = (classes.select("class", "rep", "copy_id")
             .join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(ends, "rep", "left")
             .select("class", "copy_id", F.coalesce("root", "rep").alias("root"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    groups = known.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    found = known.join(groups, "root").select("class", "copy_id", "class_id", "n_links", "root")
    return sketch.select("doc_id", "row_key", "class").join(found, "class").select(
        "doc_id", "row_key", "root", "copy_id", "class_id", "n_links")


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents with one row of each near-duplicate group: that of the least doc_id.

    A row without doc_id stays only if its whole group has none; of rows with equal id and text
    one stays. Null texts are empty ones, and these are copies of each other. An empty table
    gives no rows.
    """
    groups = near_groups(documents)
    kept = groups.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key")).alias("kept")).select("kept.row_key")
    rows = packed(documents, _row_key().alias("row_key")).join(kept, "row_key")
    # Rows that are equal in id and text share the key: one of them stays.
    in_key = Window.partitionBy("row_key").orderBy("row_key")
    return unpacked(rows.withColumn("turn", F.row_number().over(in_key)).where("turn = 1"), documents.columns)
