"""Hidden Markov language model over words.

Words fall into classes by their ends; latent states emit classes, and a class emits its words by
their smoothed counts. Baum-Welch counts are added up across partitions; the scaled forward
recursion gives the exact likelihood of whole texts.

Counting needs no text shuffle. Texts are stored as shards of word numbers; only (word, shard,
count) rows are shuffled, and only the totals of words that occur in several shards come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import byte_view, chunks, map_batches, stored

STATES, CLASSES = 8, 2048
FOLDS, HELD_OUT = 5, 1
MOST_ROUNDS = 6
# Training ends when a round adds less than this to the mean log10 probability of a token.
LEAST_GAIN = 1e-4
# The first guess: texts drawn in each pass, passes that draw, and passes that move centres.
DRAWN, DRAWS, MOVES = 16, 3, 3
PIECE = 512  # words of a training sequence; scoring takes whole texts
SHARD_BYTES = 2_500_000
SHARD_ROWS = 8  # rows of a batch where each is a shard
TEXT_ROWS = 4_000  # texts of a batch; a few shards, so that their sizes are even
SHARD = ("shard long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, words binary, "
         "width int, groups binary, counts binary, keys binary")
ROWS = "key long, shard long, place_count long"
COUNT_BITS = 32
READY = ("doc_ids array<long>, held_out array<boolean>, sizes array<int>, classes binary, "
         "known array<int>, word_logs array<double>, class_words array<long>, class_tokens array<long>")

_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
_M1 = np.uint64(0x9E3779B97F4A7C15)
END_KEY = (CLASSES - 1) << 52
# Bytes in lower case; zero for the white space that separates words.
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[0x41:0x5B] += np.uint64(32)
_LOWER[[0x20, *range(0x09, 0x0E)]] = 0


def _pressed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: they are stored once and shuffled once."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).tobytes())


def _unpressed(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value.as_buffer()), kind)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def word_keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and key of every token: the words, and one end after each text's words.

    A key holds the class in its upper bits, from the last three bytes, and a hash below.
    """
    size, texts = int(bounds[-1]), len(bounds) - 1
    values = _LOWER[data[:size]]
    inside = np.zeros(size + 1, bool)
    inside[:size] = values != 0
    before = np.concatenate([[False], inside[:-1]])
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    starts = np.nonzero(inside & (~before | edge))[0]
    ends = np.nonzero(before & (~inside | edge))[0]
    of = np.searchsorted(bounds, starts, side="right") - 1
    power = np.full(size + 1, _BASE)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(values * power[:size], out=sums[1:])
    power[1:] = _BACK
    np.cumprod(power, out=power)
    hashed = (sums[ends] - sums[starts]) * power[starts] * _M1
    hashed ^= hashed >> np.uint64(29)
    tail = np.zeros(len(starts), np.uint64)
    for k in range(1, 4):
        have = ends - starts >= k
        tail = (tail << np.uint64(9)) | np.where(have, values[np.maximum(ends - k, 0)], np.uint64(0))
    group = ((tail * _M1) >> np.uint64(32)) % np.uint64(CLASSES - 1)
    keys = (group << np.uint64(52)) | ((hashed * _BASE) >> np.uint64(12))
    every = np.concatenate([of, np.arange(texts)])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([keys.astype(np.int64), np.full(texts, END_KEY)])[order]


def shards_of(documents: DataFrame) -> DataFrame:
    """The corpus in shards: texts as numbers into the shard's sorted list of distinct words, with
    the words' classes, counts in texts that aren't held out, and keys, each less the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in chunks(batches, SHARD_BYTES):
            of, keys = word_keys(*byte_view(batch.column("text")))
            known, place = np.unique(keys, return_inverse=True)
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            counts = np.bincount(place[~held[of]], minlength=len(known))
            kind = np.uint16 if len(known) <= 1 << 16 else np.uint32
            row = ([number], [batch.column("doc_id").to_pylist()], [held], [np.bincount(of, minlength=batch.num_rows)],
                   [_pressed(place.astype(kind))], [np.dtype(kind).itemsize], [_pressed((known >> 52).astype(np.uint16))],
                   [_pressed(counts.astype(np.int32))], [_pressed(np.diff(known, prepend=0))])
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(),
                     pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=_names(SHARD))
            number += 1

    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold == HELD_OUT).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_batches(rows, run, SHARD, TEXT_ROWS)


def with_totals(shards: DataFrame) -> DataFrame:
    """Shards with class numbers instead of words, each text's share of the word counts, and the
    shard's part of the classes' numbers of distinct words and of tokens.

    A word of one shard only has its count there as its total. Of the shards that share a word
    one is its owner, so that it counts once.
    """
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.cumsum(_unpressed(batch.column("keys")[i], np.int64))
                counts = _unpressed(batch.column("counts")[i], np.int32)
                shard = np.full(len(keys), batch.column("shard")[i].as_py())
                both = (np.arange(len(keys)) << COUNT_BITS) | counts
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(shard), pa.array(both)], names=_names(ROWS))

    by_key = Window.partitionBy("key")
    rows = map_batches(shards.select("shard", "keys", "counts"), words, ROWS, SHARD_ROWS)
    count = F.col("place_count").bitwiseAND((1 << COUNT_BITS) - 1)
    shared = rows.select(
        "shard", F.shiftright("place_count", COUNT_BITS).cast("int").alias("place"),
        F.sum(count).over(by_key).alias("total"), F.count("*").over(by_key).alias("shards"),
        F.min("shard").over(by_key).alias("owner")).where("shards > 1")
    # Both lists are gathered row by row, so they stay in step; ~place marks a word that is owned.
    marked = F.when(F.col("owner") == F.col("shard"), F.bitwise_not("place")).otherwise(F.col("place"))
    back = shared.groupBy("shard").agg(F.collect_list(marked).alias("places"), F.collect_list("total").alias("totals"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                group = _unpressed(one["groups"], np.uint16)
                total = _unpressed(one["counts"], np.int32).astype(np.int64)
                local, own = total.copy(), np.ones(len(group), bool)
                if one["places"].is_valid:
                    place = one["places"].values.to_numpy()
                    own[place[place >= 0]] = False
                    total[np.where(place < 0, ~place, place)] = one["totals"].values.to_numpy()
                words = _unpressed(one["words"], np.uint16 if one["width"].as_py() == 2 else np.uint32)
                sizes = one["sizes"].values.to_numpy()
                of = np.repeat(np.arange(len(sizes)), sizes)
                logs = np.bincount(of, np.log10(total + 0.5)[words], len(sizes))
                known = np.bincount(of, (total > 0)[words], len(sizes)).astype(np.int64)
                distinct = np.bincount(group[own & (total > 0)], minlength=CLASSES)
                tokens = np.bincount(group, local, CLASSES).astype(np.int64)
                made = (one["doc_ids"].as_py(), one["held_out"].as_py(), sizes, group[words].tobytes(),
                        known, logs, distinct, tokens)
                kinds = (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(),
                         pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made, kinds)], names=_names(READY))

    joined = shards.drop("keys").join(back, "shard", "left").drop("shard")
    return map_batches(joined, run, READY, SHARD_ROWS)


@dataclass
class Model:
    """Start, transition and class emission probabilities of the states."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class by state


def _by_length(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by falling length, and how many of them are longer than each step."""
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    return order, len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")


def log_likelihoods(model: Model, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probabilities of class sequences laid end to end, by the scaled forward recursion."""
    order, active = _by_length(sizes)
    begin = (np.cumsum(sizes) - sizes)[order]
    logs, alpha = np.zeros(len(sizes)), None
    for step, count in enumerate(active.tolist()):
        emitted = model.emit[classes[begin[:count] + step]]
        alpha = emitted * model.start if alpha is None else (alpha[:count] @ model.move) * emitted
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        logs[:count] += np.log10(scale)
    result = np.zeros(len(sizes))
    result[order] = logs
    return result


def expected_counts(model: Model, classes: np.ndarray,
                    sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, moves and emissions of sequences laid end to end, and their
    log10 probability with the number of tokens."""
    states = len(model.start)
    order, active = _by_length(sizes)
    begin = (np.cumsum(sizes) - sizes)[order]
    move = np.zeros((states, states))
    alphas, emissions, scales, kinds = [], [], [], []
    for step, count in enumerate(active.tolist()):
        kind = classes[begin[:count] + step]
        emitted = model.emit[kind]
        alpha = emitted * model.start if not alphas else (alphas[-1][:count] @ model.move) * emitted
        scale = alpha.sum(axis=1, keepdims=True)
        alphas.append(alpha / scale)
        emissions.append(emitted)
        scales.append(scale)
        kinds.append(kind)
    gammas, beta = [], None
    for step in range(len(active) - 1, -1, -1):
        count = int(active[step])
        now = np.ones((count, states))
        if beta is not None:
            after = emissions[step + 1] * beta / scales[step + 1]
            now[:len(after)] = after @ model.move.T
            move += alphas[step][:len(after)].T @ after
        gammas.append(alphas[step] * now)
        beta = now
    gamma, kind = np.concatenate(gammas[::-1] or [np.zeros((0, states))]), np.concatenate(kinds or [np.zeros(0, int)])
    emit = np.stack([np.bincount(kind, gamma[:, s], len(model.emit)) for s in range(states)], 1)
    start = gammas[-1].sum(axis=0) if gammas else np.zeros(states)
    reached = np.array([sum(np.log10(scale).sum() for scale in scales), sizes.sum()])
    return start, move * model.move, emit, reached


def _trained_pieces(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences of a shard's training texts, cut to pieces of at most PIECE words."""
    classes = np.frombuffer(row["classes"].as_buffer(), np.uint16)
    sizes = row["sizes"].values.to_numpy().astype(np.int64)
    train = ~row["held_out"].values.to_numpy(zero_copy_only=False)
    kept = classes[np.repeat(train, sizes)]
    sizes = sizes[train]
    pieces = -(-sizes // PIECE)
    cut = np.full(int(pieces.sum()), PIECE)
    if len(cut):
        cut[np.cumsum(pieces) - 1] = sizes - (pieces - 1) * PIECE
    return kept, cut


def _points(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each training piece as a point of unit length, the roots of its class shares: piece, class
    and root of the entries that aren't 0, and a number drawn from the piece's own words."""
    kept, sizes = _trained_pieces(row)
    of = np.repeat(np.arange(len(sizes)), sizes)
    entries, times = np.unique(of * CLASSES + kept, return_counts=True)
    piece = entries // CLASSES
    place = np.arange(len(kept)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = (kept.astype(np.uint64) + np.uint64(1)) * _M1 ^ (place.astype(np.uint64) + np.uint64(7)) * _BASE
    mixed ^= mixed >> np.uint64(31)
    mixed *= _M1
    own = np.add.reduceat(mixed, np.cumsum(sizes) - sizes) if len(sizes) else mixed
    own = (own ^ (own >> np.uint64(29))) * _BASE
    return piece, entries % CLASSES, np.sqrt(times / sizes[piece]), own ^ (own >> np.uint64(32))


def _distances(points: tuple, count: int, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points of unit length to centres, some points at a time."""
    piece, kind, root, _ = points
    near = np.zeros((count, len(centres)))
    for first in range(0, count, 1_024):
        a, b = np.searchsorted(piece, [first, first + 1_024])
        own = piece[a:b] - first
        if b - a > 20 * 1_024:  # long pieces: a table; short ones: only their own entries
            dense = np.zeros((1_024, CLASSES))
            dense[own, kind[a:b]] = root[a:b]
            near[first:first + 1_024] = (dense @ centres.T)[:count - first]
        elif b > a:
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            near[first + own[starts]] = np.add.reduceat(root[a:b, None] * centres.T[kind[a:b]], starts, axis=0)
    return np.maximum(1 - 2 * near + (centres ** 2).sum(axis=1), 0)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def drawn(ready: DataFrame, centres: np.ndarray, turn: int) -> np.ndarray:
    """Up to DRAWN different pieces of all training texts, likelier the farther from the centres.

    A piece's chance comes from its own words and its distance, so neither the order of the texts
    nor their copies matter. Each task sends its own best ones.
    """
    sent = ready.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[float, bytes] = {}
        for row in _rows_of(batches):
            points = _points(row)
            piece, kind, root, own = points
            uniform = (((own + np.uint64(turn + 1)) * _M1 >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
            apart = _distances(points, len(own), sent.value).min(axis=1) if len(sent.value) else np.ones(len(own))
            wait = np.where(apart > 1e-9, -np.log(uniform) / np.maximum(apart, 1e-9), np.inf)
            for k in np.argsort(wait, kind="stable")[:8 * DRAWN].tolist():
                if np.isfinite(wait[k]) and float(wait[k]) not in best:
                    dense = np.zeros(CLASSES)
                    dense[kind[piece == k]] = root[piece == k]
                    best[float(wait[k])] = dense.tobytes()
            best = {key: best[key] for key in sorted(best)[:DRAWN]}
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.float64()), pa.array(list(best.values()), pa.binary())],
                                         names=["wait", "point"])

    rows = map_batches(ready.select("sizes", "held_out", "classes"), run, "wait double, point binary", SHARD_ROWS)
    found = rows.groupBy("wait").agg(F.min("point").alias("point")).orderBy("wait").limit(DRAWN).collect()
    return np.array([np.frombuffer(row["point"]) for row in found]).reshape(-1, CLASSES)


def grouped(ready: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of pieces nearest to each centre, the sum of their points, and of their words by class."""
    sent = ready.sparkSession.sparkContext.broadcast(centres)
    k = len(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2 * CLASSES + 1))
        for row in _rows_of(batches):
            points = _points(row)
            piece, kind, root, own = points
            sizes = _trained_pieces(row)[1]
            nearest = _distances(points, len(own), sent.value).argmin(axis=1)
            flat = nearest[piece] * CLASSES + kind
            total[:, 0] += np.bincount(nearest, minlength=k)
            total[:, 1:CLASSES + 1] += np.bincount(flat, root, k * CLASSES).reshape(k, CLASSES)
            total[:, CLASSES + 1:] += np.bincount(flat, root ** 2 * sizes[piece], k * CLASSES).reshape(k, CLASSES)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total.ravel()[place])],
                                         names=["place", "value"])

    rows = map_batches(ready.select("sizes", "held_out", "classes"), run, "place int, value double", SHARD_ROWS)
    sums = rows.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros(k * (2 * CLASSES + 1))
    total[sums["place"].to_numpy()] = sums["value"].to_numpy()
    total = total.reshape(k, -1)
    return total[:, 0], total[:, 1:CLASSES + 1], total[:, CLASSES + 1:]


def _chosen(points: np.ndarray, weights: np.ndarray, states: int) -> np.ndarray:
    """Centres of a few weighted points: far ones first, then moved to their neighbours' mean."""
    centres = points[[int(weights.argmax())]]
    while len(centres) < min(states, len(points)):
        apart = ((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * weights
        if apart.max() <= 1e-9:
            break
        centres = np.vstack([centres, points[int(apart.argmax())]])
    for _ in range(20):
        near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([np.average(points[near == s], axis=0, weights=weights[near == s] + 1e-9)
                            if (near == s).any() else centres[s] for s in range(len(centres))])
    return centres


def first_guess(ready: DataFrame, states: int = STATES, seed: int = 3) -> Model:
    """States from all training texts: k-means over the roots of their class shares.

    The centres are chosen from pieces that some passes draw far from those drawn before (scalable
    k-means), each weighted by the pieces it is nearest to, and then moved by passes over all
    pieces. States that no piece is left for start from the words of all texts.
    """
    points = np.zeros((0, CLASSES))
    for turn in range(DRAWS):
        points = np.vstack([points, drawn(ready, points, turn)])
    words = np.zeros((0, CLASSES))
    if len(points):
        centres = _chosen(points, grouped(ready, points)[0], states)
        for _ in range(MOVES):
            count, sums, words = grouped(ready, centres)
            centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    flat = words.sum(axis=0) + 0.1
    flat /= flat.sum()
    emit = np.tile(flat, (states, 1))
    for s, own in enumerate(words):
        emit[s] = (own + 20 * flat) / (own.sum() + 20)
    emit *= 1 + 0.01 * np.random.default_rng(seed).random(emit.shape)
    emit /= emit.sum(axis=1, keepdims=True)
    move = np.full((states, states), 0.04 / max(1, states - 1))
    np.fill_diagonal(move, 0.96)
    return Model(np.full(states, 1 / states), move, emit.T.copy())


def _normal(counts: np.ndarray, prior: np.ndarray | float) -> np.ndarray:
    return (counts + prior) / (counts + prior).sum(axis=-1, keepdims=True)


def improved(ready: DataFrame, model: Model) -> tuple[Model, float]:
    """One Baum-Welch round over all training texts, and the mean log10 probability of a token
    under the model that came in.

    Every task adds up its own counts and sends one number per parameter; these are summed by
    Spark, so what reaches the driver is the size of the model.
    """
    sent = ready.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for row in _rows_of(batches):
            counts = np.concatenate([c.ravel() for c in expected_counts(sent.value, *_trained_pieces(row))])
            total = counts if total is None else total + counts
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "value"])

    counts = map_batches(ready.select("sizes", "held_out", "classes"), run, "place int, value double", SHARD_ROWS)
    sums = (counts.groupBy("place").agg(F.sum("value").alias("value")).toPandas())
    flat = np.zeros(states + states * states + states * CLASSES + 2)
    flat[sums["place"].to_numpy()] = sums["value"].to_numpy()
    start, move, emit, reached = np.split(flat, [states, states + states * states, len(flat) - 2])
    emit = emit.reshape(CLASSES, states)
    overall = emit.sum(axis=1) + 0.01
    return Model(_normal(start, 1.0), _normal(move.reshape(states, states), 1.0),
                 _normal(emit.T, 5 * overall / overall.sum()).T.copy()), float(reached[0] / max(reached[1], 1))


def trained(ready: DataFrame, most: int = MOST_ROUNDS, least_gain: float = LEAST_GAIN) -> Model:
    """Baum-Welch rounds until the likelihood of the training texts stops rising."""
    model, before = first_guess(ready), -np.inf
    for _ in range(most):
        model, reached = improved(ready, model)
        if reached - before < least_gain:
            break
        before = reached
    return model


def class_totals(ready: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and tokens of each class in the training texts."""
    rows = ready.select(F.posexplode(F.arrays_zip("class_words", "class_tokens")).alias("place", "e")).groupBy(
        "place").agg(F.sum("e.class_words").alias("words"), F.sum("e.class_tokens").alias("tokens")).toPandas()
    words, tokens = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    words[rows["place"].to_numpy()], tokens[rows["place"].to_numpy()] = rows["words"], rows["tokens"]
    return words, tokens


def score(documents: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    score is log10 of the model's probability of the text: forward over its classes, times each
    word's probability in its class, where all unknown words of a class share one place. A null
    or empty text is its end alone. Repeated rows are scored, and counted, as often as they
    occur. Without training texts all words are unknown. An empty table gives no rows.
    """
    spark = documents.sparkSession
    shards = stored(shards_of(documents), "shards")
    ready = stored(with_totals(shards), "ready")
    words, tokens = class_totals(ready)
    model = trained(ready, most_rounds)
    train_tokens, distinct = int(tokens.sum()), int(words.sum())
    base_log = float(np.log10(train_tokens + 0.5 * (distinct + 1)))
    class_log = np.log10(tokens + 0.5 * (words + 1))
    sent = spark.sparkContext.broadcast((model, class_log))
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, logs = sent.value
        waiting: list[dict] = []

        def made() -> pa.RecordBatch:
            join = lambda name, kind: np.concatenate([r[name].values.to_numpy(zero_copy_only=False) for r in waiting]).astype(kind)
            classes = np.concatenate([np.frombuffer(r["classes"].as_buffer(), np.uint16) for r in waiting])
            sizes, word_logs = join("sizes", np.int64), join("word_logs", np.float64)
            of = np.repeat(np.arange(len(sizes)), sizes)
            scores = log_likelihoods(fitted, classes, sizes) + word_logs - np.bincount(of, logs[classes], len(sizes))
            ids = pa.concat_arrays([r["doc_ids"].values for r in waiting])
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(join("held_out", bool)), pa.array(sizes), pa.array(join("known", np.int64)),
                 pa.array(np.full(len(sizes), train_tokens)), pa.array(word_logs - sizes * base_log),
                 pa.array(scores)], names=_names(schema))

        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                waiting.append({name: batch.column(name)[i] for name in batch.schema.names})
                size += len(waiting[-1]["classes"].as_buffer())
                if size > 4_000_000:  # many texts at once: a step costs the same for few
                    yield made()
                    waiting, size = [], 0
        if waiting:
            yield made()

    rows = ready.select("doc_ids", "held_out", "sizes", "classes", "known", "word_logs")
    return map_batches(rows, run, schema, SHARD_ROWS)
