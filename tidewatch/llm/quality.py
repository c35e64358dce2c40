"""Quality classifier: naive Bayes support vectors (a linear hinge-loss model on n-gram
indicators scaled by the classes' log-count ratios), fitted by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pyspark.sql.types import DoubleType, StructField, StructType

from tidewatch.llm.common import byte_view, chunks, map_batches, packed, text_of, unpacked

FEATURES = 1 << 20  # a text of 100,000 distinct n-grams sets a tenth of them
LABELLED_ROWS = 4_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
C, EPOCHS, SMOOTHING = 10.0, 30, 1.0
CHUNK, CHUNK_ROWS = 500_000, 128
EQUAL_PAIRS, EQUAL_SHARES = (1, 2, 3, 5, 8, 13, 21, 34), (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Model:
    """Weight and squared scale per feature, bias, and what turns margins into probabilities."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, own: np.ndarray) -> float:
        return float(self.weights[own].sum() / max(1e-9, float(np.sqrt(self.squares[own].sum()))) + self.bias)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def indicators(data: np.ndarray, bounds: np.ndarray, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of texts, sorted by row.

    Features are hashed n-grams: bytes 1 to 4, and words 1 and 2, where a word equal to the one
    before gives bigrams of their own kinds, by how often that happens. `data` is the texts' bytes end to end, zero-padded.
    """
    size = int(bounds[-1])
    if size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = int(features).bit_length() - 1
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(size)  # bytes up to the text's end
    kind_of = np.uint32 if (len(bounds) - 1) * features <= 1 << 32 else np.int64
    found: list[np.ndarray] = []

    def put(values: np.ndarray, kind: int, rows: np.ndarray) -> None:
        hashed = (values ^ np.uint64(kind)) * _M1
        hashed ^= hashed >> np.uint64(31)
        found.append((rows * features + ((hashed * _M2) >> np.uint64(64 - bits)).astype(np.int64)).astype(kind_of))

    gram = np.zeros(size, np.uint64)
    for n in range(1, 5):
        gram = (gram << np.uint64(8)) | data[n - 1:n - 1 + size].astype(np.uint64)
        whole = left >= n
        put(gram[whole], n << 56, row[whole])

    inside = data[:size] > 32
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (row[1:] != row[:-1])
    starts = np.nonzero(first)[0]
    if len(starts):
        # A word's hash: the difference of two prefix sums, moved to a common power.
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _M2)]).astype(np.uint64))
        inverse = np.uint64(pow(int(_M2), -1, 1 << 64))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]).astype(np.uint64))
        values = np.where(inside, (data[:size].astype(np.uint64) + np.uint64(1)) * power[:-1], np.uint64(0))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
        last = np.append(starts[1:], size)
        words = (sums[last] - sums[starts]) * back[starts]
        of = row[starts]
        put(words, 5 << 56, of)
        pair = of[1:] == of[:-1]
        same = words[1:] == words[:-1]
        bigram = np.where(same, np.uint64(1), words[:-1] * _M1 + words[1:])
        put(bigram[pair], 6 << 56, of[1:][pair])
        # How many bigrams repeat their word, and how large a share: an indicator per step reached.
        pairs = np.bincount(of[1:][pair], minlength=len(bounds) - 1)
        equal = np.bincount(of[1:][pair & same], minlength=len(bounds) - 1)
        for step, least in enumerate(EQUAL_PAIRS):
            reached = np.nonzero(equal >= least)[0]
            put(np.full(len(reached), step, np.uint64), 7 << 56, reached)
        for step, share in enumerate(EQUAL_SHARES):
            reached = np.nonzero((equal > 0) & (equal >= share * pairs))[0]
            put(np.full(len(reached), step, np.uint64), 8 << 56, reached)
    flat = np.sort(np.concatenate(found))
    flat = flat[np.append(True, flat[1:] != flat[:-1])].astype(np.int64)
    return flat >> bits, flat & (features - 1)


def _rows_of(values: pa.Array, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Indicator pairs of a few texts at a time, with the number of these texts."""
    batch = pa.RecordBatch.from_arrays([values], names=["text"])
    for part in chunks(iter([batch]), CHUNK):
        for at in range(0, part.num_rows, CHUNK_ROWS):
            some = part.slice(at, CHUNK_ROWS).column("text")
            yield *indicators(*byte_view(some), features), len(some)


def _descend(rows: list[np.ndarray], target: np.ndarray, cost: np.ndarray, ratio: np.ndarray,
             epochs: int) -> tuple[np.ndarray, float]:
    """Minimise |w|^2 / 2 + sum of cost * hinge over the dual, one row at a time.

    A row's values are its features' log-count ratios, scaled to unit length.
    """
    weights, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[own] / max(1e-9, float(np.linalg.norm(ratio[own]))) for own in rows]
    order = np.random.default_rng(1)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)):
            slope = target[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slope / 2, 0.0), cost[i])  # 2: the squared length with the bias
            if new != dual[i]:
                step = (new - dual[i]) * target[i]
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i], most = new, max(most, abs(step))
        if most < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and shift that give margins the best likelihood, by Newton steps."""
    wanted = np.where(target > 0, (np.sum(target > 0) + 1) / (np.sum(target > 0) + 2),
                      1 / (np.sum(target < 0) + 2))
    beta, x = np.array([1.0, 0.0]), np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -40, 40)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (wanted - p))
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(texts: list[str | None], classes: list[int], features: int = FEATURES, c: float = C,
        epochs: int = EPOCHS) -> Model:
    """The model of labelled texts. Without rows of both classes the score is the good ones' rate."""
    target = np.where(np.asarray(classes, dtype=np.int64) == 1, 1.0, -1.0)
    good = int((target > 0).sum())
    if good in (0, len(target)):
        rate = (good + 1) / (len(target) + 2)
        return Model(np.zeros(features), np.zeros(features), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    rows: list[np.ndarray] = []
    for row, feature, count in _rows_of(pa.array(texts, pa.string()), features):
        rows += np.split(feature.astype(np.int32), np.searchsorted(row, np.arange(1, count)))
    counts = np.full((2, features), SMOOTHING)
    for own, y in zip(rows, target):
        counts[int(y > 0)][own] += 1
    known = counts.sum(axis=0) > 2 * SMOOTHING  # others tell nothing, and don't lengthen a text either
    ratio = np.log(counts[1] / counts[1][known].sum()) - np.log(counts[0] / counts[0][known].sum())
    ratio[~known] = 0
    cost = c * np.where(target > 0, len(target) / (2 * good), len(target) / (2 * (len(target) - good)))
    weights, bias = _descend(rows, target, cost, ratio, epochs)
    model = Model(weights * ratio, ratio ** 2, bias, 1.0, 0.0)
    margins = np.array([model.margin(own) for own in rows])
    model.slope, model.shift = _logistic(margins, target)
    return model


def labelled_sample(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """text and quality of at most `limit` labelled rows outside the held-out fold, chosen by a
    hash of doc_id. The bound is on labelled rows alone; every document is scored."""
    ids = (labels.where("quality is not null and doc_id is not null")
           .where(fold(F.col("doc_id")) != HELD_OUT)
           .select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
           .orderBy(F.xxhash64("id"), "id", "quality").limit(limit))
    return (documents.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
            .select("doc_id", "text", "quality"))


def train(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> Model:
    """The model of a bounded sample of labelled rows. Rows are sorted, so that the fit doesn't
    depend on their order of arrival."""
    rows = sorted(labelled_sample(documents, labels, limit).collect(),
                  key=lambda r: (r["doc_id"], r["quality"], r["text"] or ""))
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """row (the packed input) and score, the probability of good quality, of every document.

    Only the text is looked at. A null or empty text has no indicators and gets the score of the
    bias alone. One pass without a shuffle.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        features = len(fitted.weights)
        for batch in batches:
            found = [np.zeros(0)]
            for row, feature, count in _rows_of(text_of(batch), features):
                top = np.bincount(row, fitted.weights[feature], count)
                norm = np.sqrt(np.bincount(row, fitted.squares[feature], count))
                found.append(fitted.scores(top / np.maximum(norm, 1e-9) + fitted.bias))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.concatenate(found), pa.float64())], names=["row", "score"])

    rows = packed(documents)
    schema = StructType([rows.schema["row"], StructField("score", DoubleType())])
    return map_batches(rows, run, schema)


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             limit: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. Without usable labels the score
    is 0.5. Repeated rows are scored alike; an empty table gives no rows."""
    model = train(documents, labels, limit)
    doc_id = F.col("row.doc_id")
    return score(documents.select("doc_id", "text"), model).select(
        doc_id.alias("doc_id"), (fold(doc_id) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              limit: int = LABELLED_ROWS) -> DataFrame:
    """The rows of `documents` that the classifier doesn't reject, with their own columns.

    A null text is an empty one; equal texts are judged alike, so repeated rows stay or go
    together, with or without doc_id. Without usable labels every row stays; an empty table
    gives no rows.
    """
    scored = score(documents, train(documents, labels, limit))
    return unpacked(scored.where(F.col("score") >= threshold), documents.columns)
