"""Embedding whitening: principal components by a block Jacobi-Davidson iteration over Spark.

Vectors become whole numbers, and each distinct one is fitted once. The covariance is never
built: a product with a few directions is one pass over the stored list, in which a task centres
its rows, multiplies them twice and sends one small table. Ritz pairs come from a subspace kept
on the driver (width times some 60 numbers); those whose residual has reached double precision
are locked. The others are corrected: MINRES solves all projected correction equations of a round
at once, so that an inner step is one pass, too. A full subspace restarts from its best half.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import map_batches, stored

COMPONENTS = 16
# A level is floor(64 c); a constant added to all of them, as 1,000,000, cancels in every result.
SCALE = 64
# Levels beyond this (entries of some 7e13) count as this: whole numbers stay exact in doubles.
LARGEST = 2 ** 52
GUARD = 4
INNER_STEPS = 12
MOST_ROUNDS = 500
BLOCK_ROWS = 1_024
# What the tasks of one pass send to the driver together, at most.
GATHERED_BYTES = 64_000_000
EPSILON = float(np.finfo(float).eps)

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# --- input -----------------------------------------------------------------------

def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id and the vector's levels floor(64 c) as bytes of 64-bit numbers."""
    for batch in batches:
        ids, vectors = batch.column("vec_id"), batch.column("embedding")
        kept = vectors.is_valid()
        ids, vectors = ids.filter(kept), vectors.filter(kept)
        entries = vectors.flatten()
        ends = np.cumsum(np.concatenate([[0], vectors.value_lengths().to_numpy(zero_copy_only=False)])).astype(np.int64)
        values = entries.to_numpy(zero_copy_only=False).astype(float)  # null becomes NaN
        spoilt = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        whole = spoilt[ends[1:]] == spoilt[ends[:-1]]
        if not whole.any():
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST)
        lengths = np.diff(ends)
        levels = scaled[np.repeat(whole, lengths)].astype("<i8")
        places = np.concatenate([[0], np.cumsum(lengths[whole]) * 8]).astype(np.int32)
        packed = pa.BinaryArray.from_buffers(
            pa.binary(), int(whole.sum()), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(levels.tobytes())])
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(whole)).cast(pa.int64()), packed], ["vec_id", "levels"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Many rows' levels as one value."""
    for batch in batches:
        for first in range(0, len(batch), BLOCK_ROWS):
            rows = batch.column("levels").slice(first, BLOCK_ROWS).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(rows)], pa.binary())], ["block"])


class Fit(NamedTuple):
    """The list of distinct vectors, and its exact sums."""
    blocks: DataFrame
    width: int
    n: int
    sums: list[int]


def _gathered(fit_blocks: DataFrame, width: int, function: Callable[[np.ndarray], np.ndarray],
              shape: tuple[int, ...], kind) -> list[np.ndarray]:
    """The sum of `function` over the blocks of each task, one array a task.

    Tasks are as few as keep all these arrays within a bound, whatever the size of the list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for value in batch.column("block"):
                total += function(np.frombuffer(value.as_buffer(), "<i8").reshape(-1, width))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    most = max(32, GATHERED_BYTES // max(8 * math.prod(shape), 1))
    rows = map_batches(fit_blocks.coalesce(most), run, "part binary", rows=16).collect()
    return [np.frombuffer(row["part"], kind).reshape(shape) for row in rows]


def _halves(rows: np.ndarray) -> np.ndarray:
    """Sums of the high and low halves: neither can overflow below 2^31 rows a task."""
    return np.stack([(rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0),
                     np.full(rows.shape[1], len(rows))])


def fit_list(levels: DataFrame, width: int) -> Fit:
    """Each distinct vector once, in blocks, stored; shorter vectors end in zeros."""
    padded = levels.select(F.expr(f"rpad(levels, {8 * width}, X'00')").alias("levels"))
    blocks = stored(map_batches(padded.distinct(), _blocks, "block binary"), "fit-list")
    parts = _gathered(blocks, width, _halves, (3, width), np.int64)
    high, low, count = (sum(part[k].astype(object) for part in parts) for k in range(3))
    return Fit(blocks, width, int(count[0]), [int(h) * 2 ** 32 + int(b) for h, b in zip(high, low)])


def _centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Rows minus the mean: whole parts subtracted exactly, then the fraction."""
    shift = [total // n for total in sums]
    rest = np.array([(total - n * s) / n for total, s in zip(sums, shift)])
    whole = np.array(shift, np.int64)
    return lambda rows: (rows - whole).astype(float) - rest


def covariance_times(fit: Fit, directions: np.ndarray) -> np.ndarray:
    """The covariance times each column, by one pass over the list."""
    centred = _centring(fit.n, fit.sums)

    def product(rows: np.ndarray) -> np.ndarray:
        c = centred(rows)
        return c.T @ (c @ directions)

    parts = _gathered(fit.blocks, fit.width, product, directions.shape, float)
    return sum(parts) / fit.n


def trace(fit: Fit) -> float:
    centred = _centring(fit.n, fit.sums)
    parts = _gathered(fit.blocks, fit.width, lambda rows: (centred(rows) ** 2).sum(axis=0), (fit.width,), float)
    return float(sum(parts).sum() / fit.n)


# --- Jacobi-Davidson ---------------------------------------------------------------

def _orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to `against`."""
    sizes = np.linalg.norm(columns, axis=0)
    columns = columns[:, sizes > 0] / sizes[sizes > 0]
    for _ in range(3):
        columns = columns - against @ (against.T @ columns)
        left, spread, _ = np.linalg.svd(columns, full_matrices=False)
        columns = left[:, spread > 1e-8 * max(1.0, spread[0] if len(spread) else 1.0)] if columns.size else columns
    return columns


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int,
           enough: float = 1e-2) -> np.ndarray:
    """Approximate solutions of symmetric systems, one for each column, all stepped at once.

    A column whose residual has fallen to `enough` of its start stands still.
    """
    start = np.linalg.norm(right, axis=0)
    beta = start.copy()
    safe = np.where(start > 0, start, 1)
    now, before = right / safe, np.zeros_like(right)
    solution = np.zeros_like(right)
    d1, d2 = np.zeros_like(right), np.zeros_like(right)
    c1, s1 = np.ones_like(beta), np.zeros_like(beta)
    c2, s2 = np.ones_like(beta), np.zeros_like(beta)
    left, last = start.copy(), np.zeros_like(beta)
    for _ in range(steps):
        going = np.abs(left) > enough * start
        if not going.any():
            break
        image = apply(now)
        alpha = (now * image).sum(axis=0)
        image = image - alpha * now - last * before
        following = np.linalg.norm(image, axis=0)
        # Two earlier rotations, then the one that removes `following`.
        epsilon = s2 * last
        delta = c1 * c2 * last + s1 * alpha
        gamma = c1 * alpha - s1 * c2 * last
        size = np.hypot(gamma, following)
        steady = going & (size > EPSILON * np.maximum(np.abs(alpha), 1e-300))
        size = np.where(size > 0, size, 1)
        c, s = gamma / size, following / size
        direction = (now - delta * d1 - epsilon * d2) / size
        solution = solution + np.where(steady, c * left, 0) * direction
        d1, d2 = direction, d1
        left = np.where(steady, -s * left, 0)
        c1, s1, c2, s2 = c, s, c1, s1
        before, now = now, image / np.where(following > 0, following, 1)
        last = following
        left = np.where(following > EPSILON * np.maximum(np.abs(alpha), 1e-300), left, 0)
        if not np.any(np.abs(left) > enough * start):
            break
    return solution


def leading_pairs(apply: Callable[[np.ndarray], np.ndarray], width: int,
                  wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of a symmetric positive operator.

    Every residual ends within rounding of the largest eigenvalue.
    """
    block = min(width, wanted + GUARD)
    room = min(width, 3 * block)
    draw = np.random.default_rng(1)
    locked, values = np.zeros((width, 0)), np.zeros(0)
    basis = _orthonormal(draw.standard_normal((width, block)), locked)
    images = apply(basis)
    least, patience = math.inf, 0
    for _ in range(MOST_ROUNDS):
        small = basis.T @ images
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        residual = images - basis * ritz
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        scale = max([*values, *ritz])
        enough = 8 * EPSILON * math.sqrt(width) * scale
        # A residual that has stopped falling close to rounding is as good as it gets.
        needed = max(wanted - len(values), 1)
        worst = sizes[:needed].max(initial=0.0)
        patience = 0 if worst < 0.5 * least else patience + 1
        least = min(least, worst)
        bound = enough if patience < 6 else max(enough, min(1e-11 * scale, 4 * least))
        done = 0
        while done < len(ritz) and sizes[done] <= bound and (
                len(values) + done < wanted or ritz[done] > min([*values, *ritz[:done]])):
            done += 1
        if done:
            locked = np.hstack([locked, basis[:, :done]])
            values = np.concatenate([values, ritz[:done]])
            basis, images, residual = basis[:, done:], images[:, done:], residual[:, done:]
            ritz, sizes, least, patience = ritz[done:], sizes[done:], math.inf, 0
        full = locked.shape[1] + basis.shape[1] >= width
        if len(values) >= wanted and (not len(ritz) or ritz[0] <= np.sort(values)[::-1][wanted - 1]):
            break
        if basis.shape[1] > room - block and not full:
            basis, images = basis[:, :room // 2], images[:, :room // 2]
            ritz, residual, sizes = ritz[:room // 2], residual[:, :room // 2], sizes[:room // 2]
        chosen = np.arange(len(ritz))[:block]
        chosen = chosen[sizes[chosen] > bound]
        beside = np.hstack([locked, basis[:, :block]])
        shifts = ritz[chosen]

        def projected(columns: np.ndarray) -> np.ndarray:
            columns = columns - beside @ (beside.T @ columns)
            image = apply(columns) - columns * shifts
            return image - beside @ (beside.T @ image)

        right = -(residual[:, chosen] - beside @ (beside.T @ residual[:, chosen]))
        known = np.hstack([locked, basis])
        fresh = _orthonormal(minres(projected, right, INNER_STEPS), known) if len(chosen) and not full else right[:, :0]
        if not fresh.shape[1] and not full:
            fresh = _orthonormal(draw.standard_normal((width, 1)), known)
        if fresh.shape[1]:
            basis, images = np.hstack([basis, fresh]), np.hstack([images, apply(fresh)])
        else:
            images = apply(basis)
    else:
        raise RuntimeError("the components did not converge")
    # One more Rayleigh-Ritz step over fresh products evens out what locking left.
    locked = np.linalg.qr(locked)[0]
    small = locked.T @ apply(locked)
    ritz, turn = np.linalg.eigh((small + small.T) / 2)
    return ritz[::-1][:wanted], (locked @ turn[:, ::-1])[:, :wanted]


# --- result ------------------------------------------------------------------------

def components(fit: Fit, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, eigenvectors and the trace of the list's covariance.

    Directions without variance have the eigenvalue 0.
    """
    whole = trace(fit)
    wanted = min(most, fit.width)
    if not whole > 0:
        return np.zeros(wanted), np.eye(fit.width)[:, :wanted], 0.0
    values, vectors = leading_pairs(lambda p: covariance_times(fit, p), fit.width, wanted)
    flat = values <= 16 * EPSILON * fit.width * values[0]
    return np.where(flat, 0.0, values), vectors, whole


def identity_error(fit: Fit, transform: np.ndarray) -> float:
    """How far the whitened list's covariance is from the identity, at its worst entry."""
    k = transform.shape[1]
    if not k:
        return 0.0
    centred = _centring(fit.n, fit.sums)

    def moments(rows: np.ndarray) -> np.ndarray:
        white = centred(rows) @ transform
        return white.T @ white

    total = sum(_gathered(fit.blocks, fit.width, moments, (k, k), float))
    return float(np.abs(total / fit.n - np.eye(k)).max())


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; null where one does not fit a long."""
    shift = [total // n for total in sums]
    apart = rows - np.array(shift, np.int64)
    rest = [total - n * s for total, s in zip(sums, shift)]
    far = n * (int(np.abs(apart).max(initial=0)) + 1)
    if far * far * rows.shape[1] < 2 ** 63:
        return ((n * apart - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * apart.astype(object) - np.array(rest, object)) ** 2).sum(axis=1)
    return [int(value) if value < 2 ** 63 else None for value in exact]


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """Each usable vector's first components, scaled to unit variance over the distinct vectors.

    Rows whose vector is null or holds a null or an entry that is not finite are left out; all
    others come out once for each component, also with repeated or null ids. Vectors shorter than
    the longest end in zeros. Entries beyond 7e13 count as that. A component without variance has
    explained 0 and whitened null; a deviation that doesn't fit a long is null. Without usable
    vectors, or with empty ones only, there are no rows. Columns but vec_id and embedding are not
    read.
    """
    spark = embeddings.sparkSession
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                              F.col("embedding").cast("array<double>").alias("embedding"))
    levels = stored(map_batches(given, _levels, "vec_id long, levels binary"), "levels")
    width = (levels.agg(F.max(F.octet_length("levels"))).first()[0] or 0) // 8
    if not width:
        return spark.createDataFrame([], RESULT)
    fit = fit_list(levels, width)
    values, vectors, whole = components(fit, most)
    seen = values > 0
    transform = vectors[:, seen] / np.sqrt(values[seen])
    error = identity_error(fit, transform)
    n, sums, k = fit.n, fit.sums, len(values)
    explained = values / whole if whole else values
    centred = _centring(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = len(batch)
            rows = np.frombuffer(b"".join(v.ljust(8 * width, b"\0") for v in batch.column("levels").to_pylist()),
                                 "<i8").reshape(count, width)
            white = np.full((count, k), np.nan)
            white[:, seen] = centred(rows) @ transform
            each = np.repeat(np.arange(count), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, n)),
                pa.array(_deviations(rows, n, sums), pa.int64()).take(pa.array(each)),
                pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                pa.array(np.tile(explained, count)),
                pa.array(np.full(count * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(levels, run, RESULT)
