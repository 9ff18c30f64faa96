"""Where the fits of the intent classifier begin: the optima of all folds, by L-BFGS steps that the folds take together.

Spark's solver scales each term to unit variance, whatever the penalty says about it. With the rare terms of texts, that costs hundreds of steps for each
fold, and each step is a job. In the terms' own scale some 30 steps do, and one pass over the rows serves all folds: a row's products with the
coefficients of all folds are one matrix product. The folds start from the optimum for all rows, which their own ones are close to.

Rows are kept packed (``pack``), a place and a count for each term: their weights are made again, exactly, in each pass.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Entries of the rows that are packed, and met, together.
PACK = 400_000
PACK_ROWS = 256
# Cells of rows and terms in a product.
CELLS = 1_500_000
# Gradients of single rows are small numbers; in single precision they are kept away from the least ones.
SCALE = 2.0**20
# At the end the loss is at most this share above the least one, by the penalty's curvature; all rows' optimum is only a start.
GAP, START_GAP = 1e-6, 0.05
# And no entry of its gradient is larger.
SLOPE = 5e-6
# Steps that a fit remembers, in single precision: its memory is that of so many pairs of coefficients, on the driver.
PAIRS = 7
MOST_STEPS = 5_000
# Sums of more tasks than this are added up by so many tasks before they reach the driver.
SUMS = 16


def pack(y: np.ndarray, fold: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], offsets: list[int]):
    """Packed stretches of rows. A part is, for each spec, where rows begin, places, counts, and each row's length."""
    n = len(y)
    row = np.concatenate([np.repeat(np.arange(n), np.diff(start)) for start, *_ in parts])
    kind = np.concatenate([np.full(len(place), k, np.uint8) for k, (_, place, _, _) in enumerate(parts)])
    place = np.concatenate([place + offset for (_, place, _, _), offset in zip(parts, offsets)])
    tf = np.concatenate([tf for _, _, tf, _ in parts])
    order = np.argsort(row, kind="stable")
    row, kind, place, tf = row[order], kind[order], place[order], tf[order].astype(np.int64)
    start = np.searchsorted(row, np.arange(n + 1))
    low = 0
    while low < n:
        high = max(low + 1, min(low + PACK_ROWS, int(np.searchsorted(start, start[low] + PACK, "right")) - 1))
        own = slice(start[low], start[high])
        sizes = np.stack([np.bincount(row[own][kind[own] == k] - low, minlength=high - low) for k in range(len(parts))])
        yield pickle.dumps((
            y[low:high].astype(np.int32), fold[low:high].astype(np.int32), sizes, np.stack([length[low:high] for *_, length in parts]),
            _small(place[own]), _small(tf[own])), protocol=5)
        low = high


def _small(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 2**8 else np.uint16 if most < 2**16 else np.int32)


def unpack(raw: bytes, idf: np.ndarray, sublinear: list[bool]):
    """``y, fold``, where rows begin, places and weights."""
    y, fold, sizes, length, place, tf = pickle.loads(raw)
    kinds, n = sizes.shape
    size = np.repeat(length.T.ravel(), sizes.T.ravel())
    level = np.arange(int(tf.max(initial=0)) + 1, dtype=float)
    logged = 1.0 + np.log(np.maximum(level, 1.0))
    if all(sublinear):
        count = logged[tf]
    else:
        count = np.where(np.repeat(np.tile(np.array(sublinear), n), sizes.T.ravel()), logged[tf], level[tf])
    return y, fold, np.concatenate([[0], np.cumsum(sizes.sum(axis=0))]), place, count * idf[place] / size


@dataclass
class Pass:
    """What a task needs to sum losses and gradients: coefficients of the fits side by side, and each fit's weight of a row by fold and class."""

    matrix: np.ndarray  # terms x (fits x classes)
    shift: np.ndarray  # fits x classes
    weight: np.ndarray  # fits x folds x classes
    idf: np.ndarray
    sublinear: list[bool]

    def sums(self, raws) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fits, k = self.shift.shape
        kind, terms = self.matrix.dtype, len(self.matrix)
        loss, top, low = np.zeros(fits), np.zeros(self.shift.shape), np.zeros((fits * k, terms))
        most = max(1, CELLS // terms)
        wide = np.zeros((most, terms), kind)  # some rows with all their zeros: a dense product takes less than picking the rest out
        for raw in raws:
            ys, folds, starts, places, values = unpack(raw, self.idf, self.sublinear)
            values = values.astype(kind)
            for first in range(0, len(ys), most):
                y, fold, start = ys[first : first + most], folds[first : first + most], starts[first : first + most + 1]
                n, own = len(y), slice(start[0], start[-1])
                cell = np.repeat(np.arange(n) * terms, np.diff(start)) + places[own]
                np.put(wide, cell, values[own])
                margin = (wide[:n] @ self.matrix).astype(float).reshape(n, fits, k) + self.shift
                margin -= margin.max(axis=2, keepdims=True)
                chance = np.exp(margin)
                total = chance.sum(axis=2)
                weight = self.weight[:, fold, y].T  # rows x fits
                loss += (weight * (np.log(total) - np.take_along_axis(margin, y[:, None, None].astype(np.int64), 2)[:, :, 0])).sum(axis=0)
                off = chance / total[:, :, None]
                off[np.arange(n), :, y] -= 1.0
                off *= weight[:, :, None] * SCALE
                top += off.sum(axis=0) / SCALE
                low += np.ascontiguousarray(off.reshape(n, -1).T.astype(kind)) @ wide[:n]
                np.put(wide, cell, kind.type(0))
        return loss, top, (low.T / SCALE).astype(kind)


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    return float((a * b).sum(dtype=float))


class Fit:
    """One fit's L-BFGS steps: ``point`` is where it wants loss and gradient next, ``take`` gets them. Coefficients are terms x classes, the last row is the intercepts."""

    def __init__(self, start: np.ndarray, penalty: float, gap: float):
        self.point, self.penalty, self.gap = start, penalty, gap
        self.at, self.pairs, self.step, self.done, self.stuck = None, [], 1.0, False, False
        self.least = 1e-2  # shorter steps tell noise of single precision from a descent no more

    def take(self, loss: float, gradient: np.ndarray) -> None:
        loss += self.penalty / 2 * float((self.point[:-1] ** 2).sum())
        gradient[:-1] += self.penalty * self.point[:-1]
        if self.at is not None:
            if not loss <= self.loss + 1e-4 * self.step * self.slope + 1e-15 * abs(self.loss):
                self.step /= 2
                self.stuck = self.step < self.least
                self.point = self.at + self.step * self.way
                return
            moved, turned = self.point - self.at, gradient - self.gradient
            if float((moved * turned).sum()) > 1e-25:
                self.pairs = [*self.pairs, (moved.astype(np.float32), turned.astype(np.float32))][-PAIRS:]
        self.at, self.loss, self.gradient = self.point, loss, gradient
        near = float((gradient**2).sum()) <= 2 * self.penalty * self.gap * max(loss, 1e-12)
        self.done = near and (self.gap > GAP or float(np.abs(gradient).max()) <= SLOPE)
        if not self.done:
            self._turn()

    def _turn(self) -> None:
        way, kept = -self.gradient, []
        for moved, turned in reversed(self.pairs):
            share = float((moved * way).sum()) / _dot(moved, turned)
            kept.append(share)
            way = way - share * turned
        if self.pairs:
            moved, turned = self.pairs[-1]
            way = way * (_dot(moved, turned) / _dot(turned, turned))
        else:
            way = way / max(1.0, float(np.sqrt((self.gradient**2).sum())))
        for (moved, turned), share in zip(self.pairs, reversed(kept)):
            way = way + (share - float((turned * way).sum()) / _dot(moved, turned)) * moved
        self.way, self.slope, self.step = way, float((way * self.gradient).sum()), 1.0
        self.point = self.at + way

    def again(self) -> None:
        """From the best point once more, without what was learnt about the curvature."""
        self.point, self.at, self.pairs, self.stuck, self.least = self.at, None, [], False, 1e-8


def _plus(whole, parts):
    if whole is None:
        return tuple(x.astype(float) for x in parts)
    for a, b in zip(whole, parts):
        a += b
    return whole


def _added(batches):
    whole = None
    for batch in batches:
        for raw in batch.column(0):
            parts = pickle.loads(raw.as_py())
            whole = _plus(whole, parts)
    if whole is not None:
        yield pa.record_batch([pa.array([pickle.dumps(whole, protocol=5)], pa.binary())], ["sums"])


def _totals(rows: DataFrame, tasks: int, work: Pass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Losses and gradients over all rows: a task sends one row of sums."""
    shared = rows.sparkSession.sparkContext.broadcast(work)

    def run(batches):
        raws = (raw.as_py() for batch in batches for raw in batch.column(0))
        yield pa.record_batch([pa.array([pickle.dumps(shared.value.sums(raws), protocol=5)], pa.binary())], ["sums"])

    told = rows.mapInArrow(run, "sums binary")
    if tasks > SUMS:
        told = told.repartition(SUMS).mapInArrow(_added, "sums binary")
    whole = None
    for raw in told.collect():
        whole = _plus(whole, pickle.loads(raw[0]))
    shared.destroy()
    return whole


def _solve(rows: DataFrame, fits: list[Fit], weights: np.ndarray, idf: np.ndarray, sublinear: list[bool]) -> None:
    """All fits, side by side, to the end: in single precision as far as that goes, in double from there."""
    kinds: list[type] = [np.float32] * len(fits)
    tasks = rows.rdd.getNumPartitions()
    for _ in range(MOST_STEPS):
        open_ = [i for i, f in enumerate(fits) if not f.done]
        if not open_:
            return
        kind = np.float64 if any(kinds[i] is np.float64 for i in open_) else np.float32
        points = [fits[i].point for i in open_]
        matrix = np.concatenate([p[:-1] for p in points], axis=1).astype(kind)
        work = Pass(matrix, np.stack([p[-1] for p in points]), weights[open_], idf, sublinear)
        loss, top, low = _totals(rows, tasks, work)
        k = top.shape[1]
        for n, i in enumerate(open_):
            fits[i].take(float(loss[n]), np.vstack([low[:, n * k : (n + 1) * k], top[n]]))
            if fits[i].stuck:
                if kinds[i] is np.float64:
                    fits[i].done = True  # no step lowers the loss: as near as numbers get
                else:
                    kinds[i] = np.float64
                    fits[i].again()
    raise RuntimeError(f"no convergence in {MOST_STEPS} steps")


def fold_optima(
    rows: DataFrame, counts: dict[tuple[int, int], int], folds: int, k: int, c: float, idf: np.ndarray, sublinear: list[bool]
) -> list[np.ndarray | None]:
    """For each fold the optimum without its rows, as classes x (terms + 1); None where fewer than two classes are left.

    ``rows`` are packed rows, ``counts`` the rows of each class and fold, ``idf`` that of each place.
    """
    size = len(idf)

    def setting(left_out: int | None):
        own = {y: sum(m for (z, g), m in counts.items() if z == y and g != left_out) for y, _ in counts}
        own = {y: m for y, m in own.items() if m}
        total, weight = sum(own.values()), np.zeros((folds, k))
        for y, m in own.items():
            weight[:, y] = 1.0 / (len(own) * m)
        if left_out is not None:
            weight[left_out] = 0.0
        start = np.log1p(np.array([total / len(own) if y in own else 0.0 for y in range(k)])) if own else np.zeros(k)
        return weight, total, start - start.mean(), len(own)

    weight, total, start, classes = setting(None)
    if classes < 2:
        return [None] * folds
    whole = Fit(np.vstack([np.zeros((size, k)), start]), 1.0 / (c * total), START_GAP)
    _solve(rows, [whole], weight[None], idf, sublinear)
    whole.pairs = []
    settings = [setting(f) for f in range(folds)]
    which = [f for f, (*_, classes) in enumerate(settings) if classes > 1]
    fits = []
    for f in which:
        _, total, start, _ = settings[f]
        begin = whole.at.copy()
        gone = [y for y in range(k) if not any(m for (z, g), m in counts.items() if z == y and g != f)]
        begin[:, gone] = 0.0
        begin[-1, gone] = begin[-1].min() - np.log1p(total)
        fits.append(Fit(begin, 1.0 / (c * total), GAP))
    if fits:
        _solve(rows, fits, np.stack([settings[f][0] for f in which]), idf, sublinear)
    found: list[np.ndarray | None] = [None] * folds
    for f, fit in zip(which, fits):
        point = fit.at.copy()
        point[-1] -= point[-1].mean()
        found[f] = point.T
    return found
