"""Linear SVMs over random Fourier features, several over parts of the same rows at once.

Rows are kept as blocks of their few inputs, not of their many features, which a pass computes
again: 64 features are 512 bytes of a row, its inputs some 20. One pass over the blocks gives the
loss and gradient of every model at the next points of its line search, so that all models
together take little more than the passes of one. The steps are those of Spark's LinearSVC.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.sources.scratch import staged

#: Tasks of a pass for each core at most, blocks of a task at least, rows whose features are held.
TASKS, TASK_BLOCKS, HELD_ROWS = 2, 8, 512
#: Earlier steps that a direction is made from, and function values that must have stopped falling.
STEPS_KEPT, VALUES_KEPT = 10, 20
#: Line search: trials at most, least fall and largest slope that are left, as shares of the slope.
TRIALS, ARMIJO, WOLFE = 20, 1e-4, 0.9
#: sin(2 pi w) = w (S0 + S1 w^2 + ...) for w up to 1/4 in size, to the last bits.
_SINE = (
    6.283185307179585, -41.341702240398284, 81.60524927557968, -76.70585968962106,
    42.05868995361403, -15.094506133219056, 3.8173655508049134, -0.6925063439624329,
)


def _cosines(turns: np.ndarray) -> np.ndarray:
    """cos(2 pi t) of an array, which is overwritten; several times faster than numpy's."""
    square = np.rint(turns)
    turns -= square
    np.abs(turns, out=turns)
    np.subtract(0.25, turns, out=turns)
    np.multiply(turns, turns, out=square)
    out = square * _SINE[-1]
    for c in _SINE[-2:0:-1]:
        out += c
        out *= square
    out += _SINE[0]
    out *= turns
    return out


@dataclass(frozen=True)
class Waves:
    """sqrt(2/D) cos(W x + b) of numbers and levels: an indicator of a level adds its weights."""

    weights: np.ndarray
    offsets: np.ndarray
    numbers: int
    #: Levels of each categorical input, in the order of their indicators after the numbers.
    levels: tuple[tuple[str, ...], ...]

    def pieces(self, block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Labels (0 or 1), folds and features of some rows at a time."""
        size = block["n"]
        x = np.frombuffer(block["numbers"]).reshape(size, self.numbers)
        codes = np.frombuffer(block["codes"], np.int32).reshape(-1, len(self.levels))
        label = np.frombuffer(block["labels"], np.int8)
        fold = np.frombuffer(block["folds"], np.int8)
        scale = math.sqrt(2.0 / len(self.offsets))
        slopes = np.ascontiguousarray(self.weights[:, : self.numbers].T) / (2 * math.pi)
        edges = np.frombuffer(block["edges"], np.int64)
        for code, first, last in zip(codes, edges[:-1], edges[1:], strict=True):
            # The rows of a run have the same levels.
            shift, at = self.offsets.copy(), self.numbers
            for c, known in zip(code, self.levels, strict=True):
                if c >= 0:
                    shift += self.weights[:, at + c]
                at += len(known)
            shift /= 2 * math.pi
            for a in range(int(first), int(last), HELD_ROWS):
                b = min(a + HELD_ROWS, int(last))
                waves = _cosines(x[a:b] @ slopes + shift)
                waves *= scale
                yield label[a:b], fold[a:b], waves


_BLOCK = "n int, numbers binary, codes binary, edges binary, labels binary, folds binary"


def blocks(rows: DataFrame, numbers: Sequence[str], levels: dict[str, Sequence[str]]) -> DataFrame:
    """Rows staged as blocks: numeric and categorical inputs, ``label_code`` and ``_fold``. Rows of
    a block lie in the order of their levels."""
    known = [(c, {v: i for i, v in enumerate(some)}) for c, some in levels.items()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = np.empty((size, len(numbers)))
            for i in range(len(numbers)):
                x[:, i] = batch.column(f"_n{i}").to_numpy(zero_copy_only=False)
            codes = np.empty((size, len(known)), np.int32)
            for i, (_, place) in enumerate(known):
                held = batch.column(f"_c{i}").dictionary_encode()
                found = np.array([place.get(v, -1) for v in held.dictionary.to_pylist()] or [-1], np.int32)
                at = held.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                codes[:, i] = np.where(at < 0, -1, found[at])
            order = np.lexsort(codes.T) if known else np.arange(size)
            codes = codes[order]
            new = np.ones(size, bool)
            new[1:] = (codes[1:] != codes[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            label = batch.column("_label").to_numpy(zero_copy_only=False)[order].astype(np.int8)
            fold = batch.column("_fold").to_numpy(zero_copy_only=False)[order].astype(np.int8)
            held = (x[order].tobytes(), codes[first].tobytes(), np.append(first, size).astype(np.int64).tobytes())
            parts = [pa.array([v], pa.binary()) for v in (*held, label.tobytes(), fold.tobytes())]
            names = ["n", "numbers", "codes", "edges", "labels", "folds"]
            yield pa.record_batch([pa.array([size], pa.int32()), *parts], names)

    given = rows.select(
        *[F.col(c).alias(f"_n{i}") for i, c in enumerate(numbers)],
        *[F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(levels)],
        F.col("label_code").cast("int").alias("_label"), F.col("_fold").cast("int").alias("_fold"),
    )
    return staged(given.mapInArrow(work, _BLOCK), "svm-blocks")


def _summed(held: DataFrame, waves: Waves, first: np.ndarray, step) -> np.ndarray:
    """``step(sums, label, fold, features)`` over all pieces, added up over the tasks."""
    size = first.size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = first.copy()
        for batch in batches:
            for block in batch.to_pylist():
                for piece in waves.pieces(block):
                    step(sums, *piece)
        yield pa.record_batch({"sums": pa.array([sums.tobytes()], pa.binary())})

    out = first.copy()
    for row in held.mapInArrow(work, "sums binary").collect():
        out += np.frombuffer(row["sums"], count=size).reshape(first.shape)
    return out


def _moments(held: DataFrame, waves: Waves, folds: int) -> np.ndarray:
    """Per fold: rows of class 0 and 1, sums and sums of squares of the features."""
    size = len(waves.offsets)

    def step(sums, label, fold, x):
        for f in np.unique(fold).tolist():
            mine = fold == f
            ones = int(label[mine].sum())
            sums[f, :2] += int(mine.sum()) - ones, ones
            sums[f, 2 : 2 + size] += mine.astype(float) @ x
            sums[f, 2 + size :] += mine.astype(float) @ (x * x)

    return _summed(held, waves, np.zeros((folds, 2 + 2 * size)), step)


def _losses(held: DataFrame, waves: Waves, points: np.ndarray, without: np.ndarray) -> np.ndarray:
    """Sums of hinge losses and their gradients at each point (weights, then the intercept), over
    the rows that are not of the point's fold."""
    slopes, shifts = np.ascontiguousarray(points[:, :-1].T), points[:, -1].copy()

    def step(sums, label, fold, x):
        sign = np.where(label == 1, 1.0, -1.0)[:, None]
        short = 1.0 - sign * (x @ slopes + shifts)
        pulls = ((short > 0) & (fold[:, None] != without)).astype(float)
        sums[:, 0] += (short * pulls).sum(axis=0)
        pulls *= -sign
        sums[:, 1:-1] += pulls.T @ x
        sums[:, -1] += pulls.sum(axis=0)

    return _summed(held, waves, np.zeros((len(points), points.shape[1] + 1)), step)


class _Lost(Exception):
    """A search that found no step."""


def _direction(steps: list[np.ndarray], falls: list[np.ndarray], slope: np.ndarray) -> np.ndarray:
    """Minus the slope times the inverse Hessian that the last steps tell of, the newest first."""
    out, rates, scale = slope.copy(), [], 1.0
    if steps:
        along, size = float(steps[0] @ falls[0]), float(falls[0] @ falls[0])
        if along < 0 or math.isnan(along) or size == 0:
            raise _Lost
        scale = along / size
    for s, y in zip(steps, falls, strict=True):
        along = float(s @ y)
        rates.append(float(s @ out) / along if along else math.nan)
        if math.isnan(rates[-1]):
            raise _Lost
        out -= rates[-1] * y
    out *= scale
    for s, y, rate in reversed(list(zip(steps, falls, rates, strict=True))):
        out += (rate - float(y @ out) / float(s @ y)) * s
    return -out


Asked = Generator[list[np.ndarray], list[tuple[float, np.ndarray]], np.ndarray]


def descended(size: int, max_iter: int, tolerance: float) -> Asked:
    """Minimum of a function from 0, by limited-memory quasi-Newton steps within the orthant of a
    point; yields points, is sent value and slope of each, and returns the last point.

    It ends after ``max_iter`` steps, where the value has not fallen by more than ``tolerance`` of
    the first one since the highest of the last 20, or where no step is found any more.
    """
    x = np.zeros(size)
    ((value, slope),) = yield [x]
    first, values = value, [math.inf]
    steps: list[np.ndarray] = []
    falls: list[np.ndarray] = []
    taken, failed = 0, False
    while True:
        still = len(values) >= 2 and abs(value - max(values)) <= tolerance * first
        flat = np.linalg.norm(slope) <= max(tolerance * value, 1e-8)
        if taken >= max_iter or still or flat:
            return x
        try:
            go = _direction(steps, falls, slope)
            go = np.where(go * slope < 0, go, 0.0)
            side = np.where(x != 0, np.sign(x), np.sign(-slope))

            def at(share, x=x, go=go, side=side):
                to = x + share * go
                return np.where(np.sign(to) == side, to, 0.0)

            down, shrink = float(slope @ go), 0.5 if taken else 0.1
            share = 1.0 if taken else 0.5 / np.linalg.norm(slope)
            seen: dict[float, tuple[float, np.ndarray]] = {}
            for trial in range(TRIALS):
                # The first share is never taken: the one after it is tried first.
                found, left = value, down
                if trial or not down:
                    if share not in seen:
                        ahead = [share, share * 2.1, share * shrink]
                        seen |= dict(zip(ahead, (yield [at(a) for a in ahead]), strict=True))
                    found, left = seen[share][0], float(seen[share][1] @ go)
                if found > value + share * down * ARMIJO or not trial and down:
                    factor = shrink
                elif left < WOLFE * down:
                    factor = 2.1
                elif left > -WOLFE * down:
                    factor = shrink
                else:
                    break
                if trial == TRIALS - 1:
                    break  # The last trial is taken as it is.
                share *= factor
                if not 1e-10 <= share <= 1e10:
                    raise _Lost
            to = at(share)
            found, there = seen[share]
        except _Lost:
            if failed:
                return x
            failed, steps, falls = True, [], []
            continue
        steps = [to - x, *steps][:STEPS_KEPT]
        falls = [there - slope, *falls][:STEPS_KEPT]
        values = [*values, found][-VALUES_KEPT:]
        x, value, slope = to, found, there
        taken, failed = taken + 1, False


@dataclass(frozen=True)
class Fits:
    """Weights and intercept of the model of all rows, then of those without each fold, and the rows
    of each class by fold."""

    held: DataFrame
    waves: Waves
    points: np.ndarray
    classes: np.ndarray

    def model(self, like: LinearSVC) -> LinearSVCModel:
        """The model of all rows as a stage of a pipeline, with the columns and settings of ``like``."""
        spark = self.held.sparkSession
        ml, weights = spark._jvm.org.apache.spark.ml, self.points[0, :-1].tolist()
        array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(weights))
        for i, v in enumerate(weights):
            array[i] = v
        vector = ml.linalg.DenseVector(array)
        java = ml.classification.LinearSVCModel(like.uid, vector, float(self.points[0, -1]))
        return like._copyValues(LinearSVCModel(java))

    def margins(self) -> DataFrame:
        """``label_code``, ``_fold`` and ``_margins``, one by each model, of all rows."""
        waves, slopes, shifts = self.waves, self.points[:, :-1].T.copy(), self.points[:, -1]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.to_pylist():
                    found = [(y, f, x @ slopes + shifts) for y, f, x in waves.pieces(block)]
                    label, fold, all_ = (np.concatenate(v) for v in zip(*found, strict=True))
                    edges = pa.array(np.arange(len(all_) + 1, dtype=np.int32) * len(shifts))
                    yield pa.record_batch(
                        [
                            pa.array(label.astype(float)), pa.array(fold.astype(np.int32)),
                            pa.ListArray.from_arrays(edges, pa.array(all_.ravel())),
                        ],
                        ["label_code", "_fold", "_margins"],
                    )

        return self.held.mapInArrow(work, "label_code double, _fold int, _margins array<double>")


def fit(held: DataFrame, waves: Waves, folds: int, cost: float, max_iter: int, tolerance: float) -> Fits:
    """Models of all rows and of those without each fold, fitted side by side; with one fold only
    that of all. The penalty is 1 / (cost rows) of each model; features are centred and divided by
    their deviation while the steps are taken, as LinearSVC does."""
    # As many blocks in each task; a pass takes as long as its longest one.
    cores = held.sparkSession.sparkContext.defaultParallelism
    dealt = held.repartition(max(1, min(TASKS * cores, held.count() // TASK_BLOCKS))).persist()
    try:
        sums, points = _searched(dealt, waves, folds, cost, max_iter, tolerance)
    finally:
        dealt.unpersist()
    return Fits(held, waves, points, sums[:, :2])


def _searched(
    held: DataFrame, waves: Waves, folds: int, cost: float, max_iter: int, tolerance: float
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``_moments``, and weights and intercept of each model."""
    size = len(waves.offsets)
    sums = _moments(held, waves, folds)
    if not sums[:, :2].sum():
        raise ValueError("no complete rows to fit an SVM on")
    without = np.array([-1, *(range(folds) if folds > 1 else ())])
    own = np.array([sums[[f != w for f in range(folds)]].sum(axis=0) for w in without])
    n = own[:, :2].sum(axis=1)
    mean = own[:, 2 : 2 + size] / np.maximum(n, 1)[:, None]
    spread = own[:, 2 + size :] - n[:, None] * mean**2
    deviation = np.sqrt(np.maximum(spread, 0.0) / np.maximum(n - 1, 1)[:, None])
    # A feature that does not change has no weight.
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    middle, penalty = mean * scale, 1.0 / (cost * np.maximum(n, 1))

    def plain(x: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """Weights and intercepts for features as they are."""
        shift = x[..., -1] - (x[..., :-1] * middle[at]).sum(axis=-1)
        return np.append(x[..., :-1] * scale[at], shift[..., None], axis=-1)

    searches = [descended(size + 1, max_iter, tolerance) if k else None for k in n]
    points = np.zeros((len(n), size + 1))
    asked = {i: next(s) for i, s in enumerate(searches) if s}
    while asked:
        tried = [(i, x) for i, some in asked.items() for x in some]
        at = np.array([i for i, _ in tried])
        found = _losses(held, waves, plain(np.array([x for _, x in tried]), at), without[at])
        answers: dict[int, list] = {i: [] for i in asked}
        for (i, x), row in zip(tried, found, strict=True):
            pull = x[:-1] * scale[i] ** 2 * penalty[i]
            slope = row[1:-1] * scale[i] - row[-1] * middle[i]
            value = row[0] / n[i] + 0.5 * float(pull @ x[:-1])
            answers[i].append((value, np.append(slope / n[i] + pull, row[-1] / n[i])))
        for i, some in answers.items():
            try:
                asked[i] = searches[i].send(some)
            except StopIteration as end:
                points[i] = plain(end.value, i)
                del asked[i]
    return sums, points
