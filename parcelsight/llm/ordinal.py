"""Ordinal regression on graded ratings: hashed words, one weight vector, ordered thresholds.

The chance that a text's grade is above k is the logistic curve of its score less threshold k.
The score is a sum of shared weights over the text's features; thresholds rise with k. The model
is fitted on a bounded sample of labelled rows and applied to whole texts where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.llm.common import grouped, hashed_words, mix

#: Hash space of words; after it come the features of a text's shape.
BUCKETS = 1 << 18
SHAPES = 10
#: First bytes of a word that are a feature, too.
STEM = 5
#: A word gets a weight if it has so many rows, and if the chi-square statistic of its rows over the
#: grades is so large that among all such words few would reach it by chance: about ``BY_CHANCE``.
#: Words that come by chance only name the sample's rows.
LEAST_ROWS, BY_CHANCE = 2, 10
#: Labelled rows that a fit uses at most; those with the least hash of their doc_id are taken.
SAMPLE = 8_000
#: Rows whose features a fit computes at a time.
PART = 250
#: Grades: 0 toxic, 1 of low quality, 2 good.
GRADES = 3
#: Texts are selected whose chance of the highest grade is at least this.
LEAST_CHANCE = 0.3


_MARKS = b".,;:!?()[]{}\"'|"
_CAPITALS = bytes(range(65, 91))


def _ratio(part, whole) -> float:
    return part / whole if whole else 0.0


def _without(raw: bytes, some: bytes) -> int:
    """Bytes of a text that are in a set."""
    return len(raw) - len(raw.translate(None, some))


def shape(raw: bytes, words: np.ndarray, different: int) -> list[float]:
    """Shares between 0 and 1 that describe a text's form, the first one a constant."""
    n, size = len(words), len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = mix(mix(words[:-2], 1) + words[1:-1], 2) + words[2:] if n > 2 else words[:0]
    return [
        1.0,
        float(n == 0),
        1.0 - min(n, 100) / 100,
        _ratio(_without(raw, _CAPITALS), size),
        min(1.0, _ratio(_without(raw, b"#*$%&<>"), n)),
        min(1.0, _ratio(_without(raw, b"|"), n)),
        min(1.0, _ratio(_without(raw, b"!"), n)),
        1.0 - _ratio(len(set(lines)), len(lines)) if lines else 0.0,
        1.0 - _ratio(len(np.unique(triples)), len(triples)) if n > 2 else 0.0,
        _ratio(different, n),
    ]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: indexes and values in a row, and where each text starts.

    A word and its first letters count once however often they come, in lower case and without
    punctuation; a missing text is empty.
    """
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bare = [r.lower().translate(None, _MARKS) for r in raws]
    hashes, counts = hashed_words(bare)
    stems, _ = hashed_words(bare, first=STEM)
    stems = mix(stems, 1)
    index, value, sizes, at = [], [], [], 0
    for raw, count in zip(raws, counts.tolist(), strict=True):
        words = hashes[at : at + count]
        found = np.concatenate((words, stems[at : at + count])) % np.uint64(BUCKETS)
        found = np.unique(found).astype(np.int64)
        index += [found, BUCKETS + np.arange(SHAPES)]
        value += [np.ones(len(found)), np.array(shape(raw, words, len(found)))]
        sizes.append(len(found) + SHAPES)
        at += count
    starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return (
        np.concatenate(index) if index else np.zeros(0, np.int64),
        np.concatenate(value) if value else np.zeros(0),
        starts,
    )


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights and rising thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Chance of a grade above 0, 1, ... per text."""
        if len(starts) < 2:
            return np.zeros((0, len(self.thresholds)))
        total = np.add.reduceat(self.weights[index] * value, starts[:-1])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - total[:, None], -50, 50)))


def _telling(seen: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which features get a weight: the shape, and words that come with some grades more often.
    ``seen`` counts the rows with each feature by grade, ``rows`` all rows by grade."""
    total = seen.sum(axis=0)
    expected = rows[:, None] / rows.sum() * total
    chi = np.divide((seen - expected) ** 2, expected, where=expected > 0, out=np.zeros(seen.shape))
    out = total >= LEAST_ROWS
    # The chance of a statistic above x is exp(-x / 2) for three grades, and larger for more.
    out &= chi.sum(axis=0) >= 2 * np.log(max(1.0, np.count_nonzero(out) / BY_CHANCE))
    out[BUCKETS:] = True
    return out


def fit(
    texts: list[str | None], grades: np.ndarray, levels: int = GRADES, steps: int = 150,
    rate: float = 0.1, decay: float = 1e-4,
) -> OrdinalModel:
    """Fit weights and thresholds to texts; see ``fit_features``."""
    parts = []
    for at in range(0, len(texts), PART):
        index, value, starts = features(texts[at : at + PART])
        row = np.repeat(np.arange(at, at + len(starts) - 1, dtype=np.int32), np.diff(starts))
        parts.append((index.astype(np.int32), value.astype(np.float32), row))
    return fit_features(parts, grades, levels, steps, rate, decay)


def fit_features(
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], grades: np.ndarray,
    levels: int = GRADES, steps: int = 150, rate: float = 0.1, decay: float = 1e-4,
) -> OrdinalModel:
    """Fit weights and thresholds by adaptive gradient steps on the whole sample.

    Each part has features, their values and the rows they belong to. Rows count such that all
    grades weigh the same. Without rows every chance is that of the prior: weights 0 and
    thresholds at 0, 1, ... apart.
    """
    base = np.arange(levels - 1, dtype=float) - (levels - 2) / 2
    weights = np.zeros(BUCKETS + SHAPES)
    size = len(grades)
    if not size:
        return OrdinalModel(weights, base)
    seen = np.zeros((levels, BUCKETS + SHAPES))
    for index, _, row in parts:
        for k in range(levels):
            seen[k] += np.bincount(index[grades[row] == k], minlength=BUCKETS + SHAPES)
    telling = _telling(seen, np.bincount(grades, minlength=levels))
    parts = [[c[telling[p[0]]] for c in p] for p in parts]
    index, value, row = (np.concatenate(c) for c in zip(*parts, strict=True))
    used, slot = np.unique(index, return_inverse=True)
    counts = np.bincount(grades, minlength=levels)
    share = (1 / np.maximum(counts, 1))[grades] / np.count_nonzero(counts)
    # Thresholds: the first one, and the logarithms of the steps to the next ones.
    params = np.concatenate((np.zeros(len(used)), [base[0]], np.zeros(levels - 2)))
    first, second = np.zeros_like(params), np.zeros_like(params)
    n = len(used)
    for step in range(1, steps + 1):
        steps_up = np.exp(params[n + 1 :])
        cuts = params[n] + np.concatenate(([0.0], np.cumsum(steps_up)))
        total = np.bincount(row, params[slot] * value, minlength=size)
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - total[:, None], -50, 50)))
        edges = np.concatenate((np.ones((size, 1)), above, np.zeros((size, 1))), axis=1)
        at = np.arange(size)
        upper, lower = edges[at, grades], edges[at, grades + 1]
        chance = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper), lower * (1 - lower)
        by_total = -share * (up - down) / chance
        gradient = np.bincount(slot, by_total[row] * value, minlength=n) + decay * params[:n]
        by_cut = np.zeros(levels - 1)
        has_lower, has_upper = grades < levels - 1, grades > 0
        np.add.at(by_cut, grades[has_upper] - 1, (share * up / chance)[has_upper])
        np.add.at(by_cut, grades[has_lower], -(share * down / chance)[has_lower])
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate((gradient, tail[:1], tail[1:] * steps_up))
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params - rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    weights[used] = params[:n]
    cuts = params[n] + np.concatenate(([0.0], np.cumsum(np.exp(params[n + 1 :]))))
    return OrdinalModel(weights, cuts)


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grade of a labelled row: toxic 0, of low quality 1, good 2; missing without a quality."""
    return F.when(F.coalesce(toxic, F.lit(0)) == 1, 0).when(F.col(quality) == 0, 1).when(
        F.col(quality) == 1, 2
    )


def _labelled(documents: DataFrame, labels: DataFrame, limit: int, text: str) -> DataFrame:
    """Texts and grades of the ``limit`` labelled ids with the least hash, and what orders them."""
    graded = (
        labels.withColumn("_grade", grade())
        .where("doc_id IS NOT NULL AND _grade IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("_grade").alias("_grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    picked = documents.select(F.col("doc_id"), F.col(text).alias("_text"))
    return picked.join(F.broadcast(graded), "doc_id").select(
        F.xxhash64("doc_id").alias("_key"), F.xxhash64("_text").alias("_tie"), "_text", "_grade"
    )


def labelled_sample(
    documents: DataFrame, labels: DataFrame, limit: int = SAMPLE, text: str = "text"
) -> DataFrame:
    """``_text`` and ``_grade`` of at most ``limit`` labelled documents, those with the least hash.

    A document with several labels takes the lowest grade. Labels without doc_id or grade are
    left out; of rows that share a doc_id, all are taken, up to the limit.
    """
    rows = _labelled(documents, labels, limit, text)
    return rows.orderBy("_key", "_tie").limit(limit).select("_text", "_grade")


def _sparse(rows: DataFrame) -> DataFrame:
    """Features in place of ``_text``, computed where the texts lie: ``_words``, the hashed words
    (at most ``BUCKETS`` numbers, however long the text), and ``_shape``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in grouped(batch, "_text"):
                index, value, starts = features(some.column("_text").to_pylist())
                word = index < BUCKETS
                words = np.diff(starts) - SHAPES
                offsets = np.concatenate(([0], np.cumsum(words))).astype(np.int32)
                at = np.arange(some.num_rows + 1, dtype=np.int32) * SHAPES
                yield pa.record_batch(
                    {
                        "_key": some.column("_key"),
                        "_tie": some.column("_tie"),
                        "_grade": some.column("_grade"),
                        "_words": pa.ListArray.from_arrays(offsets, index[word].astype(np.int32)),
                        "_shape": pa.ListArray.from_arrays(at, value[~word].astype(np.float32)),
                    }
                )

    return rows.mapInArrow(
        work, "_key long, _tie long, _grade int, _words array<int>, _shape array<float>"
    )


def train(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE, text: str = "text") -> OrdinalModel:
    """The model of a bounded sample of labelled documents (``labelled_sample``).

    Texts become features in the tasks that read them; one task fits the sample's features.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, grades, at = [], [np.zeros(0, np.int64)], 0
        for batch in batches:
            rows = np.arange(at, at + batch.num_rows, dtype=np.int32)
            grades.append(batch.column("_grade").to_numpy().astype(np.int64))
            words = batch.column("_words")
            index = words.flatten().to_numpy()
            row = np.repeat(rows, np.diff(words.offsets.to_numpy()))
            parts.append((index, np.ones(len(index), np.float32), row))
            shapes = np.tile(np.arange(BUCKETS, BUCKETS + SHAPES, dtype=np.int32), len(rows))
            value = batch.column("_shape").flatten().to_numpy()
            parts.append((shapes, value, np.repeat(rows, SHAPES)))
            at += batch.num_rows
        model = fit_features(parts, np.concatenate(grades))
        used = np.flatnonzero(model.weights)
        columns = [[used], [model.weights[used]], [model.thresholds]]
        types = (pa.int64(), pa.float64(), pa.float64())
        yield pa.record_batch(
            [pa.array(c, pa.list_(t)) for c, t in zip(columns, types, strict=True)],
            ["used", "weights", "thresholds"],
        )

    rows = _sparse(_labelled(documents, labels, limit, text))
    sample = rows.orderBy("_key", "_tie").limit(limit).coalesce(1)
    found = sample.mapInArrow(
        work, "used array<long>, weights array<double>, thresholds array<double>"
    ).collect()
    if not found:
        return fit([], np.zeros(0, np.int64))
    weights = np.zeros(BUCKETS + SHAPES)
    weights[found[0]["used"]] = found[0]["weights"]
    return OrdinalModel(weights, np.array(found[0]["thresholds"]))


def rate(documents: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """Add ``expected_grade``, ``tail_probability`` (of the highest grade) and ``selected``.

    Whole texts are rated; a missing one is empty and never selected. Columns of these names are
    replaced, all others stay with whatever is missing in them. Equal texts have equal ratings.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    added = ("expected_grade", "tail_probability", "selected")
    kept = documents.drop(*added)
    names = kept.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = OrdinalModel(*shared.value)
        at = names.index(text)
        for batch in batches:
            for rows in grouped(batch, at):
                tails = held.tails(*features(rows.column(at).to_pylist()))
                some = np.array([bool(t) for t in rows.column(at).to_pylist()], bool)
                last = tails[:, -1] if len(tails) else np.zeros(0)
                yield pa.record_batch(
                    [
                        *rows.columns,
                        pa.array(tails.sum(axis=1)),
                        pa.array(last),
                        pa.array((last >= LEAST_CHANCE) & some),
                    ],
                    [*rows.schema.names, *added],
                )

    types = (T.DoubleType(), T.DoubleType(), T.BooleanType())
    rated = [T.StructField(n, t) for n, t in zip(added, types, strict=True)]
    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, *rated]))
