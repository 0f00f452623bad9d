"""Mixing documents to target weights of domains that a classifier sees in them.

A classifier learned from a labelled table gives each document the chances of its domains. A
document's expected tokens of a domain are its tokens times that chance, times its rate. Rates are
fitted by projected-gradient steps with momentum on the least squares of totals and targets:
they are never negative, and the totals come as near to the targets as they can. A step needs
one sum per domain.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.llm.common import grouped, hashed_words, lower_bytes
from parcelsight.sources.scratch import staged

BUCKETS = 1 << 15
#: Labelled rows that a fit uses at most.
SAMPLE = 6_000
#: Part of a word's mean share that is added to its share in each domain.
SMOOTHING = 0.05
#: Steps at most, and the relative error of the totals that ends them.
STEPS, TOLERANCE = 400, 1e-6
#: Steps after which rates are stored; between, they are computed from the steps taken since.
STORED = 40
#: Target weights of domains are their shares to this power, unless targets are given.
TEMPER = 0.7


@dataclass(frozen=True)
class DomainModel:
    """Domains and the log chances of hashed words in each of them."""

    domains: tuple[str, ...]
    prior: np.ndarray
    words: np.ndarray

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words of each text, and the chances of its domains."""
        counts, chances = [], []
        for found in _buckets(texts):
            counts.append(len(found))
            # The mean over words, scaled like a text of 50: long texts stay soft.
            total = self.words[:, found].sum(axis=1) * (50 / max(50, len(found))) + self.prior
            total = np.exp(total - total.max())
            chances.append(total / total.sum())
        shape = (len(texts), len(self.domains))
        return np.array(counts, np.int64), np.array(chances, float).reshape(shape)


def _buckets(texts: list[str | None]) -> list[np.ndarray]:
    hashes, counts = hashed_words(lower_bytes(texts))
    places = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    return np.split(places, np.cumsum(counts)[:-1]) if len(texts) else []


def train(labelled: DataFrame, limit: int = SAMPLE) -> DomainModel:
    """Learn domains from rows with ``text`` and ``domain``: at most ``limit`` of them, those with
    the least hash of their text.

    Rows with a missing domain are left out, a missing text has no words. Part of a word's mean
    share over the domains is added to its share in each, so that words which a domain was not
    seen with, or none was, count alike for domains with many rows and with few. Without rows
    there is one domain, named ``""``.
    """
    rows = labelled.where("domain IS NOT NULL").select(
        F.col("domain").cast("string").alias("domain"), "text"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            names, texts = (batch.column(c).to_pylist() for c in ("domain", "text"))
            for name, found in zip(names, _buckets(texts), strict=True):
                seen[name] = seen.get(name, 0) + 1
                held = counts.setdefault(name, np.zeros(BUCKETS, np.float32))
                np.add.at(held, found, 1)
        raw = [counts[k].tobytes() for k in counts]
        yield pa.record_batch(
            [
                pa.array([*counts], pa.string()),
                pa.array([seen[k] for k in counts], pa.int64()),
                pa.array(raw, pa.binary()),
            ],
            ["domain", "seen", "counts"],
        )

    sample = rows.orderBy(F.xxhash64("text"), "text", "domain").limit(limit).coalesce(1)
    # One row for each domain, from one task with a bounded sample.
    found = sorted(sample.mapInArrow(work, "domain string, seen long, counts binary").collect())
    if not found:
        return DomainModel(("",), np.zeros(1), np.zeros((1, BUCKETS)))
    counts = np.stack([np.frombuffer(r.counts, np.float32) for r in found]).astype(float)
    prior = np.array([float(r.seen) for r in found])
    prior = np.log((prior + 1) / (prior.sum() + len(found)))
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    words = np.log(shares + SMOOTHING * (shares.mean(axis=0) + 1e-9))
    return DomainModel(tuple(r.domain for r in found), prior, words)


def with_posteriors(documents: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` (long; words and one end) and ``posteriors`` (array of doubles).

    Other columns stay; columns of these names are replaced. A missing or empty text has one
    token and the domains' prior chances.
    """
    shared = documents.sparkSession.sparkContext.broadcast(
        (model.domains, model.prior, model.words.astype(np.float32))
    )
    added = ("n_tokens", "posteriors")
    kept = documents.drop(*added)
    place = kept.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = DomainModel(*shared.value)
        for batch in batches:
            for rows in grouped(batch, place):
                counts, chances = held.posteriors(rows.column(place).to_pylist())
                lists = pa.FixedSizeListArray.from_arrays(
                    pa.array(chances.ravel()), len(held.domains)
                ).cast(pa.list_(pa.float64()))
                yield pa.record_batch(
                    [*rows.columns, pa.array(counts + 1), lists], [*rows.schema.names, *added]
                )

    types = (T.LongType(), T.ArrayType(T.DoubleType()))
    fields = [T.StructField(n, t) for n, t in zip(added, types, strict=True)]
    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, *fields]))


def _moved(
    chances: np.ndarray, rates: np.ndarray, before: np.ndarray, momenta: np.ndarray, gradient: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rates after some steps, before the last of them, and where that one began. A step goes on by
    a part of the last move, then against the gradient, and is projected on rates that are not
    negative."""
    along, start = chances @ gradient.T, rates
    for at, part in enumerate(momenta):
        start = rates + part * (rates - before)
        rates, before = np.maximum(0.0, start - along[:, at]), rates
    return rates, before, start


def _chances(batch: pa.RecordBatch, domains: int) -> np.ndarray:
    return batch.column("posteriors").flatten().to_numpy().reshape(-1, domains)


def _at(batch: pa.RecordBatch, momenta: np.ndarray, gradient: np.ndarray):
    """Chances of a batch, and its rates as ``_moved`` gives them, from stored ones (or 1)."""
    chances = _chances(batch, gradient.shape[1])
    held = batch.schema.names
    one = np.ones(len(chances))
    rates, before = (
        batch.column(c).to_numpy() if c in held else one for c in ("_rate", "_before")
    )
    return chances, *_moved(chances, rates, before, momenta, gradient)


def _totals(
    rows: DataFrame, momenta: np.ndarray, gradient: np.ndarray
) -> tuple[np.ndarray, float]:
    """Expected tokens of every domain after the steps, and the sum of tokens times the squared move
    of the last step. One array per task is summed up."""
    domains = gradient.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(domains + 1)
        for batch in batches:
            chances, rates, _, start = _at(batch, momenta, gradient)
            weight = batch.column("n_tokens").to_numpy().astype(float)
            sums[:-1] += (weight * rates) @ chances
            sums[-1] += weight @ (rates - start) ** 2
        yield pa.record_batch({"place": pa.array(range(domains + 1)), "value": pa.array(sums)})

    parts = rows.mapInArrow(work, "place long, value double")
    sums = np.zeros(domains + 1)
    for row in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        sums[row.place] = row.value
    return sums[:-1], float(sums[-1])


def _stored(rows: DataFrame, momenta: np.ndarray, gradient: np.ndarray) -> DataFrame:
    """Rows with the rates after the steps, written to the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rates, before, _ = _at(batch, momenta, gradient)
            kept = [batch.column("n_tokens"), batch.column("posteriors")]
            yield pa.record_batch(
                [*kept, pa.array(rates), pa.array(before)],
                ["n_tokens", "posteriors", "_rate", "_before"],
            )

    types = "n_tokens long, posteriors array<double>, _rate double, _before double"
    return staged(rows.mapInArrow(work, types), "rates")


@dataclass(frozen=True)
class Mix:
    """Domains, targets and expected totals in tokens, whether the totals meet the targets within
    the tolerance, and the steps taken: one row of ``gradient`` (scaled, by domain) and the part of
    the move before that a step goes on by, for each."""

    domains: tuple[str, ...]
    targets: np.ndarray
    totals: np.ndarray
    momenta: np.ndarray
    gradient: np.ndarray
    met: bool


def tempered(totals: np.ndarray, power: float = TEMPER) -> np.ndarray:
    """Targets in tokens: shares to a power, scaled such that no domain gets less than it has."""
    some = totals > 0
    if not some.any():
        return totals
    weights = np.where(some, totals, 1.0) ** power * some
    return weights * np.max(np.divide(totals, weights, where=some, out=np.zeros_like(totals)))


def fit_rates(
    rows: DataFrame, model: DomainModel, weights: Mapping[str, float] | None = None,
    budget: float | None = None, steps: int = STEPS, tolerance: float = TOLERANCE,
) -> Mix:
    """Find rates for rows with ``n_tokens`` and ``posteriors``.

    ``weights`` are the domains' wanted shares of ``budget`` tokens (by default, of as many as
    there are); domains without one get 0. Without ``weights``, targets are ``tempered``.
    A step moves each rate against the gradient of the squared gaps of totals and targets, each over
    its domain's tokens, and projects it on those that are not negative. In that measure a step of
    length 1 is never too long, as a document's chances add up to 1; longer ones are taken as far as
    the curvature along the last move allows. Steps go on by a part of the move before; where the
    squares would rise, the step is taken again without it. All rates start at 1,
    and targets out of reach end at the nearest totals in the same measure. A step is one pass over
    chances, which sends one number for each domain and one more; every ``STORED`` steps rates are written.

    Rows with a missing ``posteriors`` or ``n_tokens`` take no part. An empty table has totals of 0
    and keeps the starting rates. Totals that do not meet the targets in the end are warned of, and
    ``met`` is false.
    """
    domains = len(model.domains)
    rows = rows.where("posteriors IS NOT NULL AND n_tokens IS NOT NULL").select(
        F.col("n_tokens").cast("long"), "posteriors"
    )
    momenta, gradient = np.zeros(0), np.zeros((0, domains))
    whole, _ = _totals(rows, momenta, gradient)
    totals = last = whole
    if weights is None:
        targets = tempered(totals)
    else:
        wanted = np.array([max(0.0, float(weights.get(d, 0.0))) for d in model.domains])
        targets = wanted / max(wanted.sum(), 1e-300) * (totals.sum() if budget is None else budget)
    scale = max(float(targets.sum()), 1.0)
    # A domain without tokens has a chance of 0 in every row: its gap moves no rate.
    tokens = np.where(whole > 0, whole, 1.0)

    def squares(found: np.ndarray) -> float:
        return float(((found - targets) ** 2 / tokens).sum())

    weight, length, stored = 1.0, 1.0, 0
    for _ in range(steps):
        if not whole.any() or np.abs(totals - targets).max() <= tolerance * scale:
            break
        heavier = (1 + math.sqrt(1 + 4 * weight * weight)) / 2
        part = (weight - 1) / heavier
        # Totals are linear in the rates, so those of the point the step starts at are known.
        start = totals + part * (totals - last)
        tried = np.append(momenta, part), np.vstack((gradient, length * (start - targets) / tokens))
        found, moved = _totals(rows, tried[0][stored:], tried[1][stored:])
        bent = float(((found - start) ** 2 / tokens).sum()) / max(moved, 1e-300)
        if length > 1 and length * bent > 1 + 1e-9:
            length = max(1.0, min(length / 2, 0.9 / bent))
            continue
        if squares(found) > squares(totals):
            if not part:
                break
            weight, last = 1.0, totals
            continue
        (momenta, gradient), last, totals, weight = tried, totals, found, heavier
        length = max(length, min(1.5 * length, 0.9 / max(bent, 1e-9)))
        if np.abs(totals - last).max() <= 1e-3 * tolerance * scale:
            break
        if len(momenta) - stored >= STORED:
            rows = _stored(rows, momenta[stored:], gradient[stored:])
            stored = len(momenta)
    off = float(np.abs(totals - targets).max(initial=0.0))
    met = not whole.any() or off <= tolerance * scale
    if not met:
        warnings.warn(
            f"rates miss their targets by up to {off:.6g} of {scale:.6g} tokens", stacklevel=2
        )
    return Mix(model.domains, targets, totals, momenta, gradient, met)


def with_rates(rows: DataFrame, mix: Mix) -> DataFrame:
    """Add ``rate`` to rows with ``posteriors``: what the steps of the fit make of the rate 1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = _chances(batch, len(mix.domains))
            one = np.ones(len(chances))
            rates, _, _ = _moved(chances, one, one, mix.momenta, mix.gradient)
            yield pa.record_batch(
                [*batch.columns, pa.array(rates)], [*batch.schema.names, "rate"]
            )

    kept = rows.drop("rate")
    schema = T.StructType([*kept.schema.fields, T.StructField("rate", T.DoubleType())])
    return kept.mapInArrow(work, schema)


def copies(rate: str = "rate", key: str = "doc_id", least: int = 0) -> F.Column:
    """Whole copies of a document: the rate, rounded up with the chance of its fraction, which is
    drawn from the document's own key, so that repeated runs agree; but never under ``least``."""
    drawn = F.pmod(F.xxhash64(F.lit("copies"), key), F.lit(1 << 30)) / (1 << 30)
    whole = F.floor(rate) + F.when(drawn < F.col(rate) - F.floor(rate), 1).otherwise(0)
    return F.greatest(whole, F.lit(least)).cast("int")


def labelled_rows(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """Texts and domains (their languages) of at most ``limit`` documents labelled as good."""
    picked = (
        labels.where("quality = 1 AND doc_id IS NOT NULL")
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    rows = documents.select("doc_id", "text", F.col("lang").alias("domain"))
    return rows.join(F.broadcast(picked), "doc_id", "left_semi").select("text", "domain")


def mixed(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DomainModel, Mix]:
    """doc_id, ``n_tokens``, ``posteriors`` and ``rate`` of documents, the model and the mix.

    Without labelled rows there is one domain, and every rate is 1. Equal rows have equal rates;
    a missing doc_id stays missing.
    """
    model = train(labelled_rows(documents, labels))
    rows = with_posteriors(documents.select("doc_id", "text"), model).drop("text")
    rows = staged(rows, "posteriors")
    mix = fit_rates(rows, model)
    return with_rates(rows, mix), model, mix
