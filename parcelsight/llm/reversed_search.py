"""Ranked lexical search the other way round: the items are indexed, the documents stream by.

The items' terms form an inverted index small enough to be sent to every task. A document's term
counts go through it, which scores the document for every item that shares a term with it at
once, and every task keeps the best few documents of each item. The tasks' lists are merged.

Items go in blocks of at most ``POSTINGS`` postings (one item's distinct terms, if it alone has
more); each block is a pass over all documents, so nothing that is broadcast grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelsight.llm.common import Carried, grouped, hashed_words, runs
from parcelsight.sources.scratch import staged

#: Documents kept for an item.
KEPT = 20
#: (item, term) pairs of a block of items: 24 bytes each in the tasks.
POSTINGS = 1 << 20
#: Bytes of items' texts that a task cuts into blocks.
ITEM_BYTES = 32 << 20
#: Scores, and single contributions to them, that a task holds at a time.
CELLS = 1 << 22
#: Saturation (1.2) and share of the length (0.25) of the score, in thousandths and hundredths.
SATURATION, LENGTH_SHARE = 12, 25

#: ASCII letters in lower case, digits and all bytes of other characters stay; the rest is blank.
_TERM_BYTES = bytes(
    b if chr(b).isascii() and chr(b).isalnum() or b >= 128 else 32 for b in bytes(range(256)).lower()
)

_ITEMS = "item long, block long, terms binary, repeats binary"
_COUNTED = "doc_id long, n long, terms binary, counts binary"


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of some texts in a row, and how many each text has.

    Terms are the longest runs of ASCII letters, ASCII digits and non-ASCII characters, with
    only A-Z in lower case. A missing text has none.
    """
    raws = [t.encode("utf-8", "surrogatepass").translate(_TERM_BYTES) if t else b"" for t in texts]
    return hashed_words(raws)


def _per_text(codes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Different (row, code) pairs in order, as rows, codes below ``width`` and how often each comes."""
    keys = np.sort(rows * width + codes)
    first = runs(keys)
    keys, counts = keys[first], np.diff(np.append(first, len(keys)))
    return keys // width, keys % width, counts


def _split(values: np.ndarray, rows: np.ndarray, size: int) -> list[bytes]:
    """Values of each of ``size`` rows, in order, as bytes."""
    edges = np.searchsorted(rows, np.arange(size + 1)) * values.itemsize
    raw = values.tobytes()
    return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def item_blocks(items: DataFrame, text: str = "text", block: int = POSTINGS) -> DataFrame:
    """Items with a number of their own, their block, and their distinct terms with repeats.

    Items without a term have no postings and are left out. Every task opens blocks of its own.
    """
    chars = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = items.coalesce(max(1, math.ceil(chars / ITEM_BYTES)))
    own = Carried(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        open_block, held = number, 0
        for batch in batches:
            for part in grouped(batch, "_text"):
                hashes, sizes = term_hashes(part.column("_text").to_pylist())
                terms, repeats, blocks = [], [], []
                ends = np.cumsum(sizes)
                for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                    different, counts = np.unique(hashes[a:b], return_counts=True)
                    if held and held + len(different) > block:
                        open_block, held = open_block + 1, 0
                    held += len(different)
                    terms.append(different.tobytes())
                    repeats.append(counts.astype(np.int64).tobytes())
                    blocks.append(open_block)
                out = {n: part.column(n) for n in own.names}
                out["item"] = pa.array(np.arange(number, number + len(blocks)))
                out |= {"block": pa.array(blocks, pa.int64())}
                out |= {"terms": pa.array(terms, pa.binary()), "repeats": pa.array(repeats, pa.binary())}
                number += len(blocks)
                yield pa.record_batch(out).filter(pa.array(sizes > 0))

    found = own.enter(rows, _text=F.col(text)).mapInArrow(work, own.ddl + _ITEMS)
    return own.leave(found, _item="item", _block="block", _terms="terms", _repeats="repeats")


@dataclass(frozen=True)
class Index:
    """Inverted index of one block of items: the items (places in ``items``) that hold a term."""

    items: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    holders: np.ndarray
    repeats: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each term in the index, -1 where no item has it."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def index_of(numbers: list[int], terms: list[bytes], repeats: list[bytes]) -> Index:
    """The index of items given by number, distinct terms and repeats."""
    lengths = [len(t) // 8 for t in terms]
    hashes = np.frombuffer(b"".join(terms), np.uint64)
    order = np.argsort(hashes, kind="stable")
    first = runs(hashes[order])
    return Index(
        np.array(numbers, np.int64),
        hashes[order][first],
        np.append(first, len(hashes)),
        np.repeat(np.arange(len(lengths)), lengths)[order],
        np.frombuffer(b"".join(repeats), np.int64)[order],
    )


def _counted(documents: DataFrame, index, text: str) -> DataFrame:
    """Every document's number of terms, and its counts of the terms of the index (_COUNTED)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            for part in grouped(batch, "text"):
                hashes, sizes = term_hashes(part.column("text").to_pylist())
                places = known.places(hashes)
                rows = np.repeat(np.arange(len(sizes)), sizes)[places >= 0]
                rows, terms, counts = _per_text(places[places >= 0], rows, len(known.terms))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(sizes.astype(np.int64)),
                        "terms": pa.array(_split(terms.astype(np.int32), rows, len(sizes)), pa.binary()),
                        "counts": pa.array(_split(counts.astype(np.int64), rows, len(sizes)), pa.binary()),
                    }
                )

    picked = documents.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    return picked.mapInArrow(work, _COUNTED)


@dataclass(frozen=True)
class Weights:
    """What the score needs of the whole corpus: documents with a term, all terms, and a weight
    for each term of the index."""

    documents: int
    length: int
    weight: np.ndarray


def corpus_weights(counted: DataFrame, terms: int) -> Weights:
    """Statistics of all documents, from their counts; each task sums its own first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms + 2, np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy()
            held[terms:] += np.count_nonzero(n), int(n.sum())
            found = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            held[:terms] += np.bincount(found, minlength=terms)
        some = np.flatnonzero(held)
        yield pa.record_batch({"term": pa.array(some), "n": pa.array(held[some])})

    sums = counted.select("n", "terms").mapInArrow(work, "term long, n long")
    found = sums.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(terms + 2, np.int64)
    totals[found.column("term").to_numpy()] = found.column("n").to_numpy()
    held, documents = totals[:terms].tolist(), int(totals[terms])
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in held]
    return Weights(documents, int(totals[-1]), np.array(weight, np.int64))


class _Heaps:
    """The best ``size`` documents of each item so far: higher scores first, then lower ids; a
    document without id comes after the others of its score."""

    def __init__(self, items: int, size: int):
        self.items, self.size = items, size
        self.least = np.ones(items, np.int64)
        self.held = tuple(np.zeros(0, np.int64) for _ in range(4))

    def push(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """Meet documents (rows) with their scores for all items (columns)."""
        least = self.least
        if len(scores) > self.size:
            place = len(scores) - self.size
            least = np.maximum(least, np.partition(scores, place, axis=0)[place])
        row, item = np.nonzero(scores >= least)
        if not len(row):
            return
        new = (item, scores[row, item], missing[row].astype(np.int64), ids[row])
        item, score, gone, doc = map(np.concatenate, zip(self.held, new, strict=True))
        order = np.lexsort((doc, gone, -score, item))
        item = item[order]
        first = runs(item)
        ranks = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        best = order[ranks < self.size]
        self.held = item[ranks < self.size], score[best], gone[best], doc[best]
        last = order[ranks == self.size - 1]
        self.least[item[ranks == self.size - 1]] = score[last]


def _scores(index: Index, weights: Weights, n, terms, counts, rows, size: int) -> np.ndarray:
    """Scores of ``size`` documents (rows) for all items (columns), from their counted terms."""
    length = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * weights.documents) // max(weights.length, 1)
    part = weights.weight[terms] * (
        (1_000_000_000 * counts) // (1000 * counts + SATURATION * length[rows])
    )
    held = index.starts[terms + 1] - index.starts[terms]
    ends = np.cumsum(held)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(index.starts[terms] - (ends - held), held) + np.arange(total)
    cell = np.repeat(rows * len(index.items), held) + index.holders[at]
    out = np.zeros(size * len(index.items), np.int64)
    np.add.at(out, cell, np.repeat(part, held) * index.repeats[at])
    return out.reshape(size, -1)


def _slices(cost: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows in a row that cost at most ``CELLS`` together, one row at least."""
    ends, start = np.cumsum(cost), 0
    while start < len(cost):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + CELLS, side="right")))
        yield start, stop
        start = stop


def _best_of_tasks(counted: DataFrame, index, weights, size: int) -> DataFrame:
    """The best documents of each item that each task has met (_item, _task, doc_id, score)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, corpus = index.value, weights.value
        heaps = _Heaps(len(known.items), size)
        for batch in batches:
            raw = batch.column("terms").to_pylist()
            terms = np.frombuffer(b"".join(raw), np.int32).astype(np.int64)
            counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int64)
            sizes = np.array([len(r) // 4 for r in raw], np.int64)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            held = np.concatenate(([0], np.cumsum(known.starts[terms + 1] - known.starts[terms])))
            n = batch.column("n").to_numpy()
            missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            cost = np.maximum(len(known.items), held[edges[1:]] - held[edges[:-1]])
            for a, b in _slices(cost):
                of = slice(edges[a], edges[b])
                rows = np.repeat(np.arange(b - a), sizes[a:b])
                scores = _scores(known, corpus, n[a:b], terms[of], counts[of], rows, b - a)
                heaps.push(scores, ids[a:b], missing[a:b])
        item, score, gone, doc = heaps.held
        yield pa.record_batch(
            {
                "_item": pa.array(known.items[item]),
                "_task": pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int64)),
                "doc_id": pa.array(doc, mask=gone > 0),
                "score": pa.array(score),
            }
        )

    return counted.mapInArrow(work, "_item long, _task long, doc_id long, score long")


def search(
    documents: DataFrame,
    items: DataFrame,
    size: int = KEPT,
    text: str = "text",
    block: int = POSTINGS,
) -> DataFrame:
    """Items (all their columns) with ``rank``, ``doc_id`` and ``score`` of the best documents.

    A document scores, for every term of the item, repeats included, the term's weight times its
    saturated count over the document's relative length, in whole numbers; only scores above 0
    count. Ranks are unique from 1: higher scores first, then lower doc_id, documents without
    doc_id last. Each row of either side counts for itself: equal documents all rank, equal items
    all have their list. Missing and empty texts have no term and are neither ranked nor counted;
    without items or documents there are no rows. The items' columns must not be named ``rank``,
    ``doc_id`` or ``score``; other columns of documents are ignored.
    """
    spark = documents.sparkSession
    stored = staged(item_blocks(items, text, block), "items")
    blocks = [r[0] for r in stored.select("_block").distinct().orderBy("_block").collect()]
    found = []
    for at in blocks:
        rows = stored.where(F.col("_block") == at).select("_item", "_terms", "_repeats").toArrow()
        known = index_of(*(rows.column(c).to_pylist() for c in ("_item", "_terms", "_repeats")))
        index = spark.sparkContext.broadcast(known)
        counted = staged(_counted(documents, index, text), "counted")
        weights = spark.sparkContext.broadcast(corpus_weights(counted, len(known.terms)))
        found.append(_best_of_tasks(counted, index, weights, size))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    columns = [F.col(f"`{c}`") for c in items.columns]
    if not found:
        none = stored.select(*columns, F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"))
        return none.withColumn("score", F.lit(0).cast("long")).limit(0)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    # Lists of a few dozen tasks first: one item's lists of all tasks would meet in one place.
    groups = Window.partitionBy("_item", F.shiftright("_task", 6)).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(groups)).where(F.col("rank") <= size)
    last = Window.partitionBy("_item").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= size)
    return best.join(stored.select("_item", *columns), "_item").select(
        *columns, "rank", "doc_id", "score"
    )
