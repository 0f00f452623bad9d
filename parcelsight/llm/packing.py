"""Best-fit packing of token pieces into sequences, by hierarchical merging of residuals.

Blocks of pieces are packed best-fit where they lie. Bins that are nearly full leave at
once; the others become items of the next round, in fewer tasks, until one block holds
all that is left or merging no longer helps. No task holds more than ``BLOCK`` items.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.llm import tokens
from parcelsight.llm.common import grouped
from parcelsight.sources.scratch import staged

CAPACITY = 2048
#: Items that one best-fit run holds.
BLOCK = 1 << 17
#: Tasks of a round that go into one of the next.
FAN_IN = 8
#: A round that merges a smaller share of its bins, in blocks that cannot get fewer, is the last.
LEAST_GAIN = 0.001

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text"
) -> DataFrame:
    """Token pieces of documents (PIECES).

    A document is its ids and the end id. One longer than ``capacity`` is cut into pieces of
    exactly that length; its first piece takes the remainder. A missing or empty text has one
    piece, the end id. Equal documents and equal ids give as many pieces as there are rows; a
    missing doc_id stays missing. Other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).encode
        for batch in batches:
            for part in grouped(batch, "text"):
                ids, starts = encode(part.column("text").to_pylist())
                raw = ids.astype("<u4").tobytes()
                sizes = np.diff(starts)
                first = (sizes - 1) % capacity + 1
                counts = (sizes - first) // capacity + 1
                row = np.repeat(np.arange(len(sizes)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                begin = 4 * (starts[row] + start)
                crc = [
                    zlib.crc32(raw[a:b])
                    for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)
                ]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(row)),
                        "piece": pa.array(piece.astype(np.int32)),
                        "start": pa.array(start),
                        "length": pa.array(length),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    picked = documents.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    return picked.mapInArrow(work, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin: longest items first, each into
    the open bin that it leaves the least room in. Lengths are from 1 to ``capacity``."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set while a bin with room r is open
    rooms: list[int] = []
    for at, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            held = by_room[room]
            chosen = held.pop()
            if not held:
                open_rooms ^= 1 << room
        else:
            room, chosen = capacity, len(rooms)
            rooms.append(capacity)
        bins[at], offsets[at] = chosen, capacity - room
        left = rooms[chosen] = room - size
        if left:
            if not by_room[left]:
                open_rooms |= 1 << left
            by_room[left].append(chosen)
    return bins, offsets, capacity - np.array(rooms, np.int64)


def _pack_blocks(items: DataFrame, size: str, capacity: int, turn: int, block: int) -> DataFrame:
    """Items with ``_bin``, ``_at`` and ``_fill`` (tokens of the bin), packed block by block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = (turn << 56) + (task << 32)
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bins, offsets, fill = best_fit(rows.column(size).to_numpy(), capacity)
            out = {n: rows.column(n) for n in rows.schema.names}
            out |= {
                "_bin": pa.array(bins + number),
                "_at": pa.array(offsets),
                "_fill": pa.array(fill[bins]),
            }
            number += len(fill)
            return pa.record_batch(out)

        count = 0
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, block - count)
                batch = batch.slice(some.num_rows)
                held.append(some)
                count += some.num_rows
                if count == block:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    added = [T.StructField(name, T.LongType()) for name in ("_bin", "_at", "_fill")]
    schema = T.StructType([*items.schema.fields, *added])
    return items.mapInArrow(work, schema)


def pack(
    items: DataFrame,
    size: str = "length",
    capacity: int = CAPACITY,
    slack: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items: no sequence is longer than ``capacity``, and
    its items lie one after the other from 0.

    ``size`` must lie from 1 to ``capacity`` and not be missing; anything else raises an error.
    Bins with at most ``slack`` (by default 1/128 of the capacity) left are not merged any
    further. Equal rows are items of their own. No items give no rows. The items' own columns
    must not be named ``sequence_id`` or ``offset``. Items are counted first: give a stored frame.
    """
    slack = capacity // 128 if slack is None else slack
    wrong = F.col(size).isNull() | ~F.col(size).between(1, capacity)
    checked = F.when(wrong, F.raise_error(F.lit(f"{size} must be from 1 to {capacity}")))
    items = items.withColumn(size, checked.otherwise(F.col(size)).cast("long"))
    # As few blocks as hold all items: every block leaves underfull bins of its own.
    items = items.coalesce(max(1, math.ceil(items.count() / block)))
    first = staged(_pack_blocks(items, size, capacity, 0, block), "packed")
    last, column, tasks, maps = first, "_bin", max(1, first.rdd.getNumPartitions()), []
    while True:
        heads = last.where((F.col("_at") == 0) & (F.col("_fill") < capacity - slack))
        left = heads.select(F.col(column).alias("_item"), F.col("_fill").alias("_size"))
        count = left.count()
        least = max(1, math.ceil(count / block))
        fewer = max(least, math.ceil(tasks / FAN_IN))
        if count < 2 or (tasks == 1 and maps):
            break
        spread = left.repartition(fewer, F.xxhash64(F.lit(len(maps)), "_item"))
        last = staged(_pack_blocks(spread, "_size", capacity, len(maps) + 1, block), "merged")
        bins = last.where("_at = 0").count()
        maps.append(last)
        if fewer == tasks and bins > (1 - LEAST_GAIN) * count:
            break
        tasks = fewer
    moved = None
    for merged in reversed(maps):
        here = merged.select(F.col("_item").alias("_from"), "_bin", "_at")
        if moved is not None:
            after = moved.select(
                F.col("_from").alias("_bin"), F.col("_bin").alias("_to"), F.col("_at").alias("_add")
            )
            here = here.join(after, "_bin", "left").select(
                "_from",
                F.coalesce("_to", "_bin").alias("_bin"),
                (F.col("_at") + F.coalesce("_add", F.lit(0))).alias("_at"),
            )
        moved = here
    if moved is None:
        return first.select(
            *items.columns, F.col("_bin").alias("sequence_id"), F.col("_at").alias("offset")
        )
    moved = moved.select(
        F.col("_from").alias("_bin"), F.col("_bin").alias("_to"), F.col("_at").alias("_add")
    )
    return first.join(moved, "_bin", "left").select(
        *items.columns,
        F.coalesce("_to", "_bin").alias("sequence_id"),
        (F.col("_at") + F.coalesce("_add", F.lit(0))).alias("offset"),
    )


def pack_documents(
    documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of documents (see ``cut``) with the sequence and the place each one goes to."""
    pieces = staged(cut(documents, tokenizer or tokens.default_path(), capacity), "pieces")
    return pack(pieces, "length", capacity)
