"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on doc_id.

Files follow each other in ascending doc_id order. Stripes are read in parallel, and a search
for a few documents skips files, stripes and row groups by their statistics and filters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelsight.llm import tokens
from parcelsight.llm.common import grouped
from parcelsight.sources.scratch import staged

STORED = "doc_id long, part int, part_start long, ids array<int>"
#: Rows for each entry of the row index; a Bloom filter covers as many.
INDEX_ROWS = 1_000
STRIPE_BYTES = 16 << 20


def encode_sorted(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Rows to store (STORED), in ascending doc_id order over partitions and inside them.

    ``part`` counts the partitions, ``part_start`` the ids before the row in its partition.
    Documents without doc_id come first; rows of one doc_id are ordered by a hash of their
    text, so that many of them need not lie in one partition.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).encode
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in grouped(batch, "text"):
                ids, starts = encode(rows.column("text").to_pylist())
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id"),
                        "part": pa.array(np.full(rows.num_rows, part, np.int32)),
                        "part_start": pa.array(before + starts[:-1]),
                        "ids": pa.ListArray.from_arrays(
                            pa.array(starts.astype(np.int32)), pa.array(ids)
                        ),
                    }
                )
                before += len(ids)

    order = ["doc_id", F.xxhash64("text")]
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(work, STORED)


def write_tokens(documents: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode whole texts and write the files.

    A missing or empty text is stored as the end id alone; equal rows are stored as often as
    they come; no documents give a folder without rows. Other columns are not stored.
    """
    (
        encode_sorted(documents, tokenizer or tokens.default_path())
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.stripe.size", STRIPE_BYTES)
        .orc(path)
    )


def read_tokens(
    spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None
) -> DataFrame:
    """Stored rows, or those of a few documents by index and Bloom filter."""
    rows = spark.read.schema(STORED).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def summarize(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: ids before it in all files, its number of ids, and their checksum.

    The checksum is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    Only one total per file part is summed up in one place.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            starts = lists.offsets.to_numpy()
            raw = lists.values.to_numpy().astype("<u4", copy=False).view(np.uint8)
            crc = [
                zlib.crc32(raw[4 * a : 4 * b])
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
            ]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": batch.column("part"),
                    "part_start": batch.column("part_start"),
                    "n_tokens": pa.array(np.diff(starts).astype(np.int64)),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    schema = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"
    rows = staged(read_tokens(spark, path).mapInArrow(work, schema), "token_rows")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("_base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
