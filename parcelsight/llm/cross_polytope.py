"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (signs drawn at random, then a fast Hadamard transform, three times) turns a
unit vector; its bucket in a table is the signed axis that it comes nearest to. A query looks
into the buckets of several axes of every table, nearest first. The members of a bucket are
scored exactly where they lie, in blocks, and only the nearest of each block are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.sources.scratch import staged

#: Tables, and buckets of each table that a query looks into. More find more, and cost more.
TABLES, PROBES = 8, 12
ROUNDS = 3
#: Vectors of a bucket that are scored at a time.
BLOCK = 4096
SEED = 20240229
#: Scores by matrix product may be off by this much before the exact ones are taken.
SLACK = 1e-9


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    out, width = rows.astype(float), rows.shape[1]
    half = 1
    while half < width:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2)
        out = out.reshape(len(rows), width)
        half *= 2
    return out / math.sqrt(width)


def rotated(rows: np.ndarray, table: int) -> np.ndarray:
    """Rows filled up with zeros to a power of two, and turned as one table says."""
    width = 1 << max(0, (rows.shape[1] - 1).bit_length())
    out = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    drawn = np.random.default_rng((SEED, table))
    for _ in range(ROUNDS):
        out = hadamard(out * drawn.choice((-1.0, 1.0), width))
    return out


def buckets(rows: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
    """Signed axes of each row (twice the axis, one more if negative), nearest first."""
    turned = rotated(rows, table)
    signed = np.stack((turned, -turned), 2).reshape(len(rows), -1)
    probes = min(probes, signed.shape[1])
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of rows that take part: no missing id, a vector that is there, has no missing
    and no infinite component and is not zero. Several rows of one id all take part."""
    whole = (
        f"`{key}` IS NOT NULL AND size(`{vector}`) > 0"
        f" AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x)"
        " AND abs(x) < double('infinity'))"
        f" AND exists(`{vector}`, x -> x <> 0)"
    )
    return vectors.where(whole).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0])
    return column.flatten().to_numpy().reshape(len(column), width)


def _hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """Each row once for every table and bucket that it belongs to or looks into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # Vectors of another width are never near: they are hashed among themselves.
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths):
                some = batch.filter(pa.array(widths == width))
                values = _matrix(some.column("vector"))
                values = values / np.linalg.norm(values, axis=1, keepdims=True)
                for table in range(tables):
                    found = buckets(values, table, probes)
                    row = pa.array(np.repeat(np.arange(len(values)), found.shape[1]))
                    yield pa.record_batch(
                        {
                            "width": some.column("width").take(row),
                            "table": pa.array(np.full(found.size, table, np.int32)),
                            "bucket": pa.array(found.ravel().astype(np.int32)),
                            "id": some.column("id").take(row),
                            "vector": some.column("vector").take(row),
                        }
                    )

    return rows.select("id", "vector", F.size("vector").alias("width")).mapInArrow(
        work, "width int, table int, bucket int, id long, vector array<double>"
    )


def cosines(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact measure, row by row: equal rows get equal values whatever stands beside them."""
    lengths = np.sqrt((others * others).sum(axis=1)) * math.sqrt((one * one).sum())
    return (others * one).sum(axis=1) / lengths


def search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    probes: int = PROBES,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank (from 1), vec_id and score (cosine).

    Candidates are all vectors but those with the query's own id; equal scores go to the smaller
    id. A query that finds fewer than ``k`` looks into four times as many buckets, again and again,
    in the end into all of one table: it has fewer rows only if there are fewer candidates. Rows with a missing id, or a vector
    that is missing, empty, zero or holds missing or non-finite components, take no part. Equal
    vectors all count. Vectors of different lengths never meet. Other columns are ignored.

    A bucket with many vectors is cut into blocks by a hash of the id, so that no task holds one
    as a whole, however often a vector is repeated.
    """
    place = ["width", "table", "bucket"]
    members = staged(_hashed(usable(vectors, key, vector), tables, 1), "members")
    sizes = members.groupBy(*place).agg(
        F.expr(f"CAST(1 + count(1) div {block} AS INT)").alias("blocks")
    )
    sizes = staged(sizes, "bucket-sizes")
    cut = members.join(sizes, place).select(
        *place, "id", "vector", F.expr("CAST(pmod(xxhash64(id), blocks) AS INT)").alias("block")
    )
    def work(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(asking) and len(there):
            ids = there["id"].to_numpy()
            mine = np.stack(there["vector"].to_numpy())
            unit = mine / np.linalg.norm(mine, axis=1, keepdims=True)
            for at in range(0, len(asking), 256):
                some = asking.iloc[at : at + 256]
                wanted = np.stack(some["vector"].to_numpy())
                near = (wanted / np.linalg.norm(wanted, axis=1, keepdims=True)) @ unit.T
                for query, values, row in zip(some["id"], wanted, near, strict=True):
                    row = np.where(ids == query, -9.0, row)
                    n = min(k, len(row))
                    least = np.partition(row, -n)[-n]
                    picked = np.flatnonzero((row >= least - SLACK) & (ids != query))
                    exact = cosines(values, mine[picked])
                    best = np.lexsort((ids[picked], -exact))[:k]
                    out["query_id"] += [query] * len(best)
                    out["vec_id"] += ids[picked][best].tolist()
                    out["score"] += exact[best].tolist()
        return pd.DataFrame(out)

    by = [*place, "block"]

    def nearest(some: DataFrame, tables: int, probes: int) -> DataFrame:
        """The best of each query's candidates: query_id and a sorted array."""
        asked = _hashed(some, tables, probes).join(sizes, place)
        asked = asked.select(
            *place, "id", "vector", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")
        )
        met = cut.where(F.col("table") < tables).groupBy(*by)
        found = asked.groupBy(*by).cogroup(met).applyInPandas(
            work, "query_id long, vec_id long, score double"
        )
        best = F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id")))
        return staged(found.groupBy("query_id").agg(F.slice(best, 1, k).alias("best")), "nearest")

    wanted = usable(queries, key, vector)
    best = nearest(wanted, tables, probes)
    width = members.agg(F.max("width")).first()[0] or 1
    axes = 2 << max(0, (width - 1).bit_length())
    while probes < axes:
        done = best.where(F.size("best") >= k)
        ids = done.select(F.col("query_id").alias("id"))
        short = staged(wanted.join(ids, "id", "left_anti"), "short")
        if short.isEmpty():
            break
        probes = min(4 * probes, axes)
        # All buckets of one table hold all vectors.
        best = done.union(nearest(short, 1 if probes == axes else tables, probes))
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.s")).alias("score"),
    )
