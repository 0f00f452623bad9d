"""URL filters by a cascade of Bloom filters: exact for every key of the corpus, without a join.

A rule is a host and the start of a path; it is looked up as a key, host and path together. The
first level holds the listed keys. The second holds those other keys of the corpus that the
first one lets pass by mistake, the third those listed keys that the second one does, and so on
until no mistake is left: for every key of the corpus, the number of levels that it passes tells
whether it is listed. Filters are cut into segments of a fixed size by the key's hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.llm.common import mix
from parcelsight.llm.kneser_ney import _mapped, _store
from parcelsight.sources.scratch import scratch_path, staged

#: Bits of a filter for each key it holds, and bits set for a key.
BITS_PER_KEY, PROBES = 10, 7
#: Bits of a segment: the piece of a filter that one task builds.
SEGMENT = 1 << 20
#: Levels at most; each has about one key in 100 of those two levels before it.
LEVELS = 64

#: The rules of the query, as verdict, host and start of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it is missing or has no ``://``."""
    after = F.when(
        F.instr(url, "://") > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")
    ).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), F.regexp_extract(rest, r"^[^?#]*", 0)


def keys_of(host: str, path: str, lengths: list[int], depth: int) -> Column:
    """Every key that a rule fitting this host and path can have: the host and the domains above
    it, as far as they have no more labels than a rule's host has (``depth``), each with those
    starts of the path that have one of the rules' lengths."""
    labels = F.split(host, r"\.", -1)
    above = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - F.lit(depth - 1)), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.transform(
            F.array(*[F.lit(n) for n in lengths]) if lengths else F.expr("array(CAST(NULL AS INT))"),
            lambda n: F.when(F.length(path) >= n, F.left(F.col(path), n)),
        ),
        lambda s: s.isNotNull(),
    )
    return F.flatten(F.transform(above, lambda h: F.transform(starts, lambda s: key_of(h, s))))


def key_of(host: Column, path: Column) -> Column:
    """A host and the start of a path as one text; NUL, which no host holds, stands between."""
    return F.concat(host, F.lit("\0"), path)


def _hashes(key: Column) -> Column:
    """Two independent 64-bit hashes of a key."""
    return F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit("second"), key).alias("g"))


def _bits(
    h: np.ndarray, g: np.ndarray, level: int, segments: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each key and the places of its bits there, other ones at every level."""
    h, g = (mix(x.view(np.uint64), 2 * level + i) for i, x in enumerate((h, g)))
    segment = (h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
    steps = np.arange(PROBES, dtype=np.uint64)
    places = (h[:, None] + steps * (g | np.uint64(1))[:, None]) >> np.uint64(7)
    return segment.astype(np.int64), (places % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class Cascade:
    """Where the filters lie, the number of segments of each level, and a segment's bits."""

    folder: str
    segments: tuple[int, ...]
    size: int = SEGMENT


def _passes(
    folder: str, h: np.ndarray, g: np.ndarray, level: int, segments: int, size: int
) -> np.ndarray:
    """Which keys a level's filter lets pass."""
    out = np.zeros(len(h), bool)
    if not segments or not len(h):
        return out
    segment, places = _bits(h, g, level, segments, size)
    for at in np.unique(segment):
        mine = np.flatnonzero(segment == at)
        stored = _mapped(folder, f"{level}-{at}", "uint8")
        if len(stored):
            spots = places[mine]
            out[mine] = (stored[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).all(axis=1)
    return out


def listed(cascade: Cascade, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Whether keys are listed: they pass an odd number of levels before one stops them."""
    out = np.zeros(len(h), bool)
    left = np.arange(len(h))
    for level, parts in enumerate(cascade.segments):
        if not len(left):
            return out
        ok = _passes(cascade.folder, h[left], g[left], level, parts, cascade.size)
        out[left[~ok]] = level % 2 == 1
        left = left[ok]
    out[left] = len(cascade.segments) % 2 == 1
    return out


def _encode(keys: DataFrame, folder: str, level: int, per_key: int, size: int) -> int:
    """Store a level's filter; how many segments it has."""
    count = keys.count()
    if not count:
        return 0
    segments = -(-count * per_key // size)

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        h, g = frame["h"].to_numpy(np.int64), frame["g"].to_numpy(np.int64)
        segment, places = _bits(h, g, level, segments, size)
        bits = np.zeros(size, np.uint8)
        bits[places.ravel()] = 1
        _store(folder, f"{level}-{segment[0]}", np.packbits(bits, bitorder="little"))
        return pd.DataFrame({"segment": [int(segment[0])], "keys": [len(frame)]})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, g = (batch.column(c).to_numpy() for c in ("h", "g"))
            segment, _ = _bits(h, g, level, segments, size)
            yield pa.record_batch([*batch.columns, pa.array(segment)], ["h", "g", "segment"])

    dealt = keys.mapInArrow(number, "h long, g long, segment long")
    done = dealt.groupBy("segment").applyInPandas(work, "segment long, keys long")
    stored = {r.segment for r in staged(done, "segments").select("segment").collect()}
    for at in set(range(segments)) - stored:
        _store(folder, f"{level}-{at}", np.zeros(size // 8, np.uint8))
    return segments


def build(
    keys: DataFrame, universe: DataFrame, per_key: int = BITS_PER_KEY, size: int = SEGMENT
) -> Cascade:
    """The cascade of listed ``keys`` that is exact for every key of ``universe``.

    Both have a text column ``key``; missing keys are left out, repeated ones count once. Only
    keys that pass the first level go on: the others of the universe are dropped in the scan.
    An empty list gives no level: then no key is listed. Levels that end in an error are tried again only by
    a new call; two different keys with the same 128-bit hash cannot be told apart.
    """
    spark = keys.sparkSession
    folder = scratch_path(spark, "cascade")
    hashed = [
        rows.where("key IS NOT NULL").select(_hashes(F.col("key")).alias("_h")).select("_h.*")
        for rows in (keys, universe)
    ]
    inside = staged(hashed[0].distinct(), "listed")
    segments: list[int] = []
    outside = hashed[1]
    for level in range(LEVELS):
        held, others = (inside, outside) if level % 2 == 0 else (outside, inside)
        parts = _encode(held, folder, level, per_key, size)
        if not parts:
            break
        segments.append(parts)

        def passing(batches, level=level, parts=parts):
            for batch in batches:
                h, g = (batch.column(c).to_numpy() for c in ("h", "g"))
                yield batch.filter(pa.array(_passes(folder, h, g, level, parts, size)))

        passed = others.mapInArrow(passing, "h long, g long")
        if level == 0:
            passed = passed.distinct().join(inside, ["h", "g"], "left_anti")
        passed = staged(passed, "passed")
        if level % 2 == 0:
            outside = passed
        else:
            inside = passed
    else:
        raise RuntimeError("the cascade does not end: different keys have the same hashes")
    return Cascade(folder, tuple(segments), size)


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path start; missing if none fits) and ``verdict``.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``; incomplete rules are left
    out, of rules with the same key an allowing one stands. A rule fits its host and all
    subdomains, if the path starts with its own; the longest decides (of equally long ones, that
    with the longer host). A url without a fitting rule gets ``default``. A missing url, or one
    without ``://``, has an empty host and path. Domains with more labels than any rule's host are not
    looked up, so the work on a very long host grows with its length only. Columns of these names are replaced, all others
    stay. Keys are looked up in two cascades, one for the allowing rules and one for the blocking.
    """
    known = rules.where("verdict IN ('allow', 'block') AND host IS NOT NULL AND path IS NOT NULL")
    keyed = known.select(
        "verdict",
        "path",
        key_of(F.col("host"), F.col("path")).alias("key"),
        F.size(F.split("host", r"\.", -1)).alias("depth"),
    )
    depth = keyed.agg(F.max("depth")).first()[0] or 1
    # One number for each length of a rule's path: as many as the longest path at most.
    lengths = sorted(r.n for r in keyed.select(F.length("path").alias("n")).distinct().collect())
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in added]
    host, path = host_and_path(url)
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    rows = pages.select(whole.alias("_row"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_keys", F.array_distinct(keys_of("host", "path", lengths, depth)))
    universe = rows.select("host", "path").distinct()
    universe = universe.select(F.explode(keys_of("host", "path", lengths, depth)).alias("key"))
    allow, block = (
        build(keyed.where(F.col("verdict") == v).select("key"), universe) for v in ("allow", "block")
    )
    rows = rows.withColumn("_hashes", F.transform("_keys", _hashes))
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_hashes")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            h, g = (flat.field(n).to_numpy() for n in ("h", "g"))
            found = np.where(listed(allow, h, g), 1, np.where(listed(block, h, g), 2, 0))
            verdicts = pa.array(found.astype(np.int8))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.record_batch(
                [*batch.drop_columns(["_hashes"]).columns, pa.ListArray.from_arrays(offsets, verdicts)],
                [*[n for n in names if n != "_hashes"], "_found"],
            )

    fields = [f for f in rows.schema.fields if f.name != "_hashes"]
    schema = T.StructType([*fields, T.StructField("_found", T.ArrayType(T.ByteType()))])
    met = rows.mapInArrow(work, schema)
    hits = F.expr(
        "filter(arrays_zip(_keys, _found), x -> x._found > 0)"
    )
    longest = F.expr(
        "array_max(transform(_hits, x -> named_struct('n', length(x._keys),"
        " 'host', instr(x._keys, '\\0'), 'found', x._found, 'key', x._keys)))"
    )
    met = met.withColumn("_hits", hits).withColumn("_best", longest)
    return met.select(
        *[F.col("_row").getField(c).alias(c) for c in kept],
        "host",
        "path",
        F.translate("_best.key", "\0", "").alias("rule"),
        F.when(F.col("_best").isNull(), default)
        .otherwise(F.when(F.col("_best.found") == 1, "allow").otherwise("block"))
        .alias("verdict"),
    )


def fixed_rules(spark) -> DataFrame:
    """The rules of the query as a table."""
    return spark.createDataFrame(RULES, "verdict string, host string, path string")
