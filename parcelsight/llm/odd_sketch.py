"""Near-duplicate documents by banded MinHash, odd sketches and exact sets.

Every document gets the MinHash samples of its shingle set, folded into a parity bitmap. Bands
of samples bring candidates together; the population count of two bitmaps' XOR estimates a
high similarity closely, and pairs that come near the threshold are confirmed on full sets.
Documents with equal sets are one node. Within a bucket, nodes are compared with its leader
first; only pairs that are not connected by then are compared with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.llm.common import grouped, hashed_words, lower_bytes, mix
from parcelsight.sources.scratch import discard, staged

#: Samples, and samples of a band. Two sets of similarity 0.8 share no band once in 10 million.
SAMPLES, ROWS = 200, 5
#: Bits of an odd sketch.
BITS = 1024
#: Least estimated similarity below the wanted one of pairs that are confirmed (five deviations).
MARGIN = 0.15
#: Samples and bits of the finer sketches that nodes get which are compared with all others in
#: their buckets, and the margin below the wanted similarity (five deviations again).
FINE_SAMPLES, FINE_BITS, FINE_MARGIN = 1000, 8192, 0.06
#: Parts that the links of a node are dealt into.
SALTS = 16
#: Documents of a bucket that are compared with each other at a time.
BLOCK = 1024
#: Rows of a staged table's file. Small tables are written by as many tasks as run at once, not by
#: one for each shuffle partition.
FILE_ROWS = 50_000

_DRAWN = np.random.default_rng(20240229)
_FACTORS = _DRAWN.integers(0, 1 << 31, FINE_SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _DRAWN.integers(0, 1 << 32, FINE_SAMPLES, dtype=np.uint32)
_SKETCHED = (
    "doc_id long, row binary, n_shingles long, node binary, bands array<long>, sketch binary"
)


def word_lists(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of each text's words; a missing text has none."""
    hashes, counts = hashed_words(lower_bytes(texts))
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(texts) else []


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; fewer words are one run, none no run."""
    if not len(words):
        return words
    width = min(width, len(words))
    runs = mix(words[: len(words) - width + 1], width)
    for at in range(1, width):
        runs = mix(runs + words[at : len(words) - width + 1 + at], at)
    return np.unique(runs)


def samples(found: np.ndarray, count: int = SAMPLES) -> np.ndarray:
    """MinHash samples of a set that is not empty."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        seen = _FACTORS[:count, None] * short[None, at : at + 512] + _SHIFTS[:count, None]
        np.minimum(least, seen.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One hash for each band of samples and its place."""
    rows = least.reshape(-1, ROWS).astype(np.uint64)
    out = np.arange(len(rows), dtype=np.uint64)
    for at in range(ROWS):
        out = mix(out + rows[:, at], at)
    return out.view(np.int64)


def sketch(least: np.ndarray, size: int = BITS) -> np.ndarray:
    """Parity bitmap of the samples: each flips one bit."""
    numbered = (np.arange(len(least), dtype=np.uint64) << np.uint64(32)) | least
    bits = np.bincount((mix(numbered, 7) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((bits & 1).astype(np.uint8))


def estimate(differing: np.ndarray, size: int = BITS, count: int = SAMPLES) -> np.ndarray:
    """Similarity estimated from the number of bits in which two sketches differ."""
    share = np.minimum(2 * differing / size, 0.999999)
    return 1 + size / 4 * np.log1p(-share) / count


def _node(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def sketched(
    documents: DataFrame, width: int, text: str = "text", row: Column | None = None
) -> DataFrame:
    """Per document: ``row`` (missing if not given), size of its set, its node (a digest of the
    set), bands and sketch; the last three are missing for an empty set and for a document without
    doc_id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in grouped(batch, "text"):
                sizes, nodes, keys, maps = [], [], [], []
                words = word_lists(rows.column("text").to_pylist())
                for doc, value in zip(rows.column("doc_id").to_pylist(), words, strict=True):
                    found = shingles(value, width)
                    sizes.append(len(found))
                    if doc is None or not len(found):
                        nodes.append(None)
                        keys.append(None)
                        maps.append(None)
                        continue
                    least = samples(found)
                    nodes.append(_node(found))
                    keys.append(bands(least))
                    maps.append(sketch(least).tobytes())
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id"),
                        "row": rows.column("row"),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "node": pa.array(nodes, pa.binary()),
                        "bands": pa.array(keys, pa.list_(pa.int64())),
                        "sketch": pa.array(maps, pa.binary()),
                    }
                )

    row = F.lit(None) if row is None else row
    picked = documents.select(
        F.col("doc_id").cast("long"), row.cast("binary").alias("row"), F.col(text).alias("text")
    )
    return picked.mapInArrow(work, _SKETCHED)


def full_sets(documents: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Node and full set (sorted 64-bit hashes) of every document that has words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in grouped(batch, "text"):
                found = [shingles(w, width) for w in word_lists(rows.column("text").to_pylist())]
                found = [f for f in found if len(f)]
                yield pa.record_batch(
                    {
                        "node": pa.array([_node(f) for f in found], pa.binary()),
                        "full": pa.array([f.tobytes() for f in found], pa.binary()),
                    }
                )

    return documents.select(F.col(text).alias("text")).mapInArrow(work, "node binary, full binary")


def fine_sketches(documents: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Node and fine sketch of every document that has words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in grouped(batch, "text"):
                found = [shingles(w, width) for w in word_lists(rows.column("text").to_pylist())]
                found = [f for f in found if len(f)]
                maps = [sketch(samples(f, FINE_SAMPLES), FINE_BITS).tobytes() for f in found]
                yield pa.record_batch(
                    {
                        "node": pa.array([_node(f) for f in found], pa.binary()),
                        "sketch": pa.array(maps, pa.binary()),
                    }
                )

    return documents.select(F.col(text).alias("text")).mapInArrow(work, "node binary, sketch binary")


def _close_sketches(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, sa, sb) whose sketches come near enough, with ``estimated``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, BITS // 64)
                for c in ("sa", "sb")
            ]
            guess = estimate(np.bitwise_count(both[0] ^ both[1]).sum(axis=1, dtype=np.int64))
            out = pa.record_batch(
                {"a": batch.column("a"), "b": batch.column("b"), "estimated": pa.array(guess)}
            )
            yield out.filter(pa.array(guess >= least))

    return pairs.mapInArrow(work, "a binary, b binary, estimated double")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have at least ``percent`` of their union in common."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("full").alias("fa"))
    two = sets.select(F.col("node").alias("b"), F.col("full").alias("fb"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select(
        "a", "b", "fa", "fb"
    ).mapInArrow(work, "a binary, b binary")


def _may_be(x: str, y: str, percent: int) -> Column:
    """Whether sets of two sizes can be similar enough."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _few(df: DataFrame, rows: int, size: int = FILE_ROWS) -> DataFrame:
    """In partitions of about ``size`` rows, if there are ``rows`` rows, and no fewer partitions than
    tasks run at once."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // size)))


def _stored(df: DataFrame, name: str, rows: int, size: int = FILE_ROWS) -> DataFrame:
    """Staged in files of about ``size`` rows, if there are ``rows`` rows."""
    return staged(_few(df, rows, size), name)


def _tops(links: DataFrame) -> DataFrame:
    """(node, root) of every node b of a forest: the top of its tree.

    A node is b in one link (a, b) at most, and no chain of links comes back to its start. Each
    step doubles the links that a node has gone up.
    """
    rows = links.count()
    pairs = _stored(links.select(F.col("b").alias("node"), F.col("a").alias("root")), "tops", rows)
    while True:
        above = pairs.select(F.col("node").alias("root"), F.col("root").alias("_above"))
        moved = pairs.select("node", "root").join(above, "root", "left").select(
            "node", F.coalesce("_above", "root").alias("root"), F.col("_above").isNotNull().alias("_moved")
        )
        before, pairs = pairs, _stored(moved, "tops", rows)
        discard(before)
        if pairs.where("_moved").isEmpty():
            return pairs.select("node", "root")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links (a, b): only the roots that they connect are worked on."""
    edges = _apart(links, roots, ("ra", "rb")).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    new = components(edges)
    moved = new.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("_new", "root").alias("root"))
    out = _stored(old.union(new), "roots", roots.count() + new.count())
    discard(roots, new)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node: the smallest node that its links lead to.

    Links (a, b) are turned into stars by alternately linking the larger and the smaller
    neighbours of every node to its smallest one. Every step is written to the shared folder, and
    the one before deleted. Links of a hot node are reduced and joined in parts, by a hash of the
    other node.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        """(u, v): v linked with the smallest of u's neighbours, u included, and of v too."""
        if larger:
            sides = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
                pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
            )
        else:
            sides = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        sides = sides.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
        parts = sides.groupBy("u", "s").agg(F.min("v").alias("m"))
        least = parts.groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"))
        met = sides.join(parts.select("u", "s").join(least, "u"), ["u", "s"])
        if larger:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    def tangled(pairs: DataFrame) -> bool:
        """Whether a node has two smaller neighbours, or a smaller and a larger one."""
        ends = pairs.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(pairs.select("b", F.lit(0), F.lit(1)))
        sides = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return not sides.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()

    pairs = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    rows = 2 * pairs.count()
    while True:
        before, pairs = pairs, _stored(star(star(pairs, True), False), "stars", rows)
        discard(before)
        if not tangled(pairs):
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _shared_buckets(nodes: DataFrame, most: int) -> DataFrame:
    """(key, node, size, met) of every band that two nodes or more share; ``met`` counts the other
    nodes in all buckets of a node: the text that others were copied from meets the most."""
    rows = nodes.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    repeated = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = _stored(rows.join(repeated, "key"), "buckets", most, 10 * FILE_ROWS)
    met = shared.groupBy("node").agg(F.sum(F.col("_n") - 1).alias("met"))
    rows = shared.count()
    out = _stored(shared.join(met, "node").select("key", "node", "size", "met"), "buckets", rows, 10 * FILE_ROWS)
    discard(shared)
    return out


def _with_leaders(buckets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Close pairs (a, b, estimated) of a bucket's leader and another node of it.

    The leader is the node that meets the most others in all its buckets. Copies are nearer to
    what they were copied from than to each other, so it is the text that connects them; and it
    leads nearly all buckets of its group, so there are a few pairs for each node.
    """
    ranked = F.struct((-F.col("met")).alias("rank"), "node", "size")
    leaders = buckets.groupBy("key").agg(F.min(ranked).alias("leader"))
    pairs = (
        buckets.join(leaders, "key")
        .select(F.col("leader.node").alias("a"), F.col("leader.size").alias("sa"), "node", "size")
        .where((F.col("a") != F.col("node")) & _may_be("sa", "size", percent))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )
    maps = nodes.select("node", "sketch")
    one = maps.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    two = maps.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return _close_sketches(pairs.join(one, "a").join(two, "b"), percent / 100 - MARGIN)


def _mixed_buckets(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of buckets whose nodes are not all connected: with ``root``, ``block``, the number of
    ``blocks``, and of those that meet all others (``open``). Nodes of the component that holds
    most of a bucket are in blocks of their own, which do not meet each other."""
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    held = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("_n"))
    most = F.max(F.struct("_n", "root"))
    mixed = (
        held.groupBy("key")
        .agg(F.sum("_n").alias("_n"), most.alias("_most"), F.count(F.lit(1)).alias("_roots"))
        .where("_roots > 1")
        .select(
            "key",
            F.col("_most.root").alias("_top"),
            F.expr(f"_n < {BLOCK}").alias("_small"),
            F.expr(f"CAST(1 + (_n - _most._n) div {BLOCK} AS INT)").alias("_out"),
            F.expr(f"CAST(1 + _most._n div {BLOCK} AS INT)").alias("_in"),
        )
    )
    dealt = "xxhash64(node, 1)"
    block = (
        f"CAST(CASE WHEN _small THEN 0 WHEN root = _top THEN _out + pmod({dealt}, _in)"
        f" ELSE pmod({dealt}, _out) END AS INT)"
    )
    return rooted.join(mixed, "key").select(
        "key", "node", "root", "size", F.expr(block).alias("block"),
        F.expr("IF(_small, 1, _out + _in)").alias("blocks"),
        F.expr("IF(_small, 1, _out)").alias("open"),
    )


def _across(rows: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """Close pairs (a, b) of nodes in mixed buckets that are not connected yet.

    Buckets are cut into blocks of about BLOCK nodes; open blocks are compared with themselves and
    with all others as arrays of fine sketches. Only close pairs become rows, each in the first
    of the bands that it shares.
    """
    least = percent / 100 - FINE_MARGIN
    blocks = (
        rows.join(fine, "node")
        .groupBy("key", "block", "blocks", "open")
        .agg(F.collect_list(F.struct("node", "root", "size", "bands", "sketch")).alias("held"))
    )
    alone = blocks.where("blocks = 1").select("key", "held", F.lit(None).cast(blocks.schema["held"].dataType).alias("facing"))
    many = blocks.where("blocks > 1")
    left = many.where("block < open").select(
        "key", F.explode(F.expr("sequence(block, blocks - 1)")).alias("other"), "held"
    )
    right = many.select("key", F.col("block").alias("other"), F.col("held").alias("facing"))

    def taken(block) -> tuple:
        held = block.values
        maps = np.frombuffer(b"".join(held.field("sketch").to_pylist()), np.uint64)
        names = {r: i for i, r in enumerate(dict.fromkeys(held.field("root").to_pylist()))}
        return (
            held.field("node").to_pylist(),
            held.field("root").to_pylist(),
            names,
            held.field("size").to_numpy(),
            maps.reshape(-1, FINE_BITS // 64),
            held.field("bands").flatten().to_numpy().reshape(len(held), -1),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = taken(batch.column("held")[row])
                key, facing = batch.column("key")[row].as_py(), batch.column("facing")[row]
                two = taken(facing) if facing.is_valid else one
                # Roots as numbers: equal ones on both sides, and -1 for one of this side only.
                there = np.array([two[2][r] for r in two[1]])
                found: tuple[list, list] = ([], [])
                for i, name in enumerate(one[0]):
                    small, large = np.minimum(two[3], one[3][i]), np.maximum(two[3], one[3][i])
                    able = 100 * small >= percent * large
                    able &= there != two[2].get(one[1][i], -1)
                    if two is one:
                        able[: i + 1] = False
                    at = np.flatnonzero(able)
                    apart = np.bitwise_count(two[4][at] ^ one[4][i]).sum(axis=1, dtype=np.int64)
                    at = at[estimate(apart, FINE_BITS, FINE_SAMPLES) >= least]
                    shared = two[5][at] == one[5][i]
                    at = at[one[5][i][shared.argmax(axis=1)] == key] if len(at) else at
                    for j in at.tolist():
                        x, y = sorted((name, two[0][j]))
                        found[0].append(x)
                        found[1].append(y)
                yield pa.record_batch(
                    {"a": pa.array(found[0], pa.binary()), "b": pa.array(found[1], pa.binary())}
                )

    met = left.join(right, ["key", "other"]).select("key", "held", "facing").unionByName(alone)
    return met.mapInArrow(work, "a binary, b binary").distinct()


def _apart(pairs: DataFrame, roots: DataFrame, more: tuple = ()) -> DataFrame:
    """Pairs (a, b) that are not connected, and columns ``more`` of their roots ra and rb."""
    one = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    two = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    met = pairs.select("a", "b").join(one, "a", "left").join(two, "b", "left")
    met = met.withColumns({"ra": F.coalesce("ra", "a"), "rb": F.coalesce("rb", "b")}).where("ra <> rb")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more)


def _linked(
    documents: DataFrame, width: int, percent: int, text: str, row: Column | None = None
) -> DataFrame:
    """Per document: doc_id, ``row``, ``n_shingles`` and ``root``, which all documents of a
    component have in common; it is missing for a document that takes part in no link."""
    rows = staged(sketched(documents, width, text, row), "sketches")
    most = rows.count()
    nodes = _stored(
        rows.where("node IS NOT NULL").dropDuplicates(["node"]).select("doc_id", "node", "n_shingles", "bands", "sketch"),
        "nodes",
        most,
    )
    buckets = _shared_buckets(nodes, most * SAMPLES // ROWS)
    held = buckets.count()
    close = _stored(_with_leaders(buckets, nodes, percent), "close", held)
    best = close.groupBy("b").agg(F.max_by("a", F.struct("estimated", "a")).alias("a")).select("a", "b")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """Documents that nodes stand for."""
        ids = nodes.join(wanted.distinct(), "node", "left_semi").select("doc_id").distinct()
        picked = documents.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
        return picked.join(ids, "doc_id", "left_semi")

    def confirmed(pairs: DataFrame, count: int) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        sets = _stored(full_sets(texts_of(ends), width).dropDuplicates(["node"]), "sets", min(most, 2 * count), 5_000)
        out = _stored(_confirmed(pairs, sets, percent), "confirmed", count, 5_000)
        discard(sets)
        return out

    # A leader meets more nodes than those that it leads, so these links are a forest.
    links = confirmed(best, min(most, close.count()))
    roots = _tops(links)
    discard(links)
    # Leaders' other pairs, then all other pairs: each time those only that are still apart.
    second = _stored(_apart(close.join(best, ["a", "b"], "left_anti"), roots), "apart", close.count())
    if not second.isEmpty():
        links = confirmed(second, second.count())
        roots = _merged(roots, links)
        discard(links)
    mixed = _stored(_mixed_buckets(buckets, roots), "mixed", held)
    discard(buckets, close, second)
    if not mixed.isEmpty():
        fine = fine_sketches(texts_of(mixed.select("node")), width).dropDuplicates(["node"])
        fine = fine.join(nodes.select("node", "bands"), "node")
        third = _stored(_across(mixed, fine, percent), "across", held)
        discard(mixed)
        if not third.isEmpty():
            links = confirmed(third, third.count())
            roots = _merged(roots, links)
            discard(links)
    discard(nodes)
    known = rows.select("doc_id", "row", "n_shingles", "node").join(roots, "node", "left")
    return known.select("doc_id", "row", "n_shingles", F.coalesce("root", "node").alias("root"))


def near_duplicates(
    documents: DataFrame, width: int = 5, percent: int = 80, text: str = "text"
) -> DataFrame:
    """Per document: doc_id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if at least ``percent`` of the union of their sets of ``width``-word
    shingles is in both; ``component_id`` is the smallest doc_id that links lead to. ``kept``
    tells whether it is the document's own. A document without words, or with a missing text,
    has an empty set and no link. One without doc_id has no link either: its ``component_id``
    is missing and it is kept. Rows that repeat a doc_id are judged one by one. Columns other
    than doc_id and the text are ignored.
    """
    known = _linked(documents, width, percent, text)
    heads = known.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("_least"))
    heads = _stored(heads, "heads", documents.count())
    return known.join(heads, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("_least", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("_least", "doc_id"))).alias("kept"),
    )


def without_near_duplicates(
    documents: DataFrame, width: int = 5, percent: int = 80, text: str = "text"
) -> DataFrame:
    """One row of each component: that of the smallest doc_id, and of its texts the one with the
    smallest digest.

    Rows are judged by doc_id and text, so another text under a repeated doc_id stays if it is in
    another component. Documents without doc_id all stay; so do those without words, but rows
    equal in doc_id and text stay once.
    """
    digest = F.unhex(F.sha2(text, 256))
    known = staged(_linked(documents, width, percent, text, digest).where("root IS NOT NULL"), "rows")
    rows = known.count()
    heads = _stored(known.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("_head")), "heads", rows)
    gone = (
        known.join(heads, "root")
        .where("doc_id <> _head.doc_id OR row <> _head.row")
        .select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"))
        .distinct()
    )
    apart = (F.col("doc_id") == F.col("_doc")) & (digest == F.col("_row"))
    left = documents.join(gone, apart, "left_anti").select(*documents.columns)
    named = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", text])
    return _few(named.unionByName(left.where("doc_id IS NULL")), rows, 5_000)
