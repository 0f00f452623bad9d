"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, read as mapped files.

N-grams are counted as packed arrays: each task counts its texts, sorts and splits the counts
by a hash of the n-gram, and one task per shard adds them up and stores its n-grams' hashes in
order, with counts beside them. A level's shards send the next shorter n-grams what they need:
one for each different word in front, and how often each context goes on. Workers map the files
and look up the n-grams of their texts in hash order, so that pages are read in order, too.

The files lie in the folder of ``spark.checkpoint.dir``. If workers cannot open that folder as
a path (an object store, say), each fetches the files to its own disk once.
"""

from __future__ import annotations

import math
import os
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.llm.common import grouped, hashed_words, lower_bytes, mix, runs
from parcelsight.sources.scratch import scratch_path

#: Bytes of a word's hash, and hashes of what stands before a text's first word and after its
#: last one; that a word has one of them is as unlikely as one in 10^16.
WIDTH = 7
BEFORE, END = np.uint64(1), np.uint64(2)
#: Words of the longest n-grams of the query: two words of context, and a level between them and
#: the words alone.
ORDER = 3
#: Tokens that a task counts before it sends what it has.
HELD_TOKENS = 3_000_000
#: Level of compression of what is sent: more takes longer than it saves.
SQUEEZE = 3
#: Numbers of an n-gram: own count, occurrences as a context, and how many n-grams with it as
#: context were seen once, twice, more often; words also have the plain count of occurrences.
NUMBERS = ("count", "total", "once", "twice", "more", "plain")
#: Half a byte that says that a number is this or larger and kept elsewhere.
OFTEN = 15
#: Numbers of a word that may be larger than 32 bits hold.
_WIDE = ("count", "total", "plain")
_PARTIAL = "level int, shard int, size long, words binary, numbers binary"


def key_of(words: np.ndarray, bits: int = 0) -> np.ndarray:
    """One hash for each row of word hashes. Its first ``bits`` are, of three words or more, those of
    the words before the last one: n-grams of one context lie in one shard, which sends the context
    once. A shard holds no more of a context than different words follow it."""
    out, size = words[:, 0].copy(), words.shape[1]
    for at in range(1, size):
        context = mix(out, at)
        out = context + words[:, at]
    out = mix(out, size)
    if bits and size > 2:
        rest = np.uint64((1 << 64 - bits) - 1)
        out = context & ~rest | out & rest
    return out


def _added(words: np.ndarray, numbers: np.ndarray, bits: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows of words in the order of their hashes, the hashes, and summed numbers."""
    keys = key_of(words, bits)
    order = np.argsort(keys, kind="stable")
    first = runs(keys[order])
    sums = np.add.reduceat(numbers[order], first, axis=0) if len(first) else numbers
    return words[order[first]], keys[order[first]], sums


def _counts(words: np.ndarray, bits: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows of words in the order of their hashes, the hashes, and how often they come."""
    keys = key_of(words, bits)
    order = np.argsort(keys)
    keys = keys[order]
    first = runs(keys)
    return words[order[first]], keys[first], np.diff(np.append(first, len(keys)))[:, None]


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each row of numbers, byte by byte, which compress well."""
    bytes_ = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(len(values), -1, 8)
    return np.ascontiguousarray(bytes_[:, :, :width].transpose(0, 2, 1)).tobytes()


def _of_planes(raw: np.ndarray, rows: int, width: int) -> np.ndarray:
    size = len(raw) // (rows * width)
    whole = np.zeros((rows, size, 8), np.uint8)
    whole[:, :, :width] = raw.reshape(rows, width, size).transpose(0, 2, 1)
    return whole.view(np.uint64)[:, :, 0]


def _squeezed(raw: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", SQUEEZE).compress(raw, asbytes=True)


def _unsqueezed(held: bytes) -> bytes:
    size = int.from_bytes(held[:8], "little")
    return pa.Codec("zstd").decompress(held[8:], size, asbytes=True)


def _code_bits(different: int) -> int:
    return max(1, (different - 1).bit_length())


def _pack(words: np.ndarray, keys: np.ndarray, numbers: np.ndarray, level: int, bits: int):
    """One row of _PARTIAL for each shard: its different words once, as steps from one to the next,
    then the n-grams' words by their places among these, column by column."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), int)
    edges = np.searchsorted(shard, np.arange((1 << bits) + 1))
    out: dict[str, list] = {k: [] for k in ("level", "shard", "size", "words", "numbers")}
    for at in range(1 << bits):
        a, b = edges[at], edges[at + 1]
        if a == b:
            continue
        known, codes = np.unique(words[a:b], return_inverse=True)
        codes = codes.reshape(b - a, level).astype(np.uint64)
        wide = _code_bits(len(known))
        if level * wide <= 64:
            whole = codes[:, 0]
            for column in codes.T[1:]:
                whole = whole << np.uint64(wide) | column
            order = np.argsort(whole)
        else:
            order = np.lexsort(codes.T[::-1])
        codes = codes[order].T
        codes[0] = np.diff(codes[0], prepend=np.uint64(0))
        head = np.array([len(known)], np.int64).tobytes()
        steps = np.diff(known, prepend=np.uint64(0))[None]
        out["level"].append(level)
        out["shard"].append(at)
        out["size"].append(b - a)
        out["words"].append(_squeezed(head + _planes(steps, WIDTH) + _planes(codes, -(-wide // 8))))
        counts = np.ascontiguousarray(numbers[a:b][order].T, np.int64)
        bytes_ = counts.view(np.uint8).reshape(len(counts), b - a, 8)
        out["numbers"].append(_squeezed(np.ascontiguousarray(bytes_.transpose(0, 2, 1)).tobytes()))
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def _unpack(level: int, size: int, words: bytes, numbers: bytes) -> tuple[np.ndarray, np.ndarray]:
    words, numbers = _unsqueezed(words), _unsqueezed(numbers)
    different = int(np.frombuffer(words, np.int64, 1)[0])
    raw = np.frombuffer(words, np.uint8, offset=8)
    known = np.cumsum(_of_planes(raw[: WIDTH * different], 1, WIDTH)[0], dtype=np.uint64)
    codes = _of_planes(raw[WIDTH * different :], level, -(-_code_bits(different) // 8)).astype(np.int64)
    codes[0] = np.cumsum(codes[0])
    mine = known[codes.T]
    bytes_ = np.frombuffer(numbers, np.uint8).reshape(-1, 8, size)
    return mine, np.ascontiguousarray(bytes_.transpose(0, 2, 1)).view(np.int64)[:, :, 0].T


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), urllib.parse.urlparse(folder).path
    return pafs.FileSystem.from_uri(folder)


def _store(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array under a name that appears when it is whole; a repeated task writes the same."""
    system, path = _opened(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(pa.py_buffer(np.ascontiguousarray(values)))
    system.move(part, f"{path}/{name}")


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A stored array, mapped into memory."""
    system, path = _opened(folder)
    full = f"{path}/{name}"
    if not isinstance(system, pafs.LocalFileSystem):
        own = os.path.join(tempfile.gettempdir(), "ngrams", os.path.basename(path))
        os.makedirs(own, exist_ok=True)
        full = os.path.join(own, name)
        if not os.path.exists(full):
            pafs.copy_files(f"{path}/{name}", full + f".{os.getpid()}", source_filesystem=system)
            os.replace(full + f".{os.getpid()}", full)
    if not os.path.getsize(full):
        return np.zeros(0, kind)
    return np.memmap(full, kind, mode="r")


@dataclass(frozen=True)
class Model:
    """Where a model lies, and its few numbers: totals and discounts."""

    folder: str
    order: int
    bits: int
    #: Discounts of n-grams counted once, twice, more often, by level from 1.
    discounts: tuple[tuple[float, float, float], ...]
    #: Sum of the words' own counts, and words with own count one, two, more.
    base: tuple[int, int, int, int]
    #: Training tokens, ends included, and different ones.
    tokens: int
    words: int

    def column(self, level: int, shard: int, name: str) -> np.ndarray:
        wide = name == "key" or name.endswith("oftener") or level == 1 and name in _WIDE
        small = level > 1 and name in NUMBERS
        kind = "uint8" if small else "uint64" if wide else "uint32"
        return _mapped(self.folder, f"{level}-{shard}-{name}", kind)

    def numbers(self, level: int, shard: int, name: str, at: np.ndarray) -> np.ndarray:
        """Stored numbers at some places of a shard."""
        if level == 1:
            return self.column(level, shard, name)[at].astype(np.int64)
        out = (self.column(level, shard, name)[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15).astype(np.int64)
        more = np.flatnonzero(out == OFTEN)
        if len(more):
            place = np.searchsorted(self.column(level, shard, f"{name}-often"), at[more])
            out[more] = self.column(level, shard, f"{name}-oftener")[place]
        return out

    def look_up(self, level: int, keys: np.ndarray, names: tuple[str, ...]) -> dict[str, np.ndarray]:
        """Numbers of n-grams by hash, 0 for those not seen. ``keys`` are sorted and different."""
        out = {n: np.zeros(len(keys), np.int64) for n in names}
        edges = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1)) if self.bits else [0, len(keys)]
        for shard in range(1 << self.bits):
            a, b = int(edges[shard]), int(edges[shard + 1])
            if a == b:
                continue
            stored = self.column(level, shard, "key")
            if not len(stored):
                continue
            at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
            known = stored[at] == keys[a:b]
            for name in names:
                out[name][a:b] = np.where(known, self.numbers(level, shard, name, at), 0)
        return out


def _windows(words: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Rows of ``order`` word hashes, one for each token; texts are cut at ``starts``."""
    out = np.empty((len(words), order), np.uint64)
    place = np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts))
    for back in range(order):
        shifted = np.concatenate((np.full(back, BEFORE), words[: len(words) - back]))[: len(words)]
        out[:, order - 1 - back] = np.where(place >= back, shifted, BEFORE)
    return out


def _token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens in a row, the end of each text included, and where texts start."""
    hashes, counts = hashed_words(lower_bytes(texts))
    ends = np.cumsum(counts)
    words = np.insert(hashes & np.uint64((1 << 8 * WIDTH) - 1), ends, END)
    return words, np.concatenate(([0], ends + np.arange(1, len(texts) + 1)))


def held_out(doc_id: str = "doc_id", modulus: int = 7, remainder: int = 2) -> Column:
    """Whether a document is not learned from: by the CRC-32 of its doc_id as text (if missing,
    of the empty text)."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % modulus == remainder


def _counted(texts: DataFrame, order: int, bits: int) -> DataFrame:
    """Counts of n-grams and words per task (_PARTIAL)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            if order > 1:
                grams = np.concatenate([_windows(w, s, order) for w, s in held])
                some = _counts(grams, bits)
                del grams
                yield _pack(*some, order, bits)
                del some
            some, keys, sums = _counts(np.concatenate([w for w, _ in held])[:, None], bits)
            numbers = np.zeros((len(some), len(NUMBERS)), np.int64)
            numbers[:, 5] = sums[:, 0]
            if order == 1:
                numbers[:, 0] = sums[:, 0]
            yield _pack(some, keys, numbers, 1, bits)

        count = 0
        for batch in batches:
            for rows in grouped(batch, "text"):
                found = _token_hashes(rows.column("text").to_pylist())
                held.append(found)
                count += len(found[0])
                if count >= HELD_TOKENS:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return texts.mapInArrow(work, _PARTIAL)


def _numbers(level: int, order: int) -> tuple[str, ...]:
    """The numbers that a level's n-grams are stored with: those of the longest are no context."""
    return NUMBERS if level == 1 else NUMBERS[:1] if level == order else NUMBERS[:5]


_FACTS = ("grams", "ones", "twos", "threes", "fours", "rest", "sum", "plain", "plain grams")


def _added_up(partials: DataFrame, level: int, order: int, bits: int, folder: str) -> DataFrame:
    """Add up and store a level's shards.

    Gives rows of _PARTIAL for the next lower level, and for each shard one row (shard -1) with
    the numbers _FACTS in ``words``. Rows of lower levels are added up as they are.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        here, shard = int(frame["level"].iloc[0]), int(frame["shard"].iloc[0])
        if shard < 0:
            return frame
        parts = [
            _unpack(here, int(n), w, c)
            for n, w, c in zip(frame["size"], frame["words"], frame["numbers"], strict=True)
        ]
        # Rows carry the numbers that they have something in; the others are 0.
        wide = len(_numbers(here, order))
        words = np.concatenate([w for w, _ in parts])
        numbers, at = np.zeros((len(words), wide), np.int64), 0
        for _, some in parts:
            numbers[at : at + len(some), : some.shape[1]] = some
            at += len(some)
        del parts
        words, keys, numbers = _added(words, numbers, bits)
        if here < level:
            return _pack(words, keys, numbers, here, bits).to_pandas()
        _store(folder, f"{level}-{shard}-key", keys)
        for name, column in zip(_numbers(level, order), numbers.T, strict=False):
            if level == 1:
                _store(folder, f"{level}-{shard}-{name}", column.astype(np.uint64 if name in _WIDE else np.uint32))
                continue
            # Most n-grams are rare: half a byte for each, and more for the others.
            small = np.minimum(np.append(column, np.zeros(len(column) % 2, np.int64)), OFTEN).astype(np.uint8)
            _store(folder, f"{level}-{shard}-{name}", small[::2] | small[1::2] << 4)
            often = np.flatnonzero(column >= OFTEN)
            _store(folder, f"{level}-{shard}-{name}-often", often.astype(np.uint32))
            _store(folder, f"{level}-{shard}-{name}-oftener", column[often].astype(np.uint64))
        count = numbers[:, 0]
        plain = numbers[:, 5] if wide > 5 else np.zeros(1, np.int64)
        facts = [
            int((count > 0).sum()),
            *(int((count == k).sum()) for k in (1, 2, 3, 4)),
            int((count > 4).sum()),
            int(count.sum()),
            int(plain.sum()),
            int((plain > 0).sum()),
        ]
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        fact = ([level], [-1], [0], [np.array(facts, np.int64).tobytes()], [b""])
        names = ["level", "shard", "size", "words", "numbers"]
        out = [pa.record_batch([pa.array(v, t) for v, t in zip(fact, types, strict=True)], names)]
        if level > 1:
            own = count > 0
            words, count = words[own], count[own]
            del keys, numbers, own
            # As a context: how often it goes on, and with how many words seen once, twice, ...
            context = np.zeros((len(words), 5), np.int64)
            context[:, 1] = count
            context[:, 2], context[:, 3], context[:, 4] = count == 1, count == 2, count > 2
            contexts, _, context = _added(words[:, :-1], context, bits)
            # Without the first word: one for each word in front; a text's start has none.
            suffix = np.where(words[:, 1] == BEFORE, count, 1) if level > 2 else np.ones_like(count)
            words, _, suffix = _added(words[:, 1:], suffix[:, None], bits)
            # Both in one block, which has one list of words then.
            context = np.concatenate((context, np.pad(suffix, ((0, 0), (0, 4)))))
            words = np.concatenate((contexts, words))
            out.append(_pack(*_added(words, context, bits), level - 1, bits))
        return pa.Table.from_batches(out).to_pandas()

    return partials.groupBy("level", "shard").applyInPandas(work, _PARTIAL)


def _discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Discounts of n-grams seen once, twice, more often; 0.5 where counts are too few to tell."""
    if not (ones and twos and threes):
        return (0.5, 0.5, 0.5)
    y = ones / (ones + 2 * twos)
    raw = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def train(documents: DataFrame, order: int = 2, text: str = "text") -> Model:
    """Count a model from whole texts.

    A missing or empty text has one token, its end. Without any document the model knows no
    word, and gives all its probability to unknown ones. Equal rows count as often as they come.
    Shards are as many as the session's shuffle partitions, as a power of two; the driver gets
    nine numbers for each shard and level. Nothing is written in between: a lost task's shard is
    counted and stored again, under the same names and with the same content.
    """
    spark = documents.sparkSession
    bits = math.ceil(math.log2(max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    folder = scratch_path(spark, "ngrams")
    rows = _counted(documents.select(F.col(text).alias("text")), order, bits)
    for level in range(order, 0, -1):
        rows = _added_up(rows, level, order, bits, folder)
    found = np.zeros((order + 1, len(_FACTS)), np.int64)
    for row in rows.where("shard = -1").select("level", "words").collect():
        found[row.level] += np.frombuffer(row.words, np.int64)
    _store_missing(folder, order, bits)
    one = found[1]
    return Model(
        folder,
        order,
        bits,
        tuple(_discounts(*(int(x) for x in found[k][1:5])) for k in range(1, order + 1)),
        (int(one[6]), int(one[1]), int(one[2]), int(one[3] + one[4] + one[5])),
        int(one[7]),
        int(one[8]),
    )


def _names(level: int, order: int) -> tuple[str, ...]:
    stored = _numbers(level, order)
    if level == 1:
        return ("key", *stored)
    return ("key", *(f"{n}{part}" for n in stored for part in ("", "-often", "-oftener")))


def _store_missing(folder: str, order: int, bits: int) -> None:
    """Empty files for shards that got no n-gram, so that readers need not ask."""
    system, path = _opened(folder)
    system.create_dir(path, recursive=True)
    there = {f.base_name for f in system.get_file_info(pafs.FileSelector(path))}
    for level in range(1, order + 1):
        for shard in range(1 << bits):
            for name in _names(level, order):
                if f"{level}-{shard}-{name}" not in there:
                    _store(folder, f"{level}-{shard}-{name}", np.zeros(0, np.uint64))


def _discount_of(count: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.choose(np.minimum(count, 3), (0.0, *discounts))


def token_scores(
    model: Model, words: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether it is known, its plain and its model log10 probability."""
    # A place before each text stands for the context of its first token.
    before = np.insert(words, starts[:-1], BEFORE)
    first = starts[:-1] + np.arange(len(starts) - 1)
    own = np.ones(len(before), bool)
    own[first] = False
    edges = starts + np.arange(len(starts))
    grams = _windows(before, edges, model.order)
    room = model.words + 1
    plain = None
    for level in range(1, model.order + 1):
        keys, inverse = np.unique(key_of(grams[:, model.order - level :], model.bits), return_inverse=True)
        names = ("count", "plain") if level == 1 else ("count",)
        if level < model.order:
            names += ("total", "once", "twice", "more")
        found = model.look_up(level, keys, names)
        discounts = model.discounts[level - 1]
        count = found["count"][inverse]
        rest = count - _discount_of(count, discounts)
        if level == 1:
            plain = found["plain"][inverse][own]
            total, *kinds = model.base
            left = sum(d * n for d, n in zip(discounts, kinds, strict=True))
            chance = (rest + left / room) / total if total else np.full(len(before), 1 / room)
        else:
            mixed = (rest + left * chance) / np.maximum(total, 1)
            chance = np.where(total > 0, mixed, chance)
        if level < model.order:
            # The context of a token is the n-gram that ends before it.
            total = np.roll(found["total"][inverse], 1)
            above = model.discounts[level]
            kinds = (np.roll(found[n][inverse], 1) for n in ("once", "twice", "more"))
            left = sum(d * n for d, n in zip(above, kinds, strict=True))
    base = np.log10((plain + 1) / (model.tokens + room))
    return plain > 0, base, np.log10(chance[own])


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` to doc_id.

    A missing or empty text has one token, its end. Rows are scored one by one: equal rows have
    equal scores, and a missing doc_id stays missing. ``score / n_tokens`` is the mean log10
    probability, and ten to the power of its negative the perplexity.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in grouped(batch, "text"):
                words, starts = _token_hashes(rows.column("text").to_pylist())
                known, base, chance = token_scores(model, words, starts)
                sums = [
                    np.add.reduceat(v, starts[:-1])
                    for v in (known.astype(np.int64), base, chance)
                ]
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id"),
                        "held_out": rows.column("held_out"),
                        "n_tokens": pa.array(np.diff(starts).astype(np.int64)),
                        "n_known": pa.array(sums[0]),
                        "train_tokens": pa.array(np.full(rows.num_rows, model.tokens, np.int64)),
                        "base_score": pa.array(sums[1]),
                        "score": pa.array(sums[2]),
                    }
                )

    rows = documents.select(
        F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInArrow(
        work,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )


def score_documents(documents: DataFrame, order: int = ORDER, text: str = "text") -> DataFrame:
    """Scores of all documents by a model of those that are not held out."""
    return score(documents, train(documents.where(~held_out()), order, text), text)
