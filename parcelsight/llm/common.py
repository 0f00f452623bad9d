"""Words, hashes and stored arrays shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: blanks and the ASCII controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Texts are worked on in groups of this many characters, so that memory stays bounded.
GROUP_CHARS = 2_000_000


def byte_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; a missing text has none.

    Bytes split and change case by ASCII rules only, which is what the word rule says.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: A word's hash is a polynomial over random values of its bytes, modulo 2^64.
_DRAWN = np.random.default_rng(7).integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2)
_BYTE = _DRAWN[:256] + np.uint64(1)
_BASE = int(_DRAWN[256]) | 1
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that are hashed at a time.
_SPAN = 1 << 20


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def hashed_words(raws: list[bytes], first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in a row, and how many each text has.

    The same words as ``byte_words`` finds, from bytes that are in lower case already; of each
    word the ``first`` bytes only, if a number is given. The bytes are worked on as arrays, in
    spans that end between words.
    """
    whole = b" ".join(raws) + b" "
    limits = np.cumsum([len(r) + 1 for r in raws], dtype=np.int64)
    hashes, places, at = [], [], 0
    while at < len(whole):
        end = min(at + _SPAN, len(whole))
        while end < len(whole) and not _IS_BLANK[whole[end - 1]]:
            end += 1
        span = np.frombuffer(whole, np.uint8, end - at, at)
        power, inverse = _powers(max(_SPAN, 1 << (end - at - 1).bit_length()))
        blank = _IS_BLANK[span]
        before = np.concatenate(([True], blank[:-1]))
        starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[span] * power[: len(span)])))
        ends = ends if first is None else np.minimum(ends, starts + first)
        found = (sums[ends] - sums[starts]) * inverse[starts]
        hashes.append(mix(found + (ends - starts).astype(np.uint64)))
        places.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(raws), np.int64)
    edges = np.searchsorted(np.concatenate(places), limits)
    return np.concatenate(hashes), np.diff(edges, prepend=0)


def lower_bytes(texts: list[str | None]) -> list[bytes]:
    """Texts as bytes with A-Z in lower case; a missing one is empty."""
    return [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Well mixed 64-bit images of 64-bit values; one-to-one for a given salt."""
    x = values ^ np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def whole_text(column: str = "text") -> Column:
    """The text itself; a missing one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def grouped(
    batch: pa.RecordBatch, column: str = "text", size: int = GROUP_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, one row at least."""
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size)))
        yield batch.slice(start, stop - start)
        start = stop


def flat_list(parts: list[list]) -> list:
    return [*chain.from_iterable(parts)]


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin in a sorted array."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def table(spark, folder: str, name: str) -> DataFrame:
    """A given table of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Carried:
    """A frame's own columns on their way through Arrow, under names that nothing else uses."""

    def __init__(self, frame: DataFrame):
        self.columns = frame.columns
        self.names = [f"_carried{i}" for i in range(len(self.columns))]
        self.ddl = "".join(
            f"{n} {f.dataType.simpleString()}, "
            for n, f in zip(self.names, frame.schema.fields, strict=True)
        )

    def enter(self, frame: DataFrame, **more: Column) -> DataFrame:
        """The frame's columns under their new names, and some more columns."""
        own = [F.col(f"`{c}`").alias(n) for c, n in zip(self.columns, self.names, strict=True)]
        return frame.select(*own, *[c.alias(n) for n, c in more.items()])

    def leave(self, frame: DataFrame, **added: str) -> DataFrame:
        """The old names back, and added columns; these replace columns of their names."""
        taken = {n.lower() for n in added}
        own = [
            F.col(n).alias(c)
            for c, n in zip(self.columns, self.names, strict=True)
            if c.lower() not in taken
        ]
        return frame.select(*own, *[F.col(c).alias(n) for n, c in added.items()])
