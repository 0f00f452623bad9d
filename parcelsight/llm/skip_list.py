"""Fill-in-the-middle training texts: a document's lines, cut twice and put in another order.

The cuts are given in lines and are needed in code points. A document's lines form an indexable
skip list: every link carries the lines and the code points that it passes, upper lanes hold some
of the lower lane's nodes, and a search for a rank descends from the top lane, passing each link
that does not go beyond the rank. Both cuts take a number of steps that grows with the logarithm
of the lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.llm.common import Carried, grouped, mix, whole_text

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What the draws of a document depend on besides its id.
SALT = 7
#: A node of a lane is in the next one, too, once in as many.
FAN = 4


@dataclass(frozen=True)
class Lane:
    """Links from each node of a lane to its next one; the last goes to the end of the text."""

    #: Lines and code points that a link passes.
    units: list[int]
    chars: list[int]
    #: Place of each node in the lane below.
    down: list[int]


class SkipList:
    """Lines of a text by their lengths in code points; which nodes go up is drawn by place."""

    def __init__(self, lengths: np.ndarray):
        units, chars, down = np.ones(len(lengths), np.int64), lengths, np.arange(len(lengths))
        drawn = mix(np.arange(len(lengths), dtype=np.uint64), SALT)
        self.size = len(lengths)
        self.lanes: list[Lane] = []
        while len(units):
            self.lanes.append(Lane(units.tolist(), chars.tolist(), down.tolist()))
            if len(units) <= FAN:
                break
            up = drawn % np.uint64(FAN) == 0
            up[0] = True
            down = np.flatnonzero(up)
            if len(down) == len(up):
                break
            drawn = drawn[down] // np.uint64(FAN)
            units, chars = np.add.reduceat(units, down), np.add.reduceat(chars, down)

    def offset(self, rank: int) -> int:
        """Code points of the first ``rank`` lines (from 0 to all)."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        units = chars = node = 0
        for lane in reversed(self.lanes):
            while node < len(lane.units) and units + lane.units[node] <= rank:
                units += lane.units[node]
                chars += lane.chars[node]
                node += 1
            if units == rank:
                break
            node = lane.down[node]
        return chars


def line_lengths(text: str) -> np.ndarray:
    """Code points of each line, its line feed included; an empty text has no lines."""
    out = np.fromiter(map(len, text.split("\n")), np.int64)
    out[:-1] += 1
    return out if out[-1] else out[:-1]


def _draws(doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{SALT}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def arranged(
    text: str, doc_id: int | None, rate: int, suffix_first: int
) -> tuple[int, str, int | None, int | None, str]:
    """Lines, form, code points of prefix and middle, and the new text of one document."""
    lines = SkipList(line_lengths(text))
    first, second, chance, order = _draws(doc_id)
    if not text or chance % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return lines.size, "plain", None, None, text
    ranks = sorted((first % (lines.size + 1), second % (lines.size + 1)))
    a, b = map(lines.offset, ranks)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first:
        out = "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
        return lines.size, "spm", a, b - a, out
    out = "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return lines.size, "psm", a, b - a, out


def fill_in_middle(
    documents: DataFrame, rate: int = 100, suffix_first: int = 50, text: str = "text"
) -> DataFrame:
    """Documents (all columns) with ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars``
    and the new text in ``output``.

    ``rate`` in a hundred documents are cut, ``suffix_first`` in a hundred of them into suffix,
    prefix, middle (spm), the others into prefix, suffix, middle (psm); all draws depend on doc_id
    alone, so equal ids are cut at equal draws, and documents without doc_id share theirs. A text
    that holds a mark, an empty one and one not drawn stay as they are (plain, no lengths); a
    missing one counts as empty. Equal rows stay rows of their own, no documents give none, and
    columns of the names above are replaced.
    """
    own = Carried(documents)
    entered = own.enter(documents, _id=F.col("doc_id").cast("long"), _text=whole_text(text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in grouped(batch, "_text"):
                texts, ids = (part.column(c).to_pylist() for c in ("_text", "_id"))
                rows = [arranged(t, i, rate, suffix_first) for t, i in zip(texts, ids, strict=True)]
                out = {n: part.column(n) for n in own.names}
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                for name, kind, values in zip(_ADDED, kinds, zip(*rows, strict=True), strict=True):
                    out[f"_{name}"] = pa.array(values, kind)
                yield pa.record_batch(out)

    kinds = "_n long, _form string, _prefix_chars long, _middle_chars long, _output string"
    return own.leave(entered.mapInArrow(work, own.ddl + kinds), **{n: f"_{n}" for n in _ADDED})


_ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of: its parts lie between marks that the text lacks."""
    whole = F.col(output)

    def between(start: str, end: str | None = None) -> Column:
        after = F.locate(start, whole) + len(start)
        stop = F.locate(end, whole) if end else F.length(whole) + 1
        return F.substring(whole, after, stop - after)

    middle = between(MIDDLE)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(whole)


def digest(rows: DataFrame) -> DataFrame:
    """Sums of the outputs and of the texts rebuilt from them, in place of the texts."""
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
