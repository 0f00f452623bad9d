"""Languages of texts, by Bloom filters whose cells are bit masks of languages.

Tasks count the character n-grams of the learning documents by language. A language's filter holds
the n-grams that make up at least ``SHARE`` of all its own; so it holds at most 1 / SHARE of them,
however many documents there are. The filters of up to 64 languages lie bit by bit in the same
cells: the cells of an n-gram, and-ed, are the mask of all languages that may hold it. A text is in
the language that holds most of its n-grams, once the hits to be expected by mistake are taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.llm.common import Carried, grouped, mix, runs
from parcelsight.sources.scratch import staged

#: Characters of the n-grams, which are centred at every letter of a text (see ``grams``).
LENGTHS = (3, 5)
#: Bytes of text that are worked on at a time: their arrays stay in the processor's caches.
GROUP = 200_000
#: Least share of a language's n-grams (all lengths together) of one that its filter holds.
SHARE = 1e-5
#: Cells for each n-gram of the fullest language, and cells that an n-gram goes to.
CELLS, PROBES = 12, 4
#: Languages of a filter, and filters that a task holds at a time.
BITS, FILTERS = 64, 8
#: Counts that a task holds before it passes them on.
HELD = 1 << 22
#: Answer for a text without a letter.
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a document is not learned from; one without doc_id is."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % parts == part


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some texts in a row, and how many each text has.

    Texts are in lower case, with blanks for all that is not a letter and around the text. There
    is one n-gram of each length for each letter.
    """
    lowered = [t.lower() if t else "" for t in texts]
    gap = "  "
    whole = np.frombuffer((gap + gap.join(lowered) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _letters()[whole]
    at = np.flatnonzero(chars != 32)
    ends = np.cumsum([len(t) + len(gap) for t in lowered])
    sizes = np.diff(np.searchsorted(at, ends, side="left"), prepend=0)
    pairs = (chars[:-1] << np.uint64(21)) | chars[1:]
    three = (pairs[at - 1] << np.uint64(21)) | chars[at + 1]
    out = np.empty((len(at), 2), np.uint64)
    out[:, 0] = mix(three, 3)
    # The outer two characters besides the inner three.
    outer = (chars[at - 2] << np.uint64(21)) | chars[at + 2]
    out[:, 1] = mix(out[:, 0] + outer * np.uint64(0x9E3779B97F4A7C15), 5)
    return out.reshape(-1), sizes * len(LENGTHS)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point as itself if it is a letter, else as a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint64)


def _summed(grams_: np.ndarray, langs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((grams_, langs))
    grams_, langs, counts = grams_[order], langs[order], counts[order]
    if not len(grams_):
        return grams_, langs, counts
    first = np.flatnonzero(np.concatenate(([True], (np.diff(grams_) != 0) | (np.diff(langs) != 0))))
    return grams_[first], langs[first], np.add.reduceat(counts, first)


def gram_counts(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """How often documents of each language hold each n-gram (lang, gram, n)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        held, new, size = empty, [], 0

        def passed_on() -> pa.RecordBatch:
            names = pa.array(list(codes), pa.string())
            return pa.record_batch(
                {
                    "lang": names.take(pa.array(held[1])),
                    "gram": pa.array(held[0].view(np.int64)),
                    "n": pa.array(held[2]),
                }
            )

        for batch in batches:
            for part in grouped(batch, "text", GROUP):
                found, sizes = grams(part.column("text").to_pylist())
                of = [codes.setdefault(x, len(codes)) for x in part.column("lang").to_pylist()]
                langs = np.repeat(np.array(of, np.int64), sizes)
                for code in set(of):
                    mine = np.sort(found[langs == code])
                    first = runs(mine)
                    counts = np.diff(np.append(first, len(mine)))
                    new.append((mine[first], np.full(len(first), code), counts))
                    size += len(first)
                if size > HELD // 2:
                    held = _summed(*map(np.concatenate, zip(held, *new, strict=True)))
                    new, size = [], 0
                    if len(held[0]) > HELD:
                        yield passed_on()
                        held = empty
        held = _summed(*map(np.concatenate, zip(held, *new, strict=True)))
        yield passed_on()

    learned = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted = learned.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    parts = counted.mapInArrow(work, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _cells(grams_: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The cells of each n-gram, one array for each probe; ``size`` is a power of two."""
    at, step = grams_, (grams_ >> np.uint64(32)) | np.uint64(1)
    for probe in range(PROBES):
        at = at + step if probe else at
        yield (at & np.uint64(size - 1)).view(np.int64)


@dataclass(frozen=True)
class LanguageFilter:
    """The filters of at most 64 languages: cells of masks, and each language's share of full cells."""

    languages: tuple[str, ...]
    cells: np.ndarray

    def holders(self, grams_: np.ndarray) -> np.ndarray:
        """Mask of the languages that hold each n-gram, with few mistakes."""
        out = None
        for at in _cells(grams_, len(self.cells)):
            out = self.cells[at] if out is None else out & self.cells[at]
        return out

    def mistakes(self) -> np.ndarray:
        """Chance of each language to hold an n-gram by mistake."""
        full = [
            np.count_nonzero(self.cells >> self.cells.dtype.type(i) & self.cells.dtype.type(1))
            for i in range(len(self.languages))
        ]
        return (np.array(full) / len(self.cells)) ** PROBES

    def shares(self, grams_: np.ndarray, sizes: np.ndarray, mistakes: np.ndarray) -> np.ndarray:
        """Share of each text's n-grams that each language holds, less the expected mistakes."""
        masks = self.holders(grams_)
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        out = np.zeros((len(sizes), len(self.languages)))
        if not len(starts):
            return out
        one = masks.dtype.type(1)
        for i, chance in enumerate(mistakes.tolist()):
            hits = np.add.reduceat(masks >> masks.dtype.type(i) & one, starts, dtype=np.int64)
            out[some, i] = (hits / sizes[some] - chance) / max(1 - chance, 1e-9)
        return np.clip(out, 0.0, 1.0)


def build_filter(rows: pa.Table, languages: list[str], size: int) -> LanguageFilter:
    """The filter of some languages from their n-grams (lang, gram)."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= np.iinfo(k).bits)
    cells = np.zeros(size, kind)
    codes = {x: i for i, x in enumerate(languages)}
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    places = np.array([codes[x] for x in langs.dictionary.to_pylist()], np.int64)
    held = rows.column("gram").to_numpy().view(np.uint64)
    of = places[langs.indices.to_numpy()] if len(held) else np.zeros(0, np.int64)
    for i in range(len(languages)):
        for at in _cells(held[of == i], size):
            cells[at] |= kind(1 << i)
    return LanguageFilter(tuple(languages), cells)


@dataclass(frozen=True)
class Model:
    """Filters of all learned languages, and the language of most n-grams."""

    filters: tuple[LanguageFilter, ...]
    common: str | None


def learn(
    documents: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE
) -> Model:
    """The filters of all languages of some documents.

    All documents with a text and a language are counted, whole. A language whose documents have
    no letter is not learned; without documents nothing is.
    """
    counts = staged(gram_counts(documents, text, lang), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    telling = counts.join(totals, "lang").where(F.col("n") >= share * F.col("total"))
    telling = staged(telling.select("lang", "gram"), "telling-grams")
    numbers = telling.groupBy("lang").count().toArrow().to_pylist()
    known = sorted(totals.toArrow().to_pylist(), key=lambda r: (-r["total"], r["lang"]))
    if not known:
        return Model((), None)
    largest = max((r["count"] for r in numbers), default=1)
    size = 1 << (CELLS * largest - 1).bit_length()
    languages = sorted(r["lang"] for r in known)
    filters = []
    for at in range(0, len(languages), BITS):
        some = languages[at : at + BITS]
        rows = telling.where(F.col("lang").between(some[0], some[-1])).toArrow()
        filters.append(build_filter(rows, some, size))
    return Model(tuple(filters), known[0]["lang"])


def _pass(rows: DataFrame, own: Carried, filters: tuple[LanguageFilter, ...], common: str | None) -> DataFrame:
    """One look at the texts: the best language so far (_lang) and its share (_score)."""
    sent = rows.sparkSession.sparkContext.broadcast((filters, [f.mistakes() for f in filters]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mistakes = sent.value
        for batch in batches:
            for part in grouped(batch, "_text", GROUP):
                found, sizes = grams(part.column("_text").to_pylist())
                names, scores = part.column("_lang").to_pylist(), part.column("_score").to_numpy().copy()
                for i in np.flatnonzero(sizes).tolist():
                    names[i] = common if names[i] == UNKNOWN else names[i]
                for one, chances in zip(known, mistakes, strict=True):
                    shares = one.shares(found, sizes, chances)
                    best = shares.argmax(axis=1)
                    top = shares[np.arange(len(best)), best]
                    for i in np.flatnonzero(top > scores).tolist():
                        names[i] = one.languages[best[i]]
                    scores = np.maximum(top, scores)
                out = {n: part.column(n) for n in own.names}
                out |= {"_text": part.column("_text"), "_lang": pa.array(names, pa.string())}
                yield pa.record_batch(out | {"_score": pa.array(scores)})

    return rows.mapInArrow(work, own.ddl + "_text string, _lang string, _score double")


def predict(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents (all columns) with ``lang_pred`` and ``score``.

    The score is the share of the text's n-grams that the language holds, from 0 to 1. Equal
    shares go to the first name; a text whose letters no language holds gets the language of most
    n-grams, at score 0. Missing texts and texts without a letter are ``und`` at score 0, and so are
    all where no language was learned. Only the text is looked at: equal texts have equal answers.
    Columns of the two names are replaced.
    """
    own = Carried(documents)
    rows = own.enter(
        documents, _text=F.col(text), _lang=F.lit(UNKNOWN), _score=F.lit(0.0)
    )
    common = model.common or UNKNOWN
    for at in range(0, len(model.filters), FILTERS):
        rows = _pass(rows, own, model.filters[at : at + FILTERS], common)
    return own.leave(rows, lang_pred="_lang", score="_score")
