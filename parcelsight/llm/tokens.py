"""Ids of a public byte-level tokenizer, with its answers for repeated pieces kept.

A byte-level vocabulary splits a text before every run of white space that follows something else,
and after every run of letters that a mark or a digit follows, whatever comes before or after.
Pieces cut there can be encoded one by one, so the library is asked once for each distinct piece
that a worker meets. Cutting, and looking up pieces by a hash of their bytes, work on arrays.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from parcelsight.llm.common import _BASE, _BYTE, mix, runs

#: Id that ends every document.
END_ID = 0
#: White space that is not ASCII, as the tokenizer's own splitting rule sees it: a text that holds
#: any is one piece, for no cut beside it is known to be right.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A piece that the tokenizer does not split; a blank before it is written as a letter of its own.
_PLAIN = re.compile(b" ?[A-Za-z]+")
_BLANK_LETTER = "Ġ"
#: Pieces met once only are dropped when this many are kept (32 bytes each, and their ids).
KEPT = 600_000
#: Entries of a table of places, less one, and which bits of the hash each of the tables goes by.
_MASK, _TURNS = np.uint64((1 << 21) - 1), (np.uint64(0), np.uint64(32))
#: Bytes that are cut and looked up at a time; longer texts are worked on whole.
SPAN = 1 << 20

_SPACES, _LETTERS, _BREAKS = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
#: ASCII marks and digits; an apostrophe may belong to the letters after it.
_BREAKS[33:127] = True
_BREAKS[39] = False
_BREAKS &= ~_LETTERS


def cuts(raw: np.ndarray) -> np.ndarray:
    """Where pieces begin in some bytes."""
    space, before = _SPACES[raw[1:]], raw[:-1]
    inside = (space & ~_SPACES[before]) | (_BREAKS[raw[1:]] & _LETTERS[before])
    return np.concatenate(([0], np.flatnonzero(inside) + 1))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


class Encoder:
    """Encodes texts; the same ids as encoding each whole text by the library."""

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._model = self._library.model
        # Known pieces by their hash, with a second hash to be sure, and where to look for them.
        self._tables = [np.zeros(_MASK + np.uint64(1), np.int32) for _ in _TURNS]
        self._keys, self._checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._starts, self._lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._uses, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and where each text starts.

        The starts have one more entry, the number of all ids. A missing text is empty:
        its only id is the end id.
        """
        raws = [t.encode("utf-8") if t else b"" for t in texts]
        found, sizes, at = [], [], 0
        while at < len(texts):
            held, stop = len(raws[at]), at + 1
            while stop < len(texts) and held + len(raws[stop]) <= SPAN:
                held, stop = held + len(raws[stop]), stop + 1
            ids, counts = self._some(texts[at:stop], raws[at:stop])
            found.append(ids)
            sizes.append(counts)
            at = stop
        counts = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        return ids, np.concatenate(([0], np.cumsum(counts)))

    def _some(self, texts: list[str | None], raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a few texts with their end ids, and how many each has."""
        whole = b"".join(raws)
        ends = np.cumsum([len(r) for r in raws], dtype=np.int64)
        if not whole:
            return np.full(len(raws), END_ID, np.int32), np.ones(len(raws), np.int64)
        raw = np.frombuffer(whole, np.uint8)
        begins = np.zeros(len(raw) + 1, bool)
        begins[cuts(raw)] = True
        begins[ends[:-1]] = True
        starts = np.flatnonzero(begins[:-1])
        for i, text in enumerate(texts):
            if text and not text.isascii() and _WIDE_SPACE.search(text):
                first = ends[i] - len(raws[i])
                starts = starts[(starts <= first) | (starts >= ends[i])]
        stops = np.append(starts[1:], len(raw))
        keys, checks = self._hashes(raw, starts, stops)
        slots = self._slots(keys, checks)
        if (slots < 0).any():
            self._learn(whole, starts, stops, keys, checks, slots)
        self._uses += np.bincount(slots, minlength=len(self._uses))
        lengths = self._lengths[slots]
        to = np.cumsum(lengths)
        ids = self._ids[np.repeat(self._starts[slots] - (to - lengths), lengths) + np.arange(to[-1])]
        before = np.concatenate(([0], to))
        stops_at = before[np.searchsorted(starts, ends)]
        ids = np.insert(ids, stops_at, END_ID)
        if len(self._keys) > KEPT:
            self._forget()
        return ids, np.diff(stops_at, prepend=0) + 1

    def _hashes(self, raw, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each piece, by sums over random values of its bytes."""
        power, inverse = _powers(max(SPAN, 1 << (len(raw) - 1).bit_length()))
        out = []
        for shift in (0, 1):
            # A second polynomial over other values: those of the bytes turned by a constant.
            values = _BYTE if not shift else mix(_BYTE, 3)
            sums = np.concatenate(([np.uint64(0)], np.cumsum(values[raw] * power[: len(raw)])))
            found = (sums[stops] - sums[starts]) * inverse[starts]
            out.append(mix(found + (stops - starts).astype(np.uint64), shift))
        return out[0], out[1]

    def _slots(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Place of each piece among the known ones, -1 for one that is new, or that both of its
        entries in the tables were taken from."""
        out = np.full(len(keys), -1)
        if not len(self._keys):
            return out
        for table, shift in zip(self._tables, _TURNS, strict=True):
            left = np.flatnonzero(out < 0)
            at = table[(keys[left] >> shift & _MASK).view(np.int64)]
            good = (self._keys[at] == keys[left]) & (self._checks[at] == checks[left])
            out[left[good]] = at[good]
        return out

    def _enter(self, first: int) -> None:
        """Put the pieces from a place on into the tables."""
        for table, shift in zip(self._tables, _TURNS, strict=True):
            table[(self._keys[first:] >> shift & _MASK).view(np.int64)] = np.arange(first, len(self._keys))

    def _learn(self, whole, starts, stops, keys, checks, slots) -> None:
        """Ask the library for the ids of new pieces, keep them, and fill in their places."""
        places = np.flatnonzero(slots < 0)
        order = places[np.argsort(keys[places], kind="stable")]
        heads = runs(keys[order])
        first, known = order[heads], len(self._keys)
        slots[order] = known + np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        pieces = [whole[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        found: list[list[int]] = [[] for _ in pieces]
        rest, tokenize = [], self._model.tokenize
        for i, piece in enumerate(pieces):
            if _PLAIN.fullmatch(piece):
                found[i] = [t.id for t in tokenize(piece.decode().replace(" ", _BLANK_LETTER))]
            else:
                rest.append(i)
        answers = self._library.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)
        for i, answer in zip(rest, answers, strict=True):
            found[i] = answer.ids
        counts = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        begins = len(self._ids) + np.cumsum(counts) - counts
        self._ids = np.concatenate((self._ids, ids))
        for name, more in (
            ("_keys", keys[first]), ("_checks", checks[first]), ("_starts", begins),
            ("_lengths", counts), ("_uses", np.zeros(len(first), np.int64)),
        ):
            setattr(self, name, np.concatenate((getattr(self, name), more)))
        self._enter(known)

    def _forget(self) -> None:
        """Keep the pieces met twice or more since the last time, if they are half or fewer."""
        again = self._uses > 1
        if np.count_nonzero(again) > KEPT // 2:
            again[:] = False
        lengths = self._lengths[again]
        to = np.cumsum(lengths)
        total = int(to[-1]) if len(to) else 0
        self._ids = self._ids[np.repeat(self._starts[again] - (to - lengths), lengths) + np.arange(total)]
        self._keys, self._checks = self._keys[again], self._checks[again]
        self._starts, self._lengths = to - lengths, lengths
        self._uses = np.ones(len(lengths), np.int64)
        for table in self._tables:
            table[:] = 0
        self._enter(0)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker; it stays for the worker's next tasks."""
    return Encoder(path)


def default_path() -> str:
    """Place of the byte-level vocabulary with 50,257 entries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
