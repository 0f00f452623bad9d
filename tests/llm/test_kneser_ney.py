import math
import os
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from parcelsight.llm import common, queries
from parcelsight.llm import kneser_ney as kn

END, BEFORE = "</s>", "<s>"


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


class Brute:
    """The same model, from the formulas, in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.plain = Counter(t for x in texts for t in tokens(x))
        top = Counter()
        for x in texts:
            row = [BEFORE] * (order - 1) + tokens(x)
            top.update(tuple(row[i : i + order]) for i in range(len(row) - order + 1))
        self.counts = {order: top}
        for level in range(order - 1, 0, -1):
            here = Counter()
            for gram, n in self.counts[level + 1].items():
                here[gram[1:]] += n if gram[1] == BEFORE else 1
            self.counts[level] = here
        self.contexts = {k: defaultdict(lambda: [0, 0, 0, 0]) for k in self.counts}
        self.discounts = {}
        for level, grams in self.counts.items():
            seen = Counter(grams.values())
            self.discounts[level] = kn._discounts(*(seen[k] for k in (1, 2, 3, 4)))
            for gram, n in grams.items():
                held = self.contexts[level][gram[:-1]]
                held[0] += n
                held[min(n, 3)] += 1

    def chance(self, gram, level):
        if level == 0:
            return 1 / (len(self.plain) + 1)
        gram = gram[-level:]
        lower = self.chance(gram, level - 1)
        if gram[:-1] not in self.contexts[level]:
            return lower
        total, *kinds = self.contexts[level][gram[:-1]]
        n = self.counts[level].get(gram, 0)
        off = (0, *self.discounts[level])[min(n, 3)]
        left = sum(d * k for d, k in zip(self.discounts[level], kinds))
        return (n - off + left * lower) / total

    def score(self, text):
        row = [BEFORE] * (self.order - 1) + tokens(text)
        return sum(
            math.log10(self.chance(tuple(row[i : i + self.order]), self.order))
            for i in range(len(row) - self.order + 1)
        )

    def base(self, text):
        size, room = sum(self.plain.values()), len(self.plain) + 1
        return sum(math.log10((self.plain[t] + 1) / (size + room)) for t in tokens(text))


def corpus():
    drawn = random.Random(2)
    words = ["k1"]
    while len(words) < 4000:  # half of the words follow from the one before
        last = int(words[-1][1:])
        words.append(f"k{last % 97 + 2 if drawn.random() < 0.5 else int(drawn.paretovariate(0.8))}")
    return [(i, " ".join(words[i * 40 : i * 40 + 40])) for i in range(100)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_the_formulas(spark, order):
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {r.doc_id: r for r in kn.score_documents(documents, order).collect()}
    left = {i for i, _ in rows if crc32(str(i).encode()) % 7 == 2}
    model = Brute([t for i, t in rows if i not in left], order)
    for i, text in rows:
        r = out[i]
        assert r.held_out == (i in left)
        assert r.n_tokens == len(tokens(text)) and r.train_tokens == sum(model.plain.values())
        assert r.n_known == sum(model.plain[t] > 0 for t in tokens(text))
        assert r.base_score == pytest.approx(model.base(text), rel=1e-9)
        assert r.score == pytest.approx(model.score(text), rel=1e-9)
    if order == 2:
        better = sum(out[i].score for i in left), sum(out[i].base_score for i in left)
        assert better[0] > better[1]


def test_chances_add_up_to_one(spark):
    documents = spark.createDataFrame(corpus(), "doc_id long, text string")
    model = kn.train(documents, 2)
    words = sorted({w.encode() for _, t in corpus() for w in t.split()})
    hashes, _ = kn._token_hashes([w.decode() for w in [*words, b"never-seen"]])
    hashes = np.append(hashes[::2], kn.END)
    for context in (words[0], words[7], b"unknown-context"):
        first = kn._token_hashes([context.decode()])[0][0]
        row = np.array([[first, h] for h in hashes]).ravel()
        starts = np.arange(0, len(row) + 1, 2)
        found = kn.token_scores(model, row, starts)[2][1::2]
        assert (10.0**found).sum() == pytest.approx(1, abs=1e-9)


def test_partial_counts_are_packed_without_loss():
    drawn = np.random.default_rng(1)
    words = drawn.integers(0, 1 << 56, (500, 3), dtype=np.uint64)
    numbers = drawn.integers(0, 1000, (500, 6))
    some, keys, sums = kn._added(words, numbers)
    batch = kn._pack(some, keys, sums, 3, 4)
    back = [kn._unpack(3, *(batch.column(c)[i].as_py() for c in ("size", "words", "numbers"))) for i in range(batch.num_rows)]
    got = sorted((*w, *n) for ws, ns in back for w, n in zip(ws.tolist(), ns.tolist()))
    assert got == sorted((*w, *n) for w, n in zip(words.tolist(), numbers.tolist()))


def test_words_of_many_ngrams_are_sent_once():
    """Seven random bytes for each word of each n-gram took more disk than there was."""
    drawn = np.random.default_rng(2)
    known = drawn.integers(0, 1 << 56, 3000, dtype=np.uint64)
    words = known[drawn.integers(0, 3000, (60_000, 3))]
    some, keys, sums = kn._counts(words)
    batch = kn._pack(some, keys, sums, 3, 0)
    sent = batch.column("words")[0].as_py()
    assert len(sent) < 7 * len(some)
    back, numbers = kn._unpack(3, len(some), sent, batch.column("numbers")[0].as_py())
    got = sorted((*w, *n) for w, n in zip(back.tolist(), numbers.tolist()))
    assert got == sorted((*w, *n) for w, n in zip(some.tolist(), sums.tolist()))


def test_hashed_words_are_the_words(monkeypatch):
    texts = [t for _, t, *_ in odd_rows()] + ["x" * 100 + " y", "a\x1cb\x85c A", ""]
    raws = common.lower_bytes(texts)
    plain = [w for t in texts for w in common.byte_words(t)]
    for span in (common._SPAN, 16):
        monkeypatch.setattr(common, "_SPAN", span)
        hashes, counts = common.hashed_words(raws)
        assert counts.tolist() == [len(common.byte_words(t)) for t in texts]
        by_word = {}
        assert all(by_word.setdefault(w, h) == h for w, h in zip(plain, hashes.tolist()))
        assert len(set(by_word.values())) == len(by_word)
    assert common.hashed_words([])[0].tolist() == []


def test_odd_rows(spark):
    out = kn.score_documents(clashing(odd_documents(spark))).collect()
    assert len(out) == len(odd_rows())
    by = {r.doc_id: r for r in out}
    assert by[2].n_tokens == by[3].n_tokens == by[4].n_tokens == 1
    assert by[None].held_out == (crc32(b"") % 7 == 2)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert kn.score_documents(empty_documents(spark)).collect() == []
    alone = kn.score(odd_documents(spark), kn.train(empty_documents(spark))).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in alone)


def test_model_files_are_sorted_and_mapped(spark):
    documents = spark.createDataFrame([(i, prose(300, i)) for i in range(20)], "doc_id long, text string")
    model = kn.train(documents)
    files = [f for f in os.listdir(model.folder.removeprefix("file://")) if f.endswith("-key")]
    assert len(files) == 2 << model.bits
    for level in (1, 2):
        for shard in range(1 << model.bits):
            keys = model.column(level, shard, "key")
            assert (np.diff(keys.astype(object)) > 0).all()
            assert len(keys) == 0 or isinstance(keys, np.memmap)


def test_documents_are_scored_with_two_words_of_context(spark, tmp_path):
    """The query's own order; n-grams that come 255 times and more at every level included."""
    rows = [*corpus(), *[(i, "often comes back here " * 10) for i in range(100, 140)]]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    left = {i for i, _ in rows if crc32(str(i).encode()) % 7 == 2}
    model = Brute([t for i, t in rows if i not in left], 3)
    assert max(model.counts[3].values()) >= 255
    assert max(held[0] for held in model.contexts[3].values()) >= 255
    out = {r.doc_id: r.score for r in queries.QUERIES["op1_kneser_ney"](spark, str(tmp_path)).collect()}
    assert out == pytest.approx({i: model.score(t) for i, t in rows}, rel=1e-9)


def test_a_context_is_sent_once_and_a_number_takes_half_a_byte(spark):
    """Contexts of three words lie in one shard; before, each of their n-grams could send them anew."""
    drawn = np.random.default_rng(3)
    words = drawn.integers(2, 40, (4000, 3)).astype(np.uint64)
    some, keys, sums = kn._counts(words, 4)
    shard = keys >> np.uint64(60)
    own = kn.key_of(np.ascontiguousarray(some[:, :2]), 4) >> np.uint64(60)
    assert (shard == own).all() and len(set(shard.tolist())) == 16
    assert (np.diff(keys.astype(object)) > 0).all() and len(keys) == len({tuple(w) for w in words.tolist()})
    batch = kn._pack(some, keys, sums, 3, 4)
    assert len(b"".join(batch.column("numbers").to_pylist())) < len(some)
    many = [(i, "".join(f"w{(i * 7 + k * k) % 23} " for k in range(60)) + "so it was " * (i % 30)) for i in range(60)]
    model = kn.train(spark.createDataFrame(many, "doc_id long, text string"), 3)
    brute = Brute([t for _, t in many], 3)
    size = {kind: 0 for kind in ("key", "count")}
    for level in (2, 3):
        for at in range(1 << model.bits):
            for kind in size:
                size[kind] += model.column(level, at, kind).nbytes
    assert 16 * size["count"] <= size["key"] + 16 * 2 * (1 << model.bits)
    assert max(brute.counts[3].values()) > 15
    found = {r.doc_id: r.score for r in kn.score(spark.createDataFrame(many, "doc_id long, text string"), model).collect()}
    assert found == pytest.approx({i: brute.score(t) for i, t in many}, rel=1e-9)
