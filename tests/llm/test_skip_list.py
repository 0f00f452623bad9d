import hashlib
import re

import numpy as np
import pytest
from helpers import clashing, empty_documents, odd_documents
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelsight.llm import skip_list as sl

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def expected(doc_id, text, rate=100, suffix_first=50):
    text = text or ""
    lines = LINE.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < suffix_first:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.text(alphabet="a\n\r é😀\x1c\x85", max_size=60))
def test_lines_are_the_pattern_s(text):
    assert sl.line_lengths(text).tolist() == [len(x) for x in LINE.findall(text)]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 5, 17, 1000])
def test_every_rank_has_its_offset(size):
    lengths = np.random.default_rng(size).integers(1, 50, size)
    lines = sl.SkipList(lengths)
    assert [lines.offset(r) for r in range(size + 1)] == [0, *np.cumsum(lengths).tolist()]
    for wrong in (-1, size + 1):
        with pytest.raises(IndexError):
            lines.offset(wrong)


def test_lanes_thin_out_and_searches_stay_short():
    class Watched(list):
        seen = 0

        def __getitem__(self, at):
            Watched.seen += 1
            return super().__getitem__(at)

    size = 100_000
    lines = sl.SkipList(np.ones(size, np.int64))
    assert 6 <= len(lines.lanes) <= 12
    assert all(sum(x.units) == sum(x.chars) == size for x in lines.lanes)
    lines.lanes = [sl.Lane(Watched(x.units), x.chars, x.down) for x in lines.lanes]
    steps = []
    for rank in range(1, size, 997):
        Watched.seen = 0
        assert lines.offset(rank) == rank
        steps.append(Watched.seen)
    assert np.mean(steps) < 100 and max(steps) < 400


def frame(spark):
    texts = ["".join(f"line {i} é\n" for i in range(n)) + "end" * (n % 2) for n in range(40)]
    texts += ["has <S> mark\nx", "<\nP><\n", "\n\n\n", "<P\n>\n<M\n"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("rate, first", [(100, 50), (60, 0), (0, 100), (100, 100)])
def test_equal_to_the_plain_way_and_back(spark, rate, first):
    documents = frame(spark)
    rows = sl.fill_in_middle(documents, rate, first).withColumn("again", sl.restored()).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text, rate, first)
        assert r.again == r.text


def test_digest_of_odd_documents_and_clashing_columns(spark):
    documents = odd_documents(spark)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    wanted = sorted(
        [
            (r.doc_id, *(found := expected(r.doc_id, r.text))[:4], sha(found[4]), sha(r.text or ""))
            for r in documents.collect()
        ],
        key=str,
    )
    clash = clashing(documents).withColumns({c: F.lit("y") for c in ("form", "n", "output", "_id")})
    for rows in (documents, clash):
        got = sl.fill_in_middle(rows)
        assert set(got.columns) == {*rows.columns, *sl._ADDED}
        assert sorted(map(tuple, sl.digest(got).collect()), key=str) == wanted


def test_empty_table(spark):
    assert sl.digest(sl.fill_in_middle(empty_documents(spark))).count() == 0
