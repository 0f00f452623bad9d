import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from parcelsight.llm import orc_tokens, packing, tokens

PATH = tokens.default_path()


@lru_cache
def one_library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


@pytest.fixture
def library():
    return one_library()


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


NASTY = [
    "", " ", "  ", "\n", " \n ", "a  b", "a   b", "a\n b", "a \nb", "x\x1c y!\x1cz", "don't 'stuff' 'll",
    "x²3 Ⅷ٣", "a b　c", "<|endoftext|> and <|endoftext|>x", "well-known, foo.bar 12ab34",
    "क्ष é \U0001f600\U0001f600 ok", "tab\tsep\r\nline\x85end", "A" * 300, "12 345,67%", "é" * 50,
]


def test_ids_are_those_of_whole_texts(library):
    texts = [*NASTY, *[t for _, t, *_ in odd_rows()], None, prose(500, 3)]
    fresh = tokens.Encoder(PATH)
    for _ in range(2):
        ids, starts = fresh.encode(texts)
        got = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        assert got == [whole(library, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x1c\x85  aBé́²Ⅷ03'!-_|<>中\U0001f600", max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    ids, starts = tokens.encoder(PATH).encode(texts)
    found = one_library()
    for text, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
        assert ids[a:b].tolist() == whole(found, text)


def test_kept_pieces_are_dropped_when_many(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 50)
    small = tokens.Encoder(PATH)
    for seed in range(4):
        ids, _ = small.encode([prose(60, seed)])
        assert ids.tolist() == whole(library, prose(60, seed))


def check_packed(rows, documents, library, capacity):
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in documents:
        ids = whole(library, text)
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc])
        copies = sum(d == doc for d, _ in documents)
        first = (len(ids) - 1) % capacity + 1
        sizes = [first] + [capacity] * ((len(ids) - first) // capacity)
        expected, at = [], 0
        for piece, size in enumerate(sizes):
            expected += [(piece, at, size, crc(ids[at : at + size]))] * copies
            at += size
        assert mine == expected
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, library):
    documents = odd_documents(spark)
    pairs = [(d, t) for d, t, *_ in odd_rows()]
    rows = packing.pack_documents(clashing(documents), capacity=64).collect()
    assert len(rows) == sum(-(-len(whole(library, t)) // 64) for _, t in pairs)
    check_packed(rows, pairs, library, 64)
    assert packing.pack_documents(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("block", [40, 1 << 17])
def test_bins_are_few_for_any_block(spark, block):
    drawn = np.random.default_rng(5)
    sizes = [int(x) for x in drawn.integers(1, 90, 2000)] + [100] * 20 + [51] * 30
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, length long").repartition(7)
    rows = packing.pack(items, capacity=100, block=block).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        assert sum(n for _, n in held) <= 100
        assert [o for o, _ in sorted(held)] == np.cumsum([0] + [n for _, n in sorted(held)])[:-1].tolist()
    assert len(bins) <= (1.1 if block == 40 else 1.01) * -(-sum(sizes) // 100)


def test_pieces_that_do_not_fit_are_an_error(spark):
    for size in (0, 101, None):
        items = spark.createDataFrame([(1, size)], "id long, length long")
        with pytest.raises(Exception, match="length must be"):
            packing.pack(items, capacity=100).collect()


def test_orc_round_trip(spark, library, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write_tokens(clashing(odd_documents(spark)), path)
    order = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    expected, at = [], 0
    for doc, text, *_ in order:
        ids = whole(library, text)
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r) for r in orc_tokens.summarize(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected
    stored = {r.doc_id: r.ids for r in orc_tokens.read_tokens(spark, path, [5, 9]).collect()}
    assert stored == {d: whole(library, t) for d, t, *_ in order if d in (5, 9)}


def test_orc_files_have_indexes_and_filters(spark, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write_tokens(odd_documents(spark), path)
    files = [f for f in os.listdir(path) if f.endswith(".orc")]
    reader = spark._jvm.org.apache.orc
    conf = spark._jsc.hadoopConfiguration()
    seen = 0
    for name in files:
        file = reader.OrcFile.createReader(
            spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name)), reader.OrcFile.readerOptions(conf)
        )
        seen += file.getNumberOfRows()
        if file.getNumberOfRows():
            streams = file.rows().readStripeFooter(file.getStripes().get(0)).getStreamsList()
            assert any("BLOOM" in s.getKind().toString() for s in streams)
            assert any("ROW_INDEX" in s.getKind().toString() for s in streams)
    assert seen == len(odd_rows())
    plan = orc_tokens.read_tokens(spark, path, [5])._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*doc_id", plan)


def test_orc_of_nothing(spark, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write_tokens(empty_documents(spark), path)
    assert orc_tokens.summarize(spark, path).collect() == []
