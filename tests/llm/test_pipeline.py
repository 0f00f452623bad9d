import re

import corpus_pipeline as pipeline
from tokenizers import Tokenizer

from helpers import odd_documents, prose
from parcelsight.llm import queries, secrets, tokens
from test_near_duplicates import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_over_the_given_table(spark):
    """Each stage's decisions, against brute force over its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [docs]
    for name, stage in pipeline.STAGES:
        held.append(pipeline.staged(stage(spark, held[-1], FOLDER), name))
    for out in held[1:-1]:
        assert out.columns == columns and out.count() > 0
    first, rated, alone, clean, mixed, packed = ({"rows": x.collect()} for x in held)
    left = {r.doc_id for r in rated["rows"]}
    assert all(not labels[i].toxic and labels[i].quality for i in left if i in labels)
    good = [i for i in labels if labels[i].quality and not labels[i].toxic]
    assert len(left & set(good)) >= 0.98 * len(good)
    expected = brute([(r.doc_id, r.text) for r in rated["rows"]], 5, 80)
    assert {r.doc_id for r in alone["rows"]} == {i for i, (_, _, kept) in expected.items() if kept}
    before = {r.doc_id: r for r in alone["rows"]}
    assert sorted(before) == sorted(r.doc_id for r in clean["rows"])
    for r in clean["rows"]:
        assert not re.search(secrets.ACCESS + "|" + secrets.HEX, r.text)
        assert (r.text == before[r.doc_id].text) == (secrets.REDACTED not in r.text)
        assert r.n_chars == len(r.text)
    assert {r.doc_id for r in mixed["rows"]} == set(before)
    library = Tokenizer.from_file(tokens.default_path())
    total = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed["rows"])
    assert sum(r.length for r in packed["rows"]) == total
    assert len({r.sequence_id for r in packed["rows"]}) <= -(-total // 2048) + 1


def test_stages_of_odd_rows_and_of_nothing(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for name, stage in pipeline.STAGES:
            out = pipeline.staged(stage(spark, docs, FOLDER), name)
            if name != "quality_classifier":
                docs = out
        assert out.columns[:4] == ["doc_id", "piece", "start", "length"]


def test_a_repeated_id_with_other_texts(spark):
    """Rows go, not ids: a text of its own stays, and one of two near copies under one id goes."""
    a, b, c = (prose(200, seed) for seed in (61, 62, 63))
    near = c + " and more"
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (5, b, "y"), (7, c, "x"), (7, near, "x"), (8, c, "x"), (None, a, "x"), (9, None, "x"), (9, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    left = sorted((r.doc_id or 0, r.text or "") for r in got)
    (seventh,) = [r.text for r in got if r.doc_id == 7]
    assert seventh in (c, near)
    assert left == sorted([(1, a), (5, b), (7, seventh), (0, a), (9, ""), (9, "")])


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and pipeline.ORACLE_SQL is None
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(names) and set(queries.ORACLES) <= set(entry.oracle_sql())
