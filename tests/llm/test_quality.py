import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from parcelsight.llm import quality_ledger as ql


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def measured(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = ql.measure(rows).select("doc_id", *ql.MEASURES[:5]).collect()
    return [tuple(r)[1:] for r in sorted(got)]


def test_measures(spark):
    texts = [t for _, t, *_ in odd_rows()] + ["a b c a b c", "a a a a", "x\n\nx\r\nx\n y\n y", "#*$%&|<>", prose(3000, 4) + " " + prose(40, 4)]
    assert measured(spark, texts) == [brute(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n\t#é\x1c\U0001f600", max_size=40), min_size=1, max_size=30))
def test_measures_of_any_text(spark, texts):
    assert measured(spark, texts) == [brute(t) for t in texts]


def test_rows_and_columns_stay(spark):
    rows = clashing(odd_documents(spark))
    out = ql.ledger(rows)
    assert out.count() == len(odd_rows())
    assert {"doc_id", "text", "_text", "_words", "kept", "failed_bits"} <= set(out.columns)
    assert ql.ledger(empty_documents(spark)).collect() == []


def test_no_python_on_the_main_path(spark):
    plan = ql.ledger(odd_documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_policies_and_ablation(spark):
    bits = [0, 1, 2, 3, 4, 4, 8, 64, 65]
    rows = spark.createDataFrame([(b,) for b in bits], "failed_bits long")
    policies = {"one": 0b11, "two": 0b1100}
    kept = {p: rows.where(ql.passes(m)).count() for p, m in policies.items()}
    assert kept == {p: sum(b & m == 0 for b in bits) for p, m in policies.items()}
    for r in ql.ablation(rows, policies).collect():
        mask, bit = policies[r.policy], ql.BITS[r.rule]
        assert (r.failed, r.failed_alone, r.kept) == (
            sum(b & bit != 0 for b in bits), sum(b & mask == bit for b in bits), kept[r.policy],
        )
    empty = ql.ablation(rows.limit(0), policies).collect()
    assert {(r.failed, r.failed_alone, r.kept) for r in empty} == {(0, 0, 0)}
