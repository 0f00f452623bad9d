"""Quality rules as a ledger: every rule is evaluated once, its outcome is one bit.

The ledger keeps the measurements and the failure bits of each row. Policies are versioned
bit masks that are applied to the ledger afterwards; ablations are sums over the bits. All of
it is column arithmetic inside the scan: nothing is shuffled until bits are counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.llm.common import BLANKS, whole_text

#: Conditions under which a rule fails, by name; the place in this list is the rule's bit.
#: New rules are added at the end, so that stored bits keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 75 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("capitals", "2 * n_capitals > word_chars"),
    ("bullets", "10 * n_lone_marks > 3 * n_words"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    """The bits of some rules."""
    return sum(BITS[name] for name in set(names))


#: Policies by version: a row is kept if it fails none of the policy's rules.
POLICIES: dict[str, int] = {
    "base": mask("few_words", "repeated_windows"),
    "v1": mask("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": mask(*BITS),
}
CURRENT = "v2"

#: Bits that hold a window's place in its text, and the rest, from its hash.
_BITS = "length(bin(size(_words)))"
_SAME = (
    "shiftright({x}, _bits) = shiftright({y}, _bits)"
    " AND slice(_words, CAST({x} & _mask AS INT) + 1, 3)"
    " = slice(_words, CAST({y} & _mask AS INT) + 1, 3)"
)
#: Hash bits above, place below: sorting brings equal windows together.
_WINDOWS = (
    "sort_array(transform(slice(_words, 1, greatest(size(_words) - 2, 0)), (w, i) ->"
    " shiftleft(xxhash64(w, _words[i + 1], _words[i + 2]), _bits) | CAST(i AS BIGINT)))"
)
_REPEATED = (
    "filter(_windows, (x, i) ->"
    f" (i > 0 AND {_SAME.format(x='x', y='_windows[i - 1]')})"
    f" OR (i + 1 < size(_windows) AND {_SAME.format(x='x', y='_windows[i + 1]')}))"
)
_PLACES = "sort_array(transform(_repeated, x -> x & _mask))"
#: A repeated window covers three words, or as many as there are up to the next one.
_COVERED = (
    "aggregate(transform(_places, (p, i) -> CASE WHEN i + 1 < size(_places)"
    " THEN least(3L, _places[i + 1] - p) ELSE 3L END), 0L, (a, x) -> a + x)"
)

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capitals",
    "n_lone_marks",
)


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements (MEASURES, all long) of whole texts.

    Words are separated by blanks and the ASCII controls from tab to carriage return. A
    missing or empty text measures 0 everywhere. ``n_repeat_words`` counts the words in
    three-word windows that come twice or more in the text; windows with equal hash bits are
    compared word by word. Equal rows have equal measurements. Columns of these names, and
    ``failed_bits``, are replaced; all others stay, with whatever is missing in them.
    """
    kept = [c for c in documents.columns if c.lower() not in (*MEASURES, "failed_bits")]
    split = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        whole_text(text).alias("_text"),
        F.array_remove(F.split(whole_text(text), BLANKS), "").alias("_words"),
        F.expr(
            f"filter(split(coalesce(`{text}`, ''), '\\n', -1), l -> l rlike r'[^\\x20\\x09-\\x0D]')"
        ).alias("_lines"),
    )
    sized = split.withColumn("_bits", F.expr(_BITS))
    sized = sized.withColumn("_mask", F.expr("shiftleft(1L, _bits) - 1"))
    sorted_ = sized.withColumn("_windows", F.expr(_WINDOWS))
    found = sorted_.withColumn("_repeated", F.expr(_REPEATED))
    placed = found.withColumn("_places", F.expr(_PLACES))

    def left(pattern: str) -> F.Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("long")

    return placed.select(
        *[F.col("_row").getField(c).alias(c) for c in kept],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_COVERED).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        left(r"\P{Lu}+").alias("n_capitals"),
        F.expr("CAST(size(filter(_words, w -> w IN ('|', '-', '*', '#'))) AS BIGINT)").alias(
            "n_lone_marks"
        ),
    )


def ledger(documents: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``failed_bits`` (long) of every row; an empty table gives an empty one."""
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), BITS[name]).otherwise(0).cast("long"))
    return measure(documents, text).withColumn("failed_bits", bits)


def passes(policy: int) -> F.Column:
    """Whether a ledger row fails none of the rules of a policy mask."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy).cast("long")) == 0


def ablation(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: rows that fail the rule, rows only this rule rejects, rows kept.

    Rows are counted by their bits first; there are at most as many sums as there are
    combinations of rules, whatever the size of the ledger. An empty ledger counts 0.
    """
    counts = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("_n"))
    masked = {p: F.col("failed_bits").bitwiseAND(F.lit(m).cast("long")) for p, m in policies.items()}

    def total(condition: F.Column) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0)).cast("long")

    cells = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(rule).alias("rule"),
            total(masked[policy].bitwiseAND(F.lit(bit).cast("long")) != 0).alias("failed"),
            total(masked[policy] == bit).alias("failed_alone"),
            total(masked[policy] == 0).alias("kept"),
        )
        for policy, rules in policies.items()
        for rule, bit in BITS.items()
        if rules & bit
    ]
    return counts.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))
