"""Secrets in texts: patterns, and character Markov models of random strings and identifiers.

A run of identifier characters that no pattern claims, or a long enough part of one, is a secret if
a model trained on random strings gives it a likelihood that is high enough against one trained on
ordinary words. All work is column functions; the models are a table of character pairs, read as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.llm.common import whole_text

#: Patterns of the base kinds in their order, and the least length of a hit (for
#: an assignment, of its second group).
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12

#: What the models judge: runs of these characters, this long at least.
LEAST_RUN = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
#: Parts of runs between joiners.
PIECE = rf"[A-Za-z0-9+]{{{LEAST_RUN},}}"
KINDS = ("assign", "access", "hex", "random")
#: Printable ASCII characters, the models' alphabet.
LETTERS = 95
#: Least log-likelihood ratio (natural) per character pair.
LEAST_RATIO = 0.7
#: A stretch of a run ends when the sum of log ratios has fallen this much below its peak.
DROP = 10
#: Bounds of the labelled samples: documents with ordinary words, random strings of each style.
SAMPLE_DOCUMENTS = 4_000
SAMPLE_STRINGS = 4_000
#: Length of blocks in running sums.
_BLOCK = 256

REDACTED = "[SECRET]"


def split_at(text: Column, pattern: str) -> tuple[Column, Column]:
    """What a pattern matches in a text, and the parts before, between and after the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found, F.split(text, pattern, -1)


def with_matches(rows: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Add ``name``: every match, leftmost and not overlapping, as (first, last, found).

    ``first`` counts the code points before the match, ``last`` is one after its end. Running
    sums go over blocks of lengths, so that a text with very many matches stays cheap.
    """
    found, parts = f"_{name}_found", f"_{name}_parts"
    steps, blocks, sums = f"_{name}_steps", f"_{name}_blocks", f"_{name}_sums"
    some = f"size({found}) > 0"
    rows = rows.withColumn(found, split_at(F.col(text), pattern)[0])
    rows = rows.withColumn(parts, F.when(F.expr(some), split_at(F.col(text), pattern)[1]))
    rows = rows.withColumn(
        steps,
        F.expr(
            f"transform({found}, (m, i) -> CAST(length({parts}[i])"
            f" + if(i > 0, length({found}[i - 1]), 0) AS BIGINT))"
        ),
    )
    rows = rows.withColumn(
        sums,
        F.expr(
            f"if({some}, transform(sequence(0, (size({steps}) - 1) div {_BLOCK}), b -> aggregate("
            f"slice({steps}, CAST(b AS INT) * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x)),"
            " array())"
        ),
    )
    rows = rows.withColumn(
        blocks,
        F.expr(
            f"aggregate({sums}, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
        ),
    )
    first = (
        f"({blocks}[i div {_BLOCK}] + aggregate(slice({steps}, i - i % {_BLOCK} + 1,"
        f" i % {_BLOCK} + 1), 0L, (a, x) -> a + x))"
    )
    spans = F.expr(
        f"transform(transform({found}, (m, i) -> named_struct('first', {first}, 'found', m)),"
        " s -> named_struct('first', s.first, 'last', s.first + length(s.found),"
        " 'found', s.found))"
    )
    return rows.withColumn(name, spans).drop(found, parts, steps, sums, blocks)


def _long_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 1)) >= LEAST_VALUE


def random_strings(spark: SparkSession, count: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled samples of random strings in four styles: the digests of consecutive numbers."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    styles = F.array(
        coded, F.translate(coded, "+/=", "-_"), F.translate(coded, "+/=", ""), F.substring(digest, 1, 40)
    )
    return spark.range(count).select(F.explode(styles).alias("text"), F.lit(True).alias("random"))


def ordinary_strings(
    documents: DataFrame, labels: DataFrame, count: int = SAMPLE_DOCUMENTS
) -> DataFrame:
    """Labelled samples of ordinary words: the distinct ones, of six characters at least, in at
    most ``count`` documents that are labelled as good; those a pattern claims are left out."""
    picked = (
        labels.where("quality = 1 AND doc_id IS NOT NULL")
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(count)
    )
    plain = whole_text()
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.regexp_extract_all(plain, F.lit(r"[A-Za-z][A-Za-z0-9+/_=-]{5,}"), F.lit(0))
    rows = documents.join(picked, "doc_id", "left_semi").select(F.explode(words).alias("text"))
    return rows.distinct().select("text", F.lit(False).alias("random"))


def train(samples: DataFrame, smoothing: float = 0.5) -> DataFrame:
    """One row, one column: the log ratio of each pair of characters (array of LETTERS²).

    ``samples`` has ``text`` and ``random``. Each model's probability of a character after
    another one is its count in that model's samples, with ``smoothing`` added. Missing, empty
    and one-letter samples teach nothing; without any sample, every ratio is 0.
    """
    pairs = samples.where("random IS NOT NULL").select(
        "random",
        F.expr(
            "explode(transform(sequence(1, greatest(length(text) - 1, 1)), i ->"
            f" if(length(text) < 2, -1, (ascii(substr(text, i, 1)) - 32) * {LETTERS}"
            " + ascii(substr(text, i + 1, 1)) - 32)))"
        ).alias("pair"),
    )
    size = LETTERS * LETTERS
    counts = pairs.where(f"pair BETWEEN 0 AND {size - 1}").groupBy("pair").agg(
        F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o")
    )
    every = samples.sparkSession.range(size).select(F.col("id").cast("int").alias("pair"))
    full = every.join(counts, "pair", "left").select(
        F.expr(f"pair div {LETTERS}").alias("row"),
        "pair",
        (F.coalesce("r", F.lit(0)) + smoothing).alias("r"),
        (F.coalesce("o", F.lit(0)) + smoothing).alias("o"),
    )
    sums = full.groupBy("row").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    ratio = full.join(sums, "row").select(
        "pair", F.expr("ln(r / rs) - ln(o / os)").alias("ratio")
    )
    cells = F.array_sort(F.collect_list(F.struct("pair", "ratio")))
    return ratio.agg(F.transform(cells, lambda c: c["ratio"]).alias("ratios"))


def with_merged(rows: DataFrame, name: str, spans: str) -> DataFrame:
    """Add ``name``: what an array of spans covers, as (first, last), in order and without overlap.

    The last end before each span is a running maximum over blocks, so the work grows with the
    number of spans.
    """
    order, peaks, starts = f"_{name}_order", f"_{name}_peaks", f"_{name}_starts"
    rows = rows.withColumn(
        order,
        F.expr(
            f"sort_array(transform({spans}, s -> named_struct('first', CAST(s.first AS BIGINT),"
            " 'last', CAST(s.last AS BIGINT))))"
        ),
    )
    rows = rows.withColumn(
        peaks,
        F.expr(
            f"aggregate(if(size({order}) > 0, sequence(0, (size({order}) - 1) div {_BLOCK}), array()),"
            " array(0L), (a, b) -> concat(a, array(greatest(element_at(a, -1), array_max(transform("
            f"slice({order}, CAST(b AS INT) * {_BLOCK} + 1, {_BLOCK}), s -> s.last))))))"
        ),
    )
    before = (
        f"aggregate(slice({order}, i - i % {_BLOCK} + 1, i % {_BLOCK}),"
        f" {peaks}[i div {_BLOCK}], (a, s) -> greatest(a, s.last))"
    )
    rows = rows.withColumn(
        starts,
        F.expr(
            f"filter(transform({order}, (s, i) -> named_struct('first', s.first, 'before', {before})),"
            " (s, i) -> i = 0 OR s.first >= s.before)"
        ),
    )
    merged = (
        f"transform({starts}, (s, i) -> named_struct('first', s.first, 'last',"
        f" if(i + 1 < size({starts}), get({starts}, i + 1).before, element_at({peaks}, -1))))"
    )
    return rows.withColumn(name, F.expr(merged)).drop(order, peaks, starts)


def _replaced(text: str, merged: str, instead: str) -> str:
    """SQL text: a text with ``instead`` in place of each merged span ``m``."""
    done = f"if(i > 0, get({merged}, i - 1).last, 0L)"
    return (
        f"if(size({merged}) > 0, concat(array_join(transform({merged}, (m, i) -> concat("
        f"substring({text}, CAST({done} + 1 AS INT), CAST(m.first - {done} AS INT)), {instead})), ''),"
        f" substring({text}, CAST(element_at({merged}, -1).last + 1 AS INT))), {text})"
    )


def _scored(rows: DataFrame, name: str) -> DataFrame:
    """Add ``over`` to an array of matches: by how much each pair's log ratio passes LEAST_RATIO."""
    codes = "transform(split(s.found, ''), c -> ascii(c) - 32)"
    rows = rows.withColumn(
        name,
        F.expr(
            f"transform({name}, s -> named_struct('first', s.first, 'last', s.last, 'found', s.found,"
            f" 'codes', {codes}))"
        ),
    )
    over = (
        "transform(sequence(1, length(s.found) - 1), i ->"
        f" _ratios[s.codes[i - 1] * {LETTERS} + s.codes[i]] - {LEAST_RATIO}D)"
    )
    return rows.withColumn(
        name,
        F.expr(
            f"transform({name}, s -> named_struct('first', s.first, 'last', s.last, 'found', s.found,"
            f" 'over', {over}))"
        ),
    )


def _passes(over: str) -> str:
    """SQL text: whether the mean log ratio of pairs is at least LEAST_RATIO."""
    return f"aggregate({over}, 0D, (a, x) -> a + x) >= 0"


def _stretches(over: str) -> str:
    """SQL text: stretches (a, b: first and last character) whose pairs add up to a peak.

    A stretch begins where the sum was last 0, and ends at its peak as soon as the sum is 0 or DROP
    below the peak. Only those as long as a run has to be are kept.
    """
    now = "z.s + x"
    kept = (
        f"if(z.b - z.a >= {LEAST_RUN - 1}, concat(z.out, array(named_struct('a', z.a, 'b', z.b))), z.out)"
    )
    return (
        f"aggregate({over}, named_struct('n', 0, 's', 0D, 'best', 0D, 'a', 0, 'b', 0,"
        " 'out', CAST(array() AS array<struct<a: int, b: int>>)), (z, x) ->"
        f" if({now} <= 0 OR {now} < z.best - {DROP}D,"
        f" named_struct('n', z.n + 1, 's', 0D, 'best', 0D, 'a', z.n + 1, 'b', z.n + 1, 'out', {kept}),"
        f" named_struct('n', z.n + 1, 's', {now}, 'best', greatest(z.best, {now}), 'a', z.a,"
        f" 'b', if({now} > z.best, z.n + 1, z.b), 'out', z.out)), z -> {kept})"
    )


def _random_spans(rows: DataFrame) -> DataFrame:
    """Add ``_random``: what the model takes for random strings outside of the base spans.

    A run is one if its mean log ratio is high enough. In other runs, so are the pieces between
    joiners that are long enough, by the same measure, and stretches that the ratios set off from
    what they are joined to, up to the next joiners if the measure holds for these, too.
    """
    rows = with_merged(rows, "_covered", "_base")
    rows = rows.withColumn("_left", F.expr(_replaced("_text", "_covered", "repeat(' ', CAST(m.last - m.first AS INT))")))
    for name, pattern in (("_run", RUN), ("_piece", PIECE)):
        rows = _scored(with_matches(rows, "_left", name, pattern), name)
    span = "named_struct('first', {0}, 'last', {1})"
    rows = rows.withColumn(
        "_run",
        F.expr(
            "transform(_run, s -> named_struct('first', s.first, 'last', s.last, 'found', s.found,"
            f" 'over', s.over, 'whole', {_passes('s.over')}))"
        ),
    )
    # To the next joiners: characters of the same piece in front of and behind a stretch.
    front = "length(substring_index(translate(left(s.found, c.a), '/=_-', '////'), '/', -1))"
    behind = "length(substring_index(translate(substring(s.found, c.b + 2), '/=_-', '////'), '/', 1))"
    wide = (
        f"transform(transform({_stretches('s.over')}, c -> named_struct('a', c.a, 'b', c.b,"
        f" 'u', c.a - {front}, 'v', c.b + {behind})), c -> if({_passes('slice(s.over, c.u + 1, c.v - c.u)')},"
        f" {span.format('s.first + c.u', 's.first + c.v + 1')}, {span.format('s.first + c.a', 's.first + c.b + 1')}))"
    )
    rows = rows.withColumn(
        "_run", F.expr(f"flatten(transform(_run, s -> if(s.whole, array({span.format('s.first', 's.last')}), {wide})))")
    )
    rows = rows.withColumn(
        "_piece",
        F.expr(
            f"transform(filter(_piece, s -> {_passes('s.over')}), s -> {span.format('s.first', 's.last')})"
        ),
    )
    return with_merged(rows, "_random", "concat(_run, _piece)")


def _with_spans(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Add ``_spans`` to rows with ``_text``: (first, k, last, found), k being the place in KINDS."""
    for name, pattern in (("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX)):
        rows = with_matches(rows, "_text", name, pattern)
    rows = rows.withColumn("_ratios", model.scalar())
    long_value = F.filter("_assign", lambda s: _long_value(s["found"]))
    rows = rows.withColumn("_assign", long_value)

    def kind(name: str, order: int, found: str = "s.found") -> str:
        return (
            f"transform({name}, s -> named_struct('first', s.first, 'k', {order}, 'last', s.last,"
            f" 'found', {found}))"
        )

    base = ", ".join(kind(n, i) for i, n in enumerate(("_assign", "_access", "_hex")))
    rows = _random_spans(rows.withColumn("_base", F.expr(f"concat({base})")))
    found = "substring(_text, CAST(s.first + 1 AS INT), CAST(s.last - s.first AS INT))"
    return rows.withColumn("_spans", F.expr(f"sort_array(concat(_base, {kind('_random', 3, found)}))"))


def find(documents: DataFrame, model: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: an array of (first, last, kind, found), by first, then kind.

    Kinds are those of KINDS: three patterns and ``random``, which the model adds in what the
    patterns' hits leave over. ``found`` is the whole hit; for an assignment, the key too. A missing
    or empty text has no spans. A column named ``spans`` is replaced; all others stay, missing
    values included.
    """
    kept = [c for c in documents.columns if c.lower() != "spans"]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    rows = documents.select(whole.alias("_row"), whole_text(text).alias("_text"))
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    spans = (
        "transform(_spans, s -> named_struct("
        f"'first', s.first, 'last', s.last, 'kind', array({kinds})[s.k], 'found', s.found))"
    )
    return _with_spans(rows, model).select(
        *[F.col("_row").getField(c).alias(c) for c in kept], F.expr(spans).alias("spans")
    )


def redact(
    documents: DataFrame, model: DataFrame, text: str = "text", mark: str = REDACTED
) -> DataFrame:
    """Put ``mark`` in place of every secret that ``find`` gives; an assignment keeps its key.

    Secrets that overlap get one mark. Missing texts stay missing, texts without secrets stay as they
    are, and so do all other columns.
    """
    columns = documents.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = documents.select(whole.alias("_row"), whole_text(text).alias("_text"))
    rows = _with_spans(rows, model).withColumn(
        "_secret",
        F.expr(
            "transform(_spans, s -> named_struct('first', if(s.k = 0, s.last - length("
            f"regexp_extract(s.found, r'{ASSIGN_SQL}', 1)), s.first), 'last', s.last))"
        ),
    )
    rows = with_merged(rows, "_marked", "_secret").withColumn("_mark", F.lit(mark))
    clean = F.when(
        F.col("_row").getField(text).isNotNull(), F.expr(_replaced("_text", "_marked", "_mark"))
    )
    return rows.select(
        *[(clean if c == text else F.col("_row").getField(c)).alias(c) for c in columns]
    )


#: The assignment pattern as it stands in a raw string between single quotes.
ASSIGN_SQL = ASSIGN.replace("'", r"\x27")


def model_for(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The trained models, from the labelled documents' words and random strings."""
    random = random_strings(documents.sparkSession)
    return train(random.unionByName(ordinary_strings(documents, labels)))


def digest(rows: DataFrame) -> DataFrame:
    """Counts and joined spans of rows with ``doc_id`` and ``spans``."""

    def joined(chosen: str) -> str:
        return (
            f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.first, s.last)), ',')"
        )

    base = "filter(spans, s -> s.kind <> 'random')"
    counts = [
        F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}")
        for k in KINDS
    ]
    return rows.select(
        "doc_id",
        *counts[:3],
        F.sha2(F.expr(joined(base)), 256).alias("base_sha256"),
        F.expr(joined("spans")).alias("spans"),
        counts[3],
    )
