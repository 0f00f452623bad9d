"""Dense row numbers, level codes and exact order statistics without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelsight.sources.scratch import staged

# Splits of files whose offsets are sent to every task (some 150 bytes each).
MOST_SPLITS = 500_000
# Copies of one identical row that a single task expands.
COPIES_PER_TASK = 100_000
# Rows an order statistic may bring to the driver, and the sketch's rank error 1/n.
SMALL = 50_000
SKETCH = 10_000
# Buckets that a group's range is cut into to find a rank.
BUCKETS = 4_096
# Buckets of evenly drawn numbers: of 10^11 rows of a group one holds some 1.5 million.
DRAW_BUCKETS = 1 << 16


def _spread_copies(rows: DataFrame, copies: str, number: str) -> DataFrame:
    """One row per copy, numbered; rows with very many copies are split over tasks."""
    few = rows.filter(F.col(copies) <= COPIES_PER_TASK).withColumn(
        number, F.explode(F.sequence(F.lit(1), F.col(copies)))
    )
    many = rows.filter(F.col(copies) > COPIES_PER_TASK)
    blocks = F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPIES_PER_TASK))
    first = F.col("_block") * COPIES_PER_TASK + 1
    last = F.least(first + (COPIES_PER_TASK - 1), F.col(copies))
    many = (
        many.withColumn("_block", F.explode(blocks))
        .repartition(*rows.columns, "_block")
        .withColumn(number, F.explode(F.sequence(first, last)))
        .drop("_block")
    )
    return few.unionByName(many).drop(copies)


def dense_ids(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_id",
    start: int = 1,
    unique: bool = False,
) -> DataFrame:
    """Consecutive ids in the order of ``order_by``.

    Rows are range partitioned and sorted, written once, and numbered as partition
    offset + position; only one row per partition meets in the offset window. For the order
    of rows in files see ``file_order_ids``. ``unique`` promises that ``order_by``
    identifies a row. Without it the other columns break ties and identical rows are
    counted first, so a group of copies is spread over partitions by copy number.
    """
    order = list(order_by)
    rows = df
    if not unique:
        order += [c for c in df.columns if c not in order] + ["_copy"]
        rows = _spread_copies(
            df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")), "_copies", "_copy"
        )
    placed = staged(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        # High bits: partition, low 33 bits: position in it.
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
        .drop("_copy"),
        "dense-ids",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One offset per partition of the write: a size fixed by the partition count.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position + F.lit(start)).cast("bigint").alias(name), *df.columns
    )


def file_order_ids(df: DataFrame, name: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive ids in the order of the files' names and of the rows in each file.

    ``df`` is a scan of files, with filters and computed columns on top at most: nothing that moves
    rows between tasks. A row's place is that of its split (file and first byte), and its position
    in it. Rows are written once as they come, neither sorted nor shuffled; only the splits' counts
    are summed up. Rows that a filter takes out get no number, equal rows each their own, and empty
    files hold none. Columns must not begin with ``_split``.
    """
    placed = staged(
        df.withColumns(
            {
                "_split_file": F.col("_metadata.file_path"),
                "_split_start": F.col("_metadata.file_block_start"),
                # Grows by one from row to row of a task, so also within a split.
                "_split_place": F.monotonically_increasing_id(),
            }
        ).select(*df.columns, "_split_file", "_split_start", "_split_place"),
        "file-order",
    )
    keys = ["_split_file", "_split_start"]
    splits = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_split_rows"), F.min("_split_place").alias("_split_first")
    )
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_split_rows").over(earlier), F.lit(0))
    # One row for each split of the scan.
    offsets = staged(
        splits.select(*keys, (before - F.col("_split_first")).alias("_split_before")), "splits"
    )
    if offsets.count() <= MOST_SPLITS:
        offsets = F.broadcast(offsets)
    number = F.col("_split_place") + F.col("_split_before") + F.lit(start)
    return placed.join(offsets, keys).select(number.cast("bigint").alias(name), *df.columns)


def level_table(df: DataFrame, column: str, code: str, start: int = 1) -> DataFrame:
    """Distinct non-null values in lexical order with their index."""
    levels = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return dense_ids(levels, [column], code, start=start, unique=True)


def level_codes(df: DataFrame, column: str, code: str, start: int = 1) -> DataFrame:
    """Add the index of each value among the sorted distinct values; NULL stays NULL."""
    return df.join(level_table(df, column, code, start), column, "left").select(*df.columns, code)


@dataclass
class _Target:
    """Search state: the wanted value lies strictly between ``low`` and ``high``."""

    where: Column
    rank: int  # zero-based, among all values of the target's rows
    low: float | None = None
    high: float | None = None
    below: int = 0  # values at or under ``low``
    inside: int = 0  # values strictly between
    slack: float = 2.0 / SKETCH
    value: float | None = None

    def open_interval(self, value: Column) -> Column:
        test = self.where & value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test


def _narrow(df: DataFrame, value: Column, open_targets: list[_Target]) -> None:
    """Shrink every target's interval by a quantile sketch, then count exactly."""
    sketches = []
    for t in open_targets:
        share = (t.rank - t.below + 0.5) / t.inside
        bracket = [max(0.0, share - t.slack), min(1.0, share + t.slack)]
        inside = F.when(t.open_interval(value), value)
        sketches.append(F.percentile_approx(inside, bracket, SKETCH))
    bounds = df.agg(*[s.alias(f"b{i}") for i, s in enumerate(sketches)]).first()
    counts = []
    for i, t in enumerate(open_targets):
        lo, hi = bounds[f"b{i}"]
        inside = t.open_interval(value)
        counts += [
            F.count_if(inside & (value < F.lit(lo))).alias(f"lt{i}"),
            F.count_if(inside & (value == F.lit(lo))).alias(f"lo{i}"),
            F.count_if(inside & (value > F.lit(lo)) & (value < F.lit(hi))).alias(f"in{i}"),
            F.count_if(inside & (value == F.lit(hi))).alias(f"hi{i}"),
        ]
    seen = df.agg(*counts).first()
    for i, t in enumerate(open_targets):
        lo, hi = bounds[f"b{i}"]
        at_lo = t.below + seen[f"lt{i}"]
        above_lo = at_lo + seen[f"lo{i}"]
        at_hi = above_lo + seen[f"in{i}"]
        above_hi = at_hi + (seen[f"hi{i}"] if hi > lo else 0)
        if at_lo <= t.rank < above_lo:
            t.value = lo
        elif above_lo <= t.rank < at_hi:
            t.low, t.high, t.below, t.inside = lo, hi, above_lo, seen[f"in{i}"]
        elif at_hi <= t.rank < above_hi:
            t.value = hi
        else:  # the sketch missed the rank: look wider in the next round
            t.slack *= 4


def order_statistics(
    df: DataFrame, column: str, targets: Sequence[tuple[Column, int, int]], small: int = SMALL
) -> list[float]:
    """Exact values at given ranks, each target being (row filter, zero-based rank, row count).

    Every round sketches the quantiles around a rank and counts exactly what lies on
    either side, so the candidates shrink by the sketch's precision whatever the
    distribution; only when at most ``small`` are left are their distinct values fetched.
    Nothing is shuffled but the sketches, and a value held by many rows is found as a bound.
    """
    value = F.col(column)
    state = [_Target(where, rank, inside=n) for where, rank, n in targets]
    while pending := [t for t in state if t.value is None]:
        if large := [t for t in pending if t.inside > small]:
            _narrow(df, value, large)
            continue
        for t in pending:
            near = (
                df.filter(t.open_interval(value))
                .groupBy(value.alias("v"))
                .agg(F.count(F.lit(1)).alias("n"))
                .collect()
            )
            seen = t.below
            for row in sorted(near, key=lambda r: r["v"]):
                seen += row["n"]
                if seen > t.rank:
                    t.value = row["v"]
                    break
    return [t.value for t in state]


def exact_median(df: DataFrame, column: str, small: int = SMALL) -> float | None:
    """Median of the non-null values: mean of the two middle ones if their number is even.

    The search passes over the values several times, so only they are staged, once.
    """
    values = staged(df.select(column).where(F.col(column).isNotNull() & ~F.isnan(column)), "values")
    n = values.count()
    if n == 0:
        return None
    ranks = sorted({(n - 1) // 2, n // 2})
    middle = order_statistics(values, column, [(F.lit(True), r, n) for r in ranks], small)
    return sum(middle) / len(middle)


def _cumulated(rows: DataFrame, order: str) -> DataFrame:
    """Rows (_g, order, _n) that hold their group's rank, with ``_before``: values under them."""
    upto = Window.partitionBy("_g").orderBy(order)
    return (
        rows.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    )


def rank_thresholds(
    df: DataFrame, by: str, column: str, share: float, buckets: int = BUCKETS, rounds: int = 2
) -> DataFrame:
    """Per group (NULL is one) the smallest value with at least ``share`` of the group's values
    at or under it: columns ``by`` and ``threshold``.

    Values are counted by group and bucket of the group's range; the bucket that holds the rank
    is cut into buckets again, and only the distinct values that are left are put in order. A
    window sees ``buckets`` rows of a group at a time, and any number of groups will do.
    """
    value = F.col(column).cast("double")
    values = staged(
        df.select(F.col(by).alias("_g"), value.alias("_v")).where(
            F.col("_v").isNotNull() & ~F.isnan("_v")
        ),
        "values",
    )
    state = values.groupBy("_g").agg(
        F.ceil(F.lit(share) * F.count(F.lit(1))).alias("_rank"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
    )
    state = staged(state.withColumn("_rank", F.greatest("_rank", F.lit(1))), "ranks")

    def inside() -> DataFrame:
        own = state.withColumnRenamed("_g", "_own")
        met = values.join(own, values["_g"].eqNullSafe(own["_own"])).drop("_own")
        return met.where(F.col("_v").between(F.col("_low"), F.col("_high")))

    for _ in range(rounds):
        width = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        bucket = F.when(F.col("_high") > F.col("_low"), F.floor(width * buckets)).otherwise(0)
        counts = (
            inside()
            .groupBy("_g", "_rank", F.least(bucket, F.lit(buckets - 1)).alias("_bucket"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        )
        state = staged(
            _cumulated(counts, "_bucket").select(
                "_g", (F.col("_rank") - F.col("_before")).alias("_rank"), "_low", "_high"
            ),
            "ranks",
        )
    last = inside().groupBy("_g", "_rank", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return _cumulated(last, "_v").select(F.col("_g").alias(by), F.col("_v").alias("threshold"))


def drawn_thresholds(
    df: DataFrame, by: str, column: str, share: float, buckets: int = DRAW_BUCKETS
) -> DataFrame:
    """As ``rank_thresholds``, of numbers known to lie in [0, 1) evenly: one count by group and
    bucket, then a look at the one bucket of each group that holds the rank. No value may be missing.
    """
    bucket = F.least(F.floor(F.col(column) * buckets), F.lit(buckets - 1))
    rows = df.select(F.col(by).alias("_g"), F.col(column).alias("_v"), bucket.alias("_bucket"))
    counts = rows.groupBy("_g", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("_g"))
    ranked = counts.withColumn("_rank", F.greatest(F.ceil(F.lit(share) * total), F.lit(1)))
    state = _cumulated(ranked, "_bucket").select(
        F.col("_g").alias("_own"),
        F.col("_bucket").alias("_in"),
        (F.col("_rank") - F.col("_before")).alias("_rank"),
    )
    inside = rows["_g"].eqNullSafe(state["_own"]) & (rows["_bucket"] == state["_in"])
    met = rows.join(state, inside)
    last = met.groupBy("_g", "_rank", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return _cumulated(last, "_v").select(F.col("_g").alias(by), F.col("_v").alias("threshold"))


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Columns summed up within their group over the rows up to each one, in the order of a column
    that is unique within the group, and ``following``, the next value of that column; groups and
    order must not be missing.

    Rows are range partitioned and written once, so a group of any size is spread over many tasks;
    each part is summed up by itself, and what the parts before it hold is added. Only one row for
    each group and part meets in the second window.
    """
    keys = [*group, "_part"]
    placed = staged(
        df.select(*group, order, *columns)
        .repartitionByRange(*group, order)
        .withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    own = Window.partitionBy(*keys).orderBy(order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    parts = placed.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in columns], F.min(order).alias("_first")
    )
    beside = Window.partitionBy(*group).orderBy("_part")
    earlier = beside.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys,
        F.lead("_first").over(beside).alias("_after"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns],
    )
    return placed.join(offsets, keys).select(
        *group,
        order,
        *[(F.sum(c).over(upto) + F.col(f"_before_{c}")).alias(c) for c in columns],
        F.coalesce(F.lead(order).over(own), "_after").alias("following"),
    )
