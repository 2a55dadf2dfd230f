"""Running totals over a whole table without a single-task window.

A two-level scan: rows are dealt to ranges of the order, so many that each holds
about a fixed number of rows; each range is summed on its own; the sums of the
ranges get a running total of their own, and the rows of a range go on from
there. Many range sums are added up in blocks first, in the same way. Results do
not depend on where the ranges end, and no cut point is known to this code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored

ROWS_PER_RANGE = 1 << 18
RANGES_PER_BLOCK = 1 << 10


def with_ranges(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                rows: int = ROWS_PER_RANGE) -> tuple[DataFrame, int]:
    """``df`` with ``range_id``, stored, and the number of ranges.

    Ranges follow ``by`` and ``order`` and hold about ``rows`` rows each, also
    where many rows tie: those are told apart by where they are read, so that
    ``df`` must be a stored table or one without ties.
    """
    ranges = max(1, -(-df.count() // rows))
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(ranges, *by, *order, "_row")
    return stored(dealt.withColumn("range_id", F.spark_partition_id()).drop("_row"), "ranges"), ranges


def _null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    right = right.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    joined = left.join(right, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return joined.drop(*(f"_of_{c}" for c in columns))


def _before(sums: DataFrame, names: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """The sums with each name replaced by what precedes the row in its group."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*by, order, *[F.coalesce(F.sum(n).over(window), F.lit(0)).alias(n) for n in names])


def range_starts(sums: DataFrame, names: Sequence[str], by: Sequence[str] = (), many: bool = False) -> DataFrame:
    """``by, range_id`` and the running totals with which each range begins.

    With ``many`` ranges they are added up in blocks, so that no task sees the
    sums of more than ``RANGES_PER_BLOCK`` ranges, or as many blocks.
    """
    if not many:
        return _before(sums, names, by, "range_id")
    blocked = sums.withColumn("block", F.expr(f"range_id div {RANGES_PER_BLOCK}"))
    blocks = blocked.groupBy(*by, "block").agg(*[F.sum(n).alias(n) for n in names])
    starts = _before(blocks, names, by, "block").withColumnsRenamed({n: f"_block_{n}" for n in names})
    within = _null_safe(_before(blocked, names, [*by, "block"], "range_id"), starts, [*by, "block"])
    return within.select(*by, "range_id", *[(F.col(n) + F.col(f"_block_{n}")).alias(n) for n in names])


def running_totals(df: DataFrame, order: Sequence[str], values: Mapping[str, Column], by: Sequence[str] = (),
                   rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds, per name in ``values``, the total of the expression up to this row, and ``range_id``.

    ``by`` restarts the totals. Hand in a stored table of the columns that count.
    """
    if df.count() <= rows:
        # One range: nothing to be dealt, or to go on from.
        ranged, ranges = df.withColumn("range_id", F.lit(0)), 1
    else:
        ranged, ranges = with_ranges(df, order, by, rows)
    within = Window.partitionBy(*by, "range_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.select("*", *[F.sum(v).over(within).alias(n) for n, v in values.items()])
    if ranges == 1:
        return totals.select(*df.columns, "range_id", *values)
    sums = ranged.groupBy(*by, "range_id").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    starts = range_starts(sums, list(values), by, ranges > RANGES_PER_BLOCK)
    starts = starts.withColumnsRenamed({n: f"_start_{n}" for n in values})
    return _null_safe(totals, starts, [*by, "range_id"]).select(
        *df.columns, "range_id", *[(F.col(n) + F.col(f"_start_{n}")).alias(n) for n in values]
    )


def row_numbers(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``row_number``, from 1, in the given order within each group."""
    numbered = running_totals(df, order, {"row_number": F.lit(1)}, by, rows)
    return numbered.drop("range_id")
