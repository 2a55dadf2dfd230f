"""Mixing sources to target weights by a low-discrepancy schedule.

Every source has a weight; targets share out all words by weight, a target
stopping at ``most`` times its source's size with the excess reshared. A source's
documents stand in shuffled order (by hash of the key) on one line of words, cut
into ``BLOCKS`` blocks of equal words, so that a block's size follows its source.
The source has as many slots as its target, rounded to a word, takes of them:
the slot of rank r takes block ``r mod blocks``, in pass ``r div blocks``, and the
last one only the words that are left. So each source meets its target to a word,
however small it is beside the others.

The schedule orders the slots of all sources. Point i, ``frac(i * golden ratio)``,
falls to the source whose stretch of the cumulative slots holds it; the points of
a source are ranked, and a slot stands at the point of its rank. Points evenly
cover every stretch, so that all sources last until the end.

Positions on a source's line come from a two-level scan in the order of the hash:
no source is ordered in one task. Points meet sources by an equality join on cells.

Defined results: a null or empty text has size 0 and is taken 0 times; null
sources are one source, last in order; repeated rows stand side by side and
count each; without words all targets are 0. Reruns give the same result, up
to the order among rows alike in key and size. Only key, text and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.llm.sharding import address
from perplexis.operators.running import running_totals
from perplexis.sources.workspace import stored

BLOCKS = 4096
MOST = 3
WEIGHTS = (1, 2, 3)
CELLS = 1024
GOLDEN = 0.6180339887498949


def sizes(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key, source, size`` of every row, in words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text"):
                words = columns.Words(*columns.flat(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.counts, pa.int64())],
                    names=["key", "source", "size"],
                )

    rows = df.select(
        F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(run, "key long, source string, size long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target, low, high`` from ``source, source_size``.

    ``low`` and ``high`` bound the source's stretch of the cumulative targets
    as a share of all. In order of cap over weight, the sources before the
    first whose cap is above its share of what is left are the capped ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1).cast("long")
    )
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    rest = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    share = (total - capped) / F.sum("weight").over(rest)
    levels = ranked.withColumn("share", share).withColumn("place_by_cap", F.row_number().over(rising)).withColumn(
        "over", F.col("source_size") * most <= F.col("share") * F.col("weight")
    )
    level = F.coalesce(F.min(F.when(~F.col("over"), F.struct("place_by_cap", "share"))).over(everything)["share"], F.lit(0.0))
    levels = levels.withColumn("level", level)
    levels = levels.withColumn("target", F.when(
        F.col("over"), (F.col("source_size") * most).cast("double")
    ).otherwise(F.col("weight") * F.col("level")))
    line = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("target").over(line)
    levels = levels.withColumn("_end", end).withColumn("_all", F.max("_end").over(everything))
    high = F.when(F.col("_end") >= F.col("_all"), 1.0).otherwise(F.col("_end") / F.col("_all"))
    levels = levels.withColumn("high", high)
    low = F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0.0))
    return levels.withColumn("low", low).select(
        "source", "source_size", "weight", "target", "low", "high"
    )


def lines(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """``(goals, places)``: targets, and every row with its stretch ``[start, start + size)`` of its source's line."""
    goals = stored(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets"
    )
    ordered = running_totals(rows.withColumn("at", address(F.col("key"))), ["at", "key", "size"], {"end": F.col("size")}, ["source"])
    places = _same(ordered, slots_of(goals), ["source"]).withColumn("start", F.col("end") - F.col("size"))
    return goals, places.drop("end", "range_id", "at")


def slots_of(goals: DataFrame) -> DataFrame:
    """``goals`` with ``words`` (to be taken), ``block`` (words in one), ``n_blocks``, ``passes``, ``rest`` (words of the last) and ``slots``."""
    sized = goals.withColumn("words", F.round("target").cast("long")).withColumn(
        "block", F.greatest(F.lit(1), F.expr(f"CAST(ceil(source_size / {BLOCKS}) AS BIGINT)"))
    )
    sized = sized.withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    passes = F.expr("CASE WHEN source_size > 0 THEN words DIV source_size ELSE 0 END")
    sized = sized.withColumn("passes", passes).withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    return sized.withColumn("slots", (F.col("passes") * F.col("n_blocks") + F.ceil(F.col("rest") / F.col("block"))).cast("long"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys equal each other."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, condition).drop(*(f"_{k}" for k in keys))


def schedule(sized: DataFrame) -> DataFrame:
    """``slot, source, rank, pass, block``: which block of which source stands at which point.

    ``sized`` are the rows of ``slots_of``. There are twice as many points as
    slots; a source with so few slots that no point falls to one has none for it.
    """
    line = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    placed = sized.where("slots > 0").withColumn("_end", F.sum("slots").over(line)).withColumn("_all", F.sum("slots").over(everything))
    stretches = placed.select(
        "source", "slots", "n_blocks", ((F.col("_end") - F.col("slots")) / F.col("_all")).alias("low"),
        (F.col("_end") / F.col("_all")).alias("high"),
    )
    n_slots = sized.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    points = sized.sparkSession.range(2 * n_slots).select(
        F.col("id").alias("slot"), (F.col("id") * GOLDEN - F.floor(F.col("id") * GOLDEN)).alias("point")
    ).withColumn("cell", F.floor(F.col("point") * CELLS))
    cells = stretches.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))
    )))
    taken = points.join(cells, "cell").where("point >= low AND point < high")
    rank = F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1
    return taken.withColumn("rank", rank).where(F.col("rank") < F.col("slots")).select(
        "slot", "source", F.col("rank").cast("long").alias("rank"), F.expr("rank DIV n_blocks").alias("pass"),
        (F.col("rank") % F.col("n_blocks")).cast("long").alias("block"),
    )


def mix(
    df: DataFrame, key: str, text: str, source: str,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """``key, size, source, source_size, target, taken, first_slot`` for every row.

    ``first_slot`` is where the schedule first takes words of the row, -1 if nowhere.
    """
    goals, places = lines(stored(sizes(df, key, text, source), "sizes"), weights, most)
    first = schedule(slots_of(goals)).where("pass = 0").select("source", F.col("block").alias("first_block"), F.col("slot").alias("first_slot"))
    part = F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("size"))
    taken = (F.col("passes") * F.col("size") + part).cast("long")
    rows = places.withColumn("taken", taken).withColumn("first_block", F.when(F.col("taken") > 0, F.expr("start DIV block")))
    met = rows.join(
        first.withColumnsRenamed({"source": "_source", "first_block": "_block"}),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("first_block") == F.col("_block")), "left",
    )
    return met.select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target", "taken",
        F.coalesce("first_slot", F.lit(-1)).alias("first_slot"),
    )
