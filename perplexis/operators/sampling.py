"""Sampled cross-perplexity: one token drawn from the observer per position.

The observer is a mixture of what its bigram counts add and of its unigram
part. A first number chooses the part, a second one a cell of that part's alias
table, a third one between the two tokens of the cell. All are functions of
seed, keys and position, so a retried task draws the same tokens.

An alias table has as many cells as outcomes. A cell belongs to one outcome; one
whose share is below the average (a light one) leaves the rest of its cell to a
heavy one. Tables of all contexts are built together: the deficits of the light
outcomes and the surpluses of the heavy ones lie on one line each, and a scan
along both tells which heavy outcome fills which cell. A heavy one that gives
more than it has to spare is itself filled up by the next. Shares are whole
numbers, so that the lines end together exactly and sums don't depend on order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.operators.lookup import ROW_TARGET, frequent_lookup, hot_keys, salted_lookup
from perplexis.operators.model import Contexts, ModelPair, power
from perplexis.operators.running import running_totals, with_ranges
from perplexis.operators.tokens import END_ID, UNSEEN_ID
from perplexis.sources.workspace import stored

# Context of the unigram part.
UNIGRAM_ID = 0
# Whole numbers that one unit of a weight that isn't a count is worth: counts of
# a smoothed unigram, and powers of probabilities.
COUNT_UNITS, POWER_UNITS = 1 << 20, 1 << 40
WHOLE = "decimal(38,0)"
# Outcomes in a task that works out small contexts, on average.
TASK_ROWS = 1 << 19
# Contexts whose sums of shares may pass 64 bits are worked out in decimals.
LONG_BITS = 62
# Places in a position's hash, in hexadecimal digits, of its three numbers.
DIGITS = {"part": (1, 10), "place": (11, 11), "choice": (22, 11)}


def uniform(seed: int, keys: Sequence[str]) -> dict[str, Column]:
    """Three numbers in [0, 1) per position, out of one hash."""
    text = F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in keys], F.col("pos"))
    hashed = F.md5(text)
    return {
        name: F.conv(F.substring(hashed, first, n), 16, 10).cast("long") / F.lit(float(16**n))
        for name, (first, n) in DIGITS.items()
    }


def observer_weights(model: ModelPair, temperature: float = 1.0) -> DataFrame:
    """``ctx, next_id, weight, value``: outcomes of each context's bigram part, and of the unigram part.

    Weights are whole numbers. ``value`` is the performer's probability of the
    outcome: after the context, or for the unigram part by itself.
    """
    seen = model.pairs.where((F.col("next_id") != END_ID) & (F.col("n_p") > 0))
    if temperature == 1:
        added, smoothed = F.col("n_p"), lambda n: F.round((n + F.lit(model.alpha)) * COUNT_UNITS)
    else:
        # A pair's probability is what its count adds, plus the unigram part.
        added = power(F.col("prob_p"), temperature) - power(F.lit(1 - model.lam) * F.col("u_p"), temperature)
        added = F.round(added * POWER_UNITS)
        largest = max(1, model.total_p)
        smoothed = lambda n: F.round(power((n + F.lit(model.alpha)) / F.lit(float(largest)), temperature) * POWER_UNITS)
    whole = lambda weight: weight.cast(WHOLE).alias("weight")
    bigram = seen.select(F.col("prev_id").alias("ctx"), "next_id", whole(added), F.col("prob_q").alias("value"))
    unigram = model.words.select(
        F.lit(UNIGRAM_ID).cast("long").alias("ctx"), F.col("id").alias("next_id"), whole(smoothed(F.col("n_p"))),
        model.unigram("q").alias("value"),
    )
    unseen = model.words.sparkSession.range(1).select(
        F.lit(UNIGRAM_ID).cast("long").alias("ctx"), F.lit(UNSEEN_ID).cast("long").alias("next_id"),
        whole(smoothed(F.lit(0))), F.lit(model.unseen_unigram("q")).alias("value"),
    )
    return bigram.unionByName(unigram).unionByName(unseen)


# Events on the line of a context, in the order in which those at one place count.
_HEAVY_ENDS, _HEAVY_STARTS, _LIGHT_STARTS = 0, 1, 2
_LINE = ["at", "kind", "next_id"]


def _events(lined: DataFrame) -> DataFrame:
    """Rows of ``ctx, next_id, value, total, cells, cell, heavy, start, end`` as events of the context's line.

    Each light outcome is one where its deficit starts, each heavy one where its
    surplus starts and one where it ends. Starts bring a mark along.
    """
    heavy = F.struct("start", "next_id", "value")
    light = F.struct("start", "end")
    no_heavy, no_light = F.lit(None).cast(lined.select(heavy).schema[0].dataType), F.lit(None).cast(lined.select(light).schema[0].dataType)

    def event(at: str, kind: int, heavy_mark: Column, light_mark: Column) -> Column:
        return F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), heavy_mark.alias("heavy_mark"), light_mark.alias("light_mark"))

    happen = F.when(F.col("heavy"), F.array(
        event("start", _HEAVY_STARTS, heavy, no_light), event("end", _HEAVY_ENDS, no_heavy, no_light)
    )).otherwise(F.array(event("start", _LIGHT_STARTS, no_heavy, light)))
    return lined.select("ctx", "next_id", "value", "total", "cells", "cell", "amount", F.inline(happen))


def _cells(scanned: DataFrame) -> DataFrame:
    """A cell of each outcome, from events that know the last heavy and the last light start before them.

    A light outcome's cell is filled by the last heavy one to start there or
    before. A heavy one gives until a light deficit ends, past its own surplus;
    what it gives too much, the heavy one that starts where it ends makes up.
    """
    over = F.greatest(F.col("last_light.end") - F.col("at"), F.lit(0))
    is_light = F.col("kind") == _LIGHT_STARTS
    kept = F.col("total") - F.when(is_light, F.col("amount")).otherwise(F.coalesce(over, F.lit(0)))
    other = F.when(is_light, F.struct(F.col("last_heavy.next_id"), F.col("last_heavy.value"))).otherwise(F.col("following"))
    return scanned.where(F.col("kind") != _HEAVY_STARTS).select(
        "ctx", "cell", "cells", (kept.cast("double") / F.col("total").cast("double")).alias("share"),
        F.col("next_id").alias("own"), F.col("value").alias("own_value"),
        F.coalesce(other["next_id"], F.col("next_id")).alias("other"), F.coalesce(other["value"], F.col("value")).alias("other_value"),
    )


def _sized(outcomes: DataFrame, whole: str) -> DataFrame:
    """Adds ``heavy`` and ``amount``: what the outcome's share is above or below the average."""
    excess = F.col("weight").cast(whole) * F.col("cells").cast(whole if whole == "long" else "decimal(18,0)") - F.col("total").cast(whole)
    excess = excess.cast(whole)
    return outcomes.select(
        "ctx", "next_id", "value", F.col("total").cast(whole).alias("total"), "cells",
        (excess > 0).alias("heavy"), F.abs(excess).cast(whole).alias("amount"),
    )


def _lined(sized: DataFrame, end: Column, place: Column, whole: str) -> DataFrame:
    """Places on the line, and cells: those of light outcomes from the first on, of heavy ones from the last back."""
    cell = F.when(F.col("heavy"), F.col("cells") - place).otherwise(place - 1)
    placed = sized.select("*", end.cast(whole).alias("end"), cell.cast("long").alias("cell"))
    return placed.withColumn("start", (F.col("end") - F.col("amount")).cast(whole))


def _small_contexts(outcomes: DataFrame, whole: str) -> DataFrame:
    """Cells of contexts that one task each can hold: one shuffle by context, all else are windows in it."""
    context = Window.partitionBy("ctx")
    sized = _sized(outcomes.select(
        "*", F.sum("weight").over(context).alias("total"), F.count("*").over(context).alias("cells")
    ), whole)
    line = Window.partitionBy("ctx", "heavy").orderBy("next_id").rowsBetween(Window.unboundedPreceding, 0)
    events = _events(_lined(sized, F.sum("amount").over(line), F.count("*").over(line), whole))
    order = Window.partitionBy("ctx").orderBy(*_LINE)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return _cells(events.select(
        "*", F.max("heavy_mark").over(so_far).alias("last_heavy"), F.max("light_mark").over(so_far).alias("last_light"),
        # A heavy one that starts where this one ends is the next event of the line.
        F.lead(F.when(F.col("kind") == _HEAVY_STARTS, F.struct("next_id", "value"))).over(order).alias("following"),
    ))


def _large_contexts(outcomes: DataFrame, totals: DataFrame, whole: str, rows: int) -> DataFrame:
    """Cells of contexts with more outcomes than a task should hold, by two-level scans along their lines."""
    sized = stored(_sized(outcomes.join(totals, "ctx"), whole), "amounts")
    scanned = running_totals(sized, ["next_id"], {"end": F.col("amount"), "place": F.lit(1)}, ["ctx", "heavy"], rows)
    lined = _lined(scanned.withColumnRenamed("end", "_end"), F.col("_end"), F.col("place"), whole)
    lined = stored(lined.drop("_end", "place", "range_id"), "lines")
    ranged, _ = with_ranges(stored(_events(lined), "events"), _LINE, ["ctx"], rows)
    so_far = Window.partitionBy("ctx", "range_id").orderBy(*_LINE).rowsBetween(Window.unboundedPreceding, 0)
    marks = {"last_heavy": "heavy_mark", "last_light": "light_mark"}
    within = ranged.select("*", *[F.max(mark).over(so_far).alias(last) for last, mark in marks.items()])
    # One row for each context and range: what earlier ranges of the context end with.
    ends = ranged.groupBy("ctx", "range_id").agg(*[F.max(mark).alias(mark) for mark in marks.values()])
    before = Window.partitionBy("ctx").orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("ctx", "range_id", *[F.max(mark).over(before).alias(f"earlier_{mark}") for mark in marks.values()])
    known = within.join(ends, ["ctx", "range_id"])
    for last, mark in marks.items():
        known = known.withColumn(last, F.coalesce(last, f"earlier_{mark}"))
    starts = lined.where("heavy").select("ctx", F.col("start").alias("at"), F.struct("next_id", "value").alias("following"))
    return _cells(known.join(starts, ["ctx", "at"], "left"))


def alias_tables(weights: DataFrame, path: str | None = None, rows: int = ROW_TARGET) -> DataFrame:
    """``ctx, cell, cells, share, own, own_value, other, other_value``, stored.

    A number below ``share`` (drawn evenly from [0, 1)) gives the cell's own
    outcome, any other the ``other`` one. ``weights`` are ``ctx, next_id,
    weight`` (whole and not negative, some positive in each context) and
    ``value``. Contexts of more than ``rows`` outcomes are worked out in pieces.
    """
    totals = weights.groupBy("ctx").agg(F.sum("weight").alias("total"), F.count("*").alias("cells"))
    largest = totals.agg(
        F.coalesce(F.max("cells"), F.lit(0)).alias("cells"),
        F.coalesce(F.max(F.col("total").cast("double") * F.col("cells")), F.lit(0.0)).alias("product"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("rows"),
    ).first()
    whole = "long" if largest.product < 2.0**LONG_BITS else WHOLE
    # Tasks follow the rows, so that their sorts don't outgrow them.
    tasks = -(-largest.rows // TASK_ROWS)
    dealt = lambda outcomes: outcomes.repartition(tasks, "ctx") if tasks > 1 else outcomes
    if largest.cells <= rows:
        return stored(_small_contexts(dealt(weights), whole), "alias_tables", path)
    large = stored(totals.where(F.col("cells") > rows), "large_contexts")
    small = weights.join(large.select("ctx"), "ctx", "left_anti")
    inside = weights.join(large.select("ctx"), "ctx", "left_semi")
    cells = _small_contexts(dealt(small), whole).unionByName(_large_contexts(inside, large, whole, rows))
    return stored(cells, "alias_tables", path)


def draw_tokens(positions: DataFrame, contexts: Contexts, keys: Sequence[str], seed: int,
                tables: DataFrame | None = None, target: int = ROW_TARGET) -> DataFrame:
    """``keys, pos, ctx, next_id, value`` and the context's ``prev_id, c_q, log_z``: a draw for each position.

    ``tables`` are the alias tables of the contexts, if they are built already.
    A draw is one equality join on context and cell. No key of it has more than
    about ``target`` positions: a cell that would is repeated.
    """
    tables = alias_tables(observer_weights(contexts.model, contexts.temperature)) if tables is None else tables
    sizes = tables.where("cell = 0").select(F.col("ctx").alias("id"), "cells")
    unigram_cells = contexts.model.vocabulary_size
    per_context = contexts.table.join(sizes, "id", "left").select("tok", "id", "pick", "cells", "c_q", "log_z")

    total = positions.count()
    counts = stored(positions.groupBy("tok").agg(F.count("*").alias("n")), "scored_tokens") if total > target else None
    picked = frequent_lookup(positions.select(*keys, "pos", "tok"), per_context, "tok", counts, total, target)
    # Numbers of a position follow from its keys: they don't travel to the context.
    picked = picked.withColumns(uniform(seed, keys))
    in_bigram = F.col("part") < F.coalesce("pick", F.lit(0.0))
    placed = picked.withColumns({
        "ctx": F.when(in_bigram, F.col("id")).otherwise(F.lit(UNIGRAM_ID)),
        "cell": F.floor(F.col("place") * F.when(in_bigram, F.col("cells")).otherwise(F.lit(unigram_cells))),
    }).select(*keys, "pos", F.col("id").alias("prev_id"), "c_q", "log_z", "ctx", "cell", "choice")
    split = None
    if counts is not None:
        # Positions that a context sends to each of its cells, on average.
        frequent = counts.join(per_context, "tok").select(F.col("id").alias("ctx"), (F.col("n") / F.col("cells")).alias("each"))
        everything = tables.sparkSession.range(1).select(
            F.lit(UNIGRAM_ID).cast("long").alias("ctx"), F.lit(total / unigram_cells).alias("each")
        )
        crowded = frequent.unionByName(everything).where(F.col("each") > target)
        # Rows that needn't be split carry only the columns that are asked for later.
        if not crowded.isEmpty():
            split = hot_keys(crowded.join(tables.select("ctx", "cell"), "ctx"), ["ctx", "cell"], "each", total, target)
    drawn = salted_lookup(placed, tables.drop("cells"), ["ctx", "cell"], split)
    own = F.col("choice") < F.col("share")
    return drawn.select(
        *keys, "pos", "prev_id", "c_q", "log_z", "ctx",
        F.when(own, F.col("own")).otherwise(F.col("other")).alias("next_id"),
        F.when(own, F.col("own_value")).otherwise(F.col("other_value")).alias("value"),
    )


def sampled_cross_perplexity(positions: DataFrame, contexts: Contexts, keys: Sequence[str], seed: int,
                             median: bool = False, tables: DataFrame | None = None) -> DataFrame:
    """``keys, x_ppl``: the average surprise of the performer at the draws.

    A token drawn after its context brings its probability along. One drawn
    from the unigram part asks, by ids, whether it was ever seen there.
    """
    model = contexts.model
    log_z = F.coalesce("log_z", F.lit(contexts.unseen_log_z))
    is_unigram = F.col("ctx") == UNIGRAM_ID
    asked = lambda value: F.when(is_unigram, value)
    # Only what the two parts need is kept of a draw: its value, or what to ask for.
    drawn = stored(draw_tokens(positions, contexts, keys, seed, tables).select(
        *keys, is_unigram.alias("asks"),
        F.when(~is_unigram, -(F.ln("value") / contexts.temperature - log_z)).alias("nll"),
        asked(F.col("prev_id")).alias("prev_id"), asked(F.col("next_id")).alias("next_id"),
        asked(model.backoff("c_q") * F.col("value")).alias("alone"), asked(log_z).alias("log_z"),
    ), "draws")
    pairs = model.pairs.select("prev_id", "next_id", "prob_q")
    from_unigram = drawn.where("asks").join(pairs, ["prev_id", "next_id"], "left").select(
        *keys, (-(F.ln(F.coalesce("prob_q", "alone")) / contexts.temperature - F.col("log_z"))).alias("nll")
    )
    surprise = drawn.where("NOT asks").select(*keys, "nll").unionByName(from_unigram)
    value = F.median("nll") if median else F.avg("nll")
    return surprise.groupBy(*keys).agg(F.coalesce(value, F.lit(float("nan"))).alias("x_ppl"))
