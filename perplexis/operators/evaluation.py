"""Quality of scores on texts of known origin (class 1 machine, 0 human).

Low scores speak for machine text, so every curve runs over ascending scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.functions.decision import THRESHOLDS, binary_prediction, is_missing
from perplexis.operators.running import running_totals
from perplexis.sources.workspace import stored

# The false-positive rate that experiments report, and the
# decades of the logarithmic axis that curves are read off on.
REPORTED_FPR = 0.01 / 100
LOG_GRID = tuple(10 ** (exponent / 10) for exponent in range(-40, 1))


def evaluation_table(human: DataFrame, machine: DataFrame,
                     threshold: float = THRESHOLDS["accuracy"]) -> DataFrame:
    """``score, class, pred`` out of two tables with a ``score`` column."""
    both = human.select("score", F.lit(0).alias("class")).unionByName(
        machine.select("score", F.lit(1).alias("class"))
    )
    return both.withColumn("pred", binary_prediction(F.col("score"), threshold))


def confusion(table: DataFrame) -> DataFrame:
    return table.groupBy("class", "pred").agg(F.count("*").alias("n"))


def _f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))


def f1(table: DataFrame) -> DataFrame:
    tp = F.count_if((F.col("class") == 1) & (F.col("pred") == 1))
    fp = F.count_if((F.col("class") == 0) & (F.col("pred") == 1))
    fn = F.count_if((F.col("class") == 1) & (F.col("pred") == 0))
    return table.agg(
        _f1_of(tp, fp, fn).alias("f1"),
        F.count("*").alias("n"),
        F.count_if(is_missing("score")).alias("n_missing"),
    )


def cumulative_counts(table: DataFrame, path: str | None = None) -> DataFrame:
    """``score, pos, neg, tp, fp, range_id`` per distinct score, stored.

    ``tp`` and ``fp`` count the rows up to and with this score. Missing scores
    have no place in the order and are left out. ``range_id`` numbers stretches
    of the order.
    """
    groups = table.where(~is_missing("score")).groupBy("score").agg(
        F.count_if(F.col("class") == 1).alias("pos"), F.count_if(F.col("class") == 0).alias("neg")
    )
    counted = running_totals(
        stored(groups, "score_groups"), ["score"], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    return stored(counted, "cumulative_counts", path)


def _class_sizes(cumulative: DataFrame) -> tuple[int, int]:
    row = cumulative.agg(
        F.coalesce(F.max("tp"), F.lit(0)).alias("p"), F.coalesce(F.max("fp"), F.lit(0)).alias("n")
    ).first()
    return row.p, row.n


def _rate(count: Column, size: int) -> Column:
    return count / F.lit(float(size)) if size else F.lit(float("nan"))


def _points(cumulative: DataFrame) -> DataFrame:
    p, n = _class_sizes(cumulative)
    points = cumulative.select(
        (-F.col("score")).alias("threshold"), "fp", "tp",
        _rate(F.col("fp"), n).alias("fpr"), _rate(F.col("tp"), p).alias("tpr"),
    )
    return points.unionByName(_origin(points))


def _origin(points: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return points.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), zero.alias("fp"), zero.alias("tp"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )


def roc_curve(cumulative: DataFrame) -> DataFrame:
    """``threshold, fp, tp, fpr, tpr``; thresholds are negated scores, from infinity."""
    return _points(cumulative)


def roc_curve_thin(cumulative: DataFrame) -> DataFrame:
    """The curve without the points that lie inside a straight run.

    A point stays when the next step differs from its own, or when it is the
    first or the last one.
    """
    p, n = _class_sizes(cumulative)
    ranged = cumulative.withColumn("step", F.struct("pos", "neg"))
    # One row for each range of a million scores or so.
    heads = ranged.groupBy("range_id").agg(F.min_by("step", "score").alias("head"))
    heads = heads.select("range_id", F.lead("head").over(Window.orderBy("range_id")).alias("head"))
    inside = Window.partitionBy("range_id").orderBy("score")
    stepped = ranged.withColumn("following", F.lead("step").over(inside)).join(heads, "range_id").withColumn("following", F.coalesce("following", "head"))
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    kept = stepped.where(is_first | F.col("following").isNull() | (F.col("following") != F.col("step")))
    points = kept.select(
        (-F.col("score")).alias("threshold"), "fp", "tp",
        _rate(F.col("fp"), n).alias("fpr"), _rate(F.col("tp"), p).alias("tpr"),
    )
    return points.unionByName(_origin(points))


def _auc(p: int, n: int) -> Column:
    """Aggregate: trapezoids of width neg/n and mean height (tp - pos/2)/p."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return _rate(area, p * n)


def roc_auc(cumulative: DataFrame) -> DataFrame:
    return cumulative.agg(_auc(*_class_sizes(cumulative)).alias("auc"))


def roc_auc_rank(cumulative: DataFrame) -> DataFrame:
    """The same area out of the rank sum of machine scores; ties get mid-ranks."""
    p, n = _class_sizes(cumulative)
    rank = F.col("tp") + F.col("fp") - (F.col("pos") + F.col("neg") - 1) / 2
    above = F.sum(F.col("pos") * rank) - F.lit(p * (p + 1) / 2)
    return cumulative.agg((1 - _rate(above, p * n)).alias("auc"))


def _interpolated(x: Column, left: Column, right: Column) -> Column:
    slope = (right["tpr"] - left["tpr"]) / (right["fpr"] - left["fpr"])
    return F.when(right.isNull(), left["tpr"]).otherwise(left["tpr"] + slope * (x - left["fpr"]))


def tpr_at(cumulative: DataFrame, rates: Sequence[float]) -> DataFrame:
    """``fpr, tpr``: the curve read off at the given rates, linear between points.

    Among points of equal ``fpr`` the highest counts on the left and the lowest
    on the right. One pass sorts the points into the gaps between the rates and
    keeps two per gap; the rest works on one row per rate.
    """
    grid = sorted(rates)
    spark = cumulative.sparkSession
    slot = sum((F.col("fpr") > F.lit(x)).cast("int") for x in grid)
    point = F.struct("fpr", "tpr")
    gaps = _points(cumulative).groupBy(slot.alias("slot")).agg(
        F.max(point).alias("upper"), F.min(point).alias("lower")
    )
    slots = spark.createDataFrame(
        [*enumerate(grid), (len(grid), None)], "slot int, x double"
    ).join(F.broadcast(gaps), "slot", "left")
    order = Window.orderBy("slot")
    return slots.select(
        F.col("x").alias("fpr"),
        F.max("upper").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("l"),
        F.min("lower").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("r"),
    ).where(F.col("fpr").isNotNull()).select(
        "fpr", _interpolated(F.col("fpr"), F.col("l"), F.col("r")).alias("tpr")
    )


def tpr_at_fpr(cumulative: DataFrame, rate: float = REPORTED_FPR) -> DataFrame:
    return tpr_at(cumulative, [rate])


def roc_log_grid(cumulative: DataFrame) -> DataFrame:
    return tpr_at(cumulative, LOG_GRID)


def evaluation_metrics(table: DataFrame, cumulative: DataFrame, rate: float = REPORTED_FPR) -> DataFrame:
    """One row: ``n, n_missing, f1, auc, tpr_at_fpr``."""
    areas = cumulative.agg(_auc(*_class_sizes(cumulative)).alias("auc"))
    reading = tpr_at_fpr(cumulative, rate).select(F.col("tpr").alias("tpr_at_fpr"))
    rows = f1(table).unionByName(areas, allowMissingColumns=True).unionByName(
        reading, allowMissingColumns=True
    )
    return rows.agg(*[F.max(c).alias(c) for c in ("n", "n_missing", "f1", "auc", "tpr_at_fpr")])


def _candidates(cumulative: DataFrame) -> tuple[DataFrame, int, int]:
    """Thresholds with the counts strictly below them.

    Each distinct score is one: it leaves out its own rows, which the next
    score includes. Infinity includes everything.
    """
    p, n = _class_sizes(cumulative)
    at_scores = cumulative.select(
        F.col("score").alias("threshold"),
        (F.col("tp") - F.col("pos")).alias("tp"), (F.col("fp") - F.col("neg")).alias("fp"),
    )
    everything = cumulative.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"),
        F.lit(p).cast("long").alias("tp"), F.lit(n).cast("long").alias("fp"),
    )
    return at_scores.unionByName(everything), p, n


def calibrate_f1(cumulative: DataFrame) -> DataFrame:
    """``threshold, f1``: the smallest threshold with the highest F1."""
    candidates, p, _ = _candidates(cumulative)
    value = _f1_of(F.col("tp"), F.col("fp"), F.lit(p) - F.col("tp"))
    best = candidates.agg(F.max(F.struct(value.alias("f1"), (-F.col("threshold")).alias("minus"))).alias("b"))
    return best.select((-F.col("b.minus")).alias("threshold"), F.col("b.f1").alias("f1"))


def calibrate_fpr(cumulative: DataFrame, limit: float = REPORTED_FPR) -> DataFrame:
    """The largest threshold whose false-positive rate keeps to ``limit``.

    With fewer than 1/limit human texts this means no false positive at all, so
    the row also says how many there were and which rate is reached.
    """
    candidates, _, n = _candidates(cumulative)
    rated = candidates.withColumn("fpr", _rate(F.col("fp"), n))
    best = rated.where(F.col("fpr") <= limit).agg(F.max(F.struct("threshold", "fpr")).alias("b"))
    return best.select(
        F.lit(limit).alias("fpr_limit"), F.lit(n).cast("long").alias("n_human"),
        F.col("b.threshold").alias("threshold"), F.col("b.fpr").alias("fpr"),
    )
