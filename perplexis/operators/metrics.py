"""Per-position values, perplexity, cross-perplexity and the document score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perplexis.operators.lookup import ROW_TARGET, frequent_lookup, hot_keys, salted_lookup
from perplexis.operators.model import Contexts
from perplexis.operators.tokens import END
from perplexis.sources.workspace import first_row, stored

# The most frequent token pairs are looked up by broadcast: those with more than
# 1/HOT_PAIRS of all positions, and as many others as keep to HOT_PAIRS rows of
# three numbers. How many pairs are above each of these counts is known.
HOT_PAIRS = 1 << 20
ABOVE = sorted(x << i for i in range(32) for x in (2, 3))


def pair_key(seed: int | Column) -> Column:
    """A pair of tokens as one number, however long they are."""
    return F.xxhash64(F.lit(seed) if isinstance(seed, int) else seed, "tok", "next")


def pair_metrics(positions: DataFrame, contexts: Contexts, path: str | None = None) -> DataFrame:
    """``tok, next, pair, seed, n, nll, h`` for each distinct pair of ``positions``, stored.

    The seed and the sum of ``n`` are also in the metadata of ``pair``, and how
    many pairs have more than each of ``ABOVE`` in that of ``n``.

    The texts are reduced to distinct pairs (combined before the shuffle), and
    only those meet the dictionary, then the model by ids. Pairs, contexts and
    tokens never seen in training get their backed-off values.
    """
    model = contexts.model
    types = positions.groupBy(F.col("tok").alias("prev"), "next").agg(F.count("*").alias("n"))
    counted = stored(types, "counted_pairs")
    prevs = contexts.table.select(F.col("tok").alias("prev"), F.col("id").alias("prev_id"), "c_q", "h", "log_z")
    nexts = contexts.table.select(F.col("tok").alias("next"), F.col("id").alias("next_id"), F.col("n_q").alias("w_q"))
    joined, total = counted, counted.count()
    for side, table in (("prev", prevs), ("next", nexts)):
        counts = stored(counted.groupBy(side).agg(F.count("*").alias("n")), "counts") if total > ROW_TARGET else counted
        joined = frequent_lookup(joined, table, side, counts, total)
    joined = joined.join(model.pairs.select("prev_id", "next_id", "n_q"), ["prev_id", "next_id"], "left")
    prob = model.conditional("n_q", "c_q", model.unigram("q", "w_q"))
    metrics = _valued(joined.withColumn("prob_q", prob), contexts, counted)
    out = stored(metrics, "pair_metrics", path)
    return out.withColumns({c: F.col(c).alias(c, metadata=metrics.schema[c].metadata) for c in ("pair", "n")})


def trained_pair_metrics(contexts: Contexts, path: str | None = None) -> DataFrame:
    """The same for the pairs of the training corpora, which are counted already.

    Enough for texts that the models were trained on as a whole. Without a path
    nothing is stored: the values follow from the model's tables where they are asked for.
    """
    model = contexts.model
    prevs = contexts.table.select(F.col("id").alias("prev_id"), "h", "log_z")
    counted = model.pairs.select("prev_id", "prev", "next", "n", "prob_q")
    joined = frequent_lookup(counted, prevs, "prev_id", model.prev_counts, model.pair_types)
    metrics = _valued(joined, contexts, counted)
    return metrics if path is None else stored(metrics, "pair_metrics", path)


def _valued(pairs: DataFrame, contexts: Contexts, counted: DataFrame) -> DataFrame:
    """``pairs`` with their values, named by numbers of which no two of ``counted`` (the same, read at little cost) share one."""
    log_z = F.coalesce("log_z", F.lit(contexts.unseen_log_z))
    nll = -(F.ln("prob_q") / contexts.temperature - log_z)
    values = pairs.select(
        F.col("prev").alias("tok"), "next", "n",
        F.when(F.col("next") != END, nll).alias("nll"),
        F.coalesce("h", F.lit(contexts.unseen_h)).alias("h"),
    )
    total, *above = first_row(counted.agg(F.coalesce(F.sum("n"), F.lit(0)), *[F.count_if(F.col("n") > x) for x in ABOVE]))
    words, seed = counted.select(F.col("prev").alias("tok"), "next"), 0
    # It nearly always holds at once that no two share a number.
    while first_row(words.groupBy(pair_key(seed)).agg(F.count("*").alias("pairs")).where("pairs > 1")) is not None:
        seed += 1
    named = values.withColumns({"pair": pair_key(seed), "seed": F.lit(seed)})
    known = {"pair": {"seed": seed, "total": total}, "n": {"above": above}}
    return named.withColumns({c: F.col(c).alias(c, metadata=m) for c, m in known.items()})


def _hot_count(metrics: DataFrame, total: int, hot_pairs: int) -> float:
    """Pairs of more positions than this are at most ``hot_pairs``."""
    share = total / hot_pairs
    above = metrics.schema["n"].metadata.get("above")
    return min([share, *[x for x, pairs in zip(ABOVE, above, strict=True) if pairs <= hot_pairs]]) if above else share


def token_metrics(positions: DataFrame, metrics: DataFrame, keys: Sequence[str],
                  hot_pairs: int = HOT_PAIRS, target: int = ROW_TARGET) -> DataFrame:
    """``keys, pos, tok, nll, h``; ``nll`` is null at the last position.

    Positions meet the values by the number of their pair, which no two pairs
    of ``metrics`` share. Frequent pairs never shuffle: their values are broadcast,
    and a following aggregate per text combines them where the text is read. The
    rest goes through a shuffled join, in which pairs of more than ``target``
    positions are split. A pair without values fails the query rather than losing
    its position.
    """
    known = metrics.schema["pair"].metadata
    if not known:
        first = metrics.select("seed").first()
        known = {"seed": first.seed if first else 0, "total": metrics.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]}
    total = known["total"]
    numbered = positions.withColumn("pair", pair_key(known["seed"]))
    most = _hot_count(metrics, total, hot_pairs)
    is_hot = F.col("n") > most
    values = metrics.select("pair", "n", "nll", "h")
    hot = stored(values.where(is_hot).drop("n"), "hot_pairs")
    cold = values.where(~is_hot)
    frequent = numbered.join(F.broadcast(hot), "pair")
    others = numbered.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
    # No cold pair has more positions than that. Rows that needn't be split
    # carry only the columns that are asked for later.
    split = hot_keys(cold, "pair", "n", total, target) if most > target else None
    rare = salted_lookup(others, cold.drop("n"), "pair", split)
    rare = rare.withColumn("h", F.coalesce("h", F.raise_error(F.lit("token pair without values"))))
    return frequent.unionByName(rare).select(*keys, "pos", "tok", "nll", "h")


def _nan_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(float("nan")))


def _unmasked_h(mask_tokens: Sequence[str]) -> Column:
    """Padding is told by the token itself, so a real one inside a text counts."""
    return F.when(~F.col("tok").isin(*mask_tokens), F.col("h")) if mask_tokens else F.col("h")


def perplexity(median: bool = False) -> Column:
    """Aggregate: mean or NaN-ignoring median of ``nll``. A log value."""
    nll = F.col("nll")
    value = F.median(F.when(~F.isnan(nll), nll)) if median else F.avg(nll)
    return _nan_if_null(value)


def cross_perplexity(median: bool = False, mask_tokens: Sequence[str] = ()) -> Column:
    """Aggregate: mean or NaN-ignoring median of ``h`` over unmasked positions."""
    h = _unmasked_h(mask_tokens)
    value = F.median(F.when(~F.isnan(h), h)) if median else F.avg(h)
    return _nan_if_null(value)


def ratio(ppl: Column, x_ppl: Column) -> Column:
    """Floating-point division: x/0 is infinite and 0/0 is NaN."""
    by_zero = F.when((ppl > 0) & ~F.isnan(ppl), F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.coalesce(F.try_divide(ppl, x_ppl), by_zero)


def document_scores(metrics: DataFrame, keys: Sequence[str], median: bool = False,
                    mask_tokens: Sequence[str] = ()) -> DataFrame:
    """``keys, n_tokens, ppl, x_ppl, score`` out of any per-position table.

    The table may come from another model altogether: it needs the keys, tok,
    nll (null at the last position only) and h. A text has one last position: keys
    under which there are several are shared by texts and fail the query.
    """
    text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    shared = F.raise_error(F.concat(F.lit("Several texts have the key "), text))
    return (
        metrics.groupBy(*keys)
        .agg(
            F.count("*").alias("n_tokens"),
            F.count_if(F.col("nll").isNull()).alias("_ends"),
            perplexity(median).alias("ppl"),
            cross_perplexity(median, mask_tokens).alias("x_ppl"),
        )
        .withColumn("score", F.when(F.col("_ends") > 1, shared.cast("double")).otherwise(ratio(F.col("ppl"), F.col("x_ppl"))))
        .drop("_ends")
    )
