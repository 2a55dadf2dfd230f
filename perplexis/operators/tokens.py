"""Token tables. One row per text holds the token array until it is exploded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perplexis.functions import text as T
from perplexis.operators.lookup import frequent_lookup
from perplexis.operators.running import row_numbers
from perplexis.sources.workspace import first_row, stored, task_bytes

# Stands for "no next token" in join keys. Tokens are never empty.
END = ""
# Ids of the same, and of any token that a vocabulary doesn't hold. Others run from 1.
END_ID = 0
UNSEEN_ID = -1
# Tokens are counted in tasks of about so many bytes of a stored table: some
# millions of tokens, whose counts a task can hold.
SLICE_BYTES = 32 << 20


def tokenize(texts: DataFrame, keys: Sequence[str], text: str = "text",
             max_tokens: int | None = None) -> DataFrame:
    """``keys, tokens``: one array per text, shortened before anything explodes."""
    return texts.select(*keys, T.tokens(text, max_tokens).alias("tokens"))


def sliced(toks: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``toks``, a stored table, in more and smaller tasks, without a shuffle.

    Counts that are combined before a shuffle stay in memory then; a task of a
    whole split would spill them. Every task reads its split and keeps a slice of its rows.
    """
    n = -(-task_bytes(toks) // slice_bytes)
    if n <= 1:
        return toks
    slice_of = F.pmod(F.xxhash64(F.size("tokens"), F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1))), F.lit(n))
    return reduce(DataFrame.union, [toks.where(slice_of == i) for i in range(n)])


def token_positions(toks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, pos, tok`` with positions from 1. Texts without tokens vanish."""
    return toks.select(*keys, F.posexplode("tokens").alias("i", "tok")).select(
        *keys, (F.col("i") + 1).alias("pos"), "tok"
    )


def token_pairs(toks: DataFrame, *carried: str) -> DataFrame:
    """``carried, pos, tok, next`` with ``next = END`` at the last position.

    The neighbour is read off the array, so no shuffle or sort is needed.
    """
    return toks.select(*carried, "tokens", F.posexplode("tokens").alias("i", "tok")).select(
        *carried,
        (F.col("i") + 1).alias("pos"),
        "tok",
        F.coalesce(F.get("tokens", F.col("i") + 1), F.lit(END)).alias("next"),
    )


def next_token_pairs(toks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, pos, tok, next``; ``next`` is null at the last position."""
    return token_pairs(toks, *keys).withColumn("next", F.nullif(F.col("next"), F.lit(END)))


def pad_batches(toks: DataFrame, order: Sequence[str], batch_size: int, pad: str,
                by: Sequence[str] = ()) -> DataFrame:
    """Consecutive batches of ``batch_size`` texts, padded to their longest one.

    Adds ``batch_id, padded, mask``. ``by`` starts a new series of batches per
    group; ``by`` and ``order`` together are unique and never null. Only keys
    and lengths are numbered; the arrays move once, to meet their numbers.
    """
    keys = [*by, *order]
    sizes = stored(toks.select(*keys, F.size("tokens").alias("_size")), "sizes")
    numbered = row_numbers(sizes, order, by).withColumn(
        "batch_id", F.floor((F.col("row_number") - 1) / batch_size)
    )
    # A window of one batch, whose rows are a fixed number.
    most = F.max("_size").over(Window.partitionBy(*by, "batch_id"))
    fills = numbered.select(*keys, "batch_id", "_size", (most - F.col("_size")).alias("_fill"))
    return toks.join(fills, keys).select(
        *[c for c in toks.columns if c != "tokens"],
        "batch_id",
        F.concat("tokens", F.array_repeat(F.lit(pad), F.col("_fill"))).alias("padded"),
        F.concat(F.array_repeat(F.lit(1), F.col("_size")), F.array_repeat(F.lit(0), F.col("_fill"))).alias("mask"),
    )


def vocabulary(toks: DataFrame) -> DataFrame:
    """``tok, id``: every distinct token, numbered densely from 1 in the order of the tokens."""
    return numbered_vocabulary(toks.select(F.explode("tokens").alias("tok")).distinct())


def numbered_vocabulary(tokens: DataFrame) -> DataFrame:
    """``tokens`` (distinct ``tok`` and more) with ``id``: places come from counts per range and their offsets."""
    return row_numbers(stored(tokens, "vocabulary"), ["tok"]).withColumnRenamed("row_number", "id")


def token_ids(toks: DataFrame, words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``toks`` with ``ids``, the numbers that ``words`` (``tok, id``) gives its tokens.

    A token that ``words`` doesn't hold has ``UNSEEN_ID``. ``keys`` are unique
    and never null; ``toks`` is a stored table. Frequent tokens get their ids where
    the texts are read, so that their places move once, in lists.
    """
    places = toks.select(*keys, F.posexplode("tokens").alias("i", "tok"))
    counts = stored(places.groupBy("tok").agg(F.count("*").alias("n")), "token_counts")
    total = first_row(counts.agg(F.coalesce(F.sum("n"), F.lit(0))))[0]
    found = frequent_lookup(places, words.select("tok", "id"), "tok", counts, total)
    place = F.struct("i", F.coalesce("id", F.lit(UNSEEN_ID)).alias("id"))
    # A group is one text.
    lists = found.groupBy(*keys).agg(F.array_sort(F.collect_list(place))["id"].alias("ids"))
    return toks.join(lists, list(keys), "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))


def vocabulary_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tokens (``tok, id``) that two vocabularies don't share or number differently: ``tok, left_id, right_id``.

    An id is null on the side that lacks the token.
    """
    nothing = F.lit(None).cast("long")
    marked = left.select("tok", F.col("id").cast("long").alias("l"), nothing.alias("r")).unionByName(
        right.select("tok", nothing.alias("l"), F.col("id").cast("long").alias("r"))
    )
    sides = marked.groupBy("tok").agg(F.max("l").alias("left_id"), F.max("r").alias("right_id"))
    return sides.where(~F.col("left_id").eqNullSafe(F.col("right_id")))


def require_same_vocabulary(left: DataFrame, right: DataFrame) -> None:
    """Fails unless both hold the same tokens under the same ids."""
    odd = vocabulary_difference(left, right).first()
    if odd is not None:
        raise ValueError(
            f"The vocabularies differ: token {odd.tok!r} has id {odd.left_id} in the one and {odd.right_id} in the other."
        )
