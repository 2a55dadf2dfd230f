"""Left join to a table with unique keys, safe against hot keys of any kind and length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys with more rows than this are split.
ROW_TARGET = 1 << 22
# The list of such keys is broadcast, as 64-bit hashes: it has fewer than this
# many rows of 12 bytes, since beyond it the target rises with the data.
HOT_KEYS = 1 << 17
# Keys with more than 1/FREQUENT of all rows are looked up by broadcast: fewer
# than FREQUENT rows of a few numbers, and far fewer where some keys are much
# more frequent than that, as words are.
FREQUENT = 1 << 20

Keys = str | Sequence[str]


def _names(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hot_keys(counts: DataFrame, key: Keys, count: str, total: int, target: int = ROW_TARGET) -> DataFrame | None:
    """``_hot, salts`` of the keys with more than ``target`` rows; ``None`` if there can't be any.

    ``counts`` has one row per key, and its counts sum up to ``total``. A piece
    of a hot key holds about ``target`` rows. Keys are listed by their hash: two
    that share one are split alike, which changes no result.
    """
    share = max(target, total / HOT_KEYS)
    if total <= share:
        return None
    return counts.where(F.col(count) > share).groupBy(F.xxhash64(*_names(key)).alias("_hot")).agg(
        F.ceil(F.max(count) / F.lit(float(share))).cast("int").alias("salts")
    )


def hot_keys_of(rows: DataFrame, key: Keys, target: int = ROW_TARGET) -> DataFrame | None:
    """The same, counted from the rows themselves (combined before the shuffle)."""
    total = rows.count()
    if total <= target:
        return None
    return hot_keys(rows.groupBy(*_names(key)).agg(F.count("*").alias("n")), key, "n", total, target)


def frequent_lookup(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame, total: int,
                    target: int = ROW_TARGET, most: int = FREQUENT) -> DataFrame:
    """``rows`` left-joined to ``table`` on ``key``; rows of frequent keys don't shuffle.

    ``counts`` has the key and ``n``, its rows, of ``total`` in all; few rows
    are joined as they are. What is frequent is broadcast to where the rows are
    read; they are read twice, so hand in a stored table or what is cheap to get.
    """
    if total <= target:
        return rows.join(table, key, "left")
    often = counts.where(F.col("n") > total / most).select(key)
    known = often.join(F.broadcast(table.join(F.broadcast(often), key)), key, "left")
    others = rows.join(F.broadcast(often), key, "left_anti")
    # No key left has more than 1/most of the rows.
    hot = hot_keys(counts.where(F.col("n") <= total / most), key, "n", total, target) if total / most > target else None
    rare = salted_lookup(others, table, key, hot)
    return rows.join(F.broadcast(known), key).unionByName(rare)


def salted_lookup(rows: DataFrame, table: DataFrame, key: Keys, hot: DataFrame | None) -> DataFrame:
    """``rows`` left-joined to ``table`` on ``key``.

    The rows of a hot key are dealt to its salts, and its one table row is
    repeated once per salt. Any other key has one salt.
    """
    names = _names(key)
    if hot is None:
        return rows.join(table, names, "left")
    known = F.broadcast(hot.withColumnRenamed("salts", "_salts"))

    def listed(df: DataFrame) -> DataFrame:
        return df.withColumn("_hot", F.xxhash64(*names)).join(known, "_hot", "left").drop("_hot")

    dealt = F.pmod(F.xxhash64(*rows.columns), "_salts").cast("int")
    salted_rows = listed(rows).withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(dealt)).drop("_salts")
    salted_table = listed(table).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return salted_rows.join(salted_table, [*names, "_salt"], "left").drop("_salt")
