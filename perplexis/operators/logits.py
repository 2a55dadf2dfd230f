"""Metrics of positions whose logits are given: one array for each model and position.

An array may be cut short to some tokens. What the others hold is given as a
tail: the logarithm of the sum of their exponentials, and how many they are. They
count as alike, so that a temperature, which the tail alone can't follow, acts on
their mean logit. Both arrays of a position list the same tokens in the same
order. All of it is expressions over arrays: no row is exploded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logits:
    """Logits of one model over listed tokens; ``tail`` is null where nothing else remains."""

    values: Column
    tail: Column
    tail_size: Column
    temperature: float = 1.0

    @property
    def each(self) -> Column:
        """Logit over temperature of each token in the tail."""
        return F.when(self.tail_size > 0, (self.tail - F.ln(self.tail_size)) / self.temperature)

    @property
    def scaled(self) -> Column:
        return F.transform(self.values, lambda x: x / self.temperature)

    def log_sum_exp(self) -> Column:
        """Logarithm of the normaliser, from the greatest logit up, so that nothing overflows."""
        top = F.greatest(F.array_max(self.scaled), self.each)
        listed = F.aggregate(self.scaled, F.lit(0.0), lambda total, x: total + F.exp(x - top))
        rest = F.coalesce(self.tail_size * F.exp(self.each - top), F.lit(0.0))
        return top + F.ln(listed + rest)


def log_softmax(logits: Logits, normaliser: Column) -> Column:
    """Log-probabilities of the listed tokens; ``normaliser`` is a column of ``log_sum_exp``."""
    return F.transform(logits.scaled, lambda x: x - normaliser)


def negative_log_likelihood(logits: Logits, normaliser: Column, label: Column) -> Column:
    """Of the token at place ``label`` (from 0); a negative place means one in the tail; null gives null."""
    return F.when(label >= 0, normaliser - F.get(logits.scaled, label)).when(label < 0, normaliser - logits.each)


def cross_entropy(observer: Logits, performer: Logits, over_p: Column, over_q: Column) -> Column:
    """Of the performer under the observer, whose normalisers are ``over_p`` and ``over_q``."""
    pairs = F.zip_with(observer.scaled, performer.scaled, lambda p, q: F.exp(p - over_p) * (over_q - q))
    listed = F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)
    rest = observer.tail_size * F.exp(observer.each - over_p) * (over_q - performer.each)
    return listed + F.coalesce(rest, F.lit(0.0))


def logit_metrics(rows: DataFrame, keys: Sequence[str], temperature: float = 1.0) -> DataFrame:
    """``keys, pos, tok, nll, h`` out of logits, as ``document_scores`` takes them.

    ``rows`` have the keys, ``pos``, ``tok``, ``label`` (place of the next token
    in the lists, negative in the tail, null at the last position), ``observer``
    and ``performer`` (arrays), ``observer_tail``, ``performer_tail`` and
    ``tail_size`` (null or 0 for lists that are whole).
    """
    if not temperature > 0:
        raise ValueError("temperature must be positive")
    size = F.coalesce(F.col("tail_size"), F.lit(0))
    p, q = (Logits(F.col(r), F.col(f"{r}_tail"), size, temperature) for r in ("observer", "performer"))
    over_p, over_q = F.col("_over_p"), F.col("_over_q")
    sized = rows.select("*", p.log_sum_exp().alias("_over_p"), q.log_sum_exp().alias("_over_q"))
    return sized.select(
        *keys, "pos", "tok", negative_log_likelihood(q, over_q, F.col("label")).alias("nll"),
        cross_entropy(p, q, over_p, over_q).alias("h"),
    )
