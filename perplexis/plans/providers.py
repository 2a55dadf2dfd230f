"""Where per-position values come from: the trained models, or any other pair of models.

A provider turns texts into rows of ``keys, pos, tok, nll, h``: position from 1,
token, negative log-likelihood of the next token under the performer (null at
the last position) and cross-entropy of the performer under the observer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from perplexis.operators.metrics import pair_metrics, token_metrics
from perplexis.operators.model import Contexts
from perplexis.operators.tokens import require_same_vocabulary, sliced, token_pairs, tokenize
from perplexis.sources.workspace import stored

VALUES = {"pos": pa.int32(), "tok": pa.string(), "nll": pa.float64(), "h": pa.float64()}
_SQL = {"pos": "int", "tok": "string", "nll": "double", "h": "double"}

Batches = Iterator[pa.RecordBatch]


class Provider(Protocol):
    """Models behind a scorer."""

    @property
    def spark(self) -> SparkSession: ...

    def token_metrics(self, texts: DataFrame, keys: Sequence[str], text: str, max_tokens: int | None) -> DataFrame: ...


@dataclass(frozen=True)
class TrainedModels:
    """The bigram models, whose two sides share one dictionary."""

    contexts: Contexts

    @property
    def spark(self) -> SparkSession:
        return self.contexts.table.sparkSession

    def token_metrics(self, texts: DataFrame, keys: Sequence[str], text: str, max_tokens: int | None) -> DataFrame:
        """The tokens are stored: they are read three times."""
        toks = stored(tokenize(texts, keys, text, max_tokens), "tokens")
        pairs = pair_metrics(token_pairs(sliced(toks), *keys), self.contexts)
        return token_metrics(token_pairs(toks, *keys), pairs, keys)


@dataclass(frozen=True)
class ArrowModels:
    """Two models behind a function over Arrow batches, run where the texts are read.

    ``values`` gets batches of ``keys, text`` and yields batches of the keys (as
    they came) and ``VALUES``, any number of rows for each text. It is given the
    token window as its second argument. ``observer`` and ``performer`` are the
    vocabularies of the two models (``tok, id``), which must be the same.
    """

    values: Callable[[Batches, int | None], Batches]
    observer: DataFrame
    performer: DataFrame
    checked: bool = field(default=False, repr=False)

    def __post_init__(self):
        if not self.checked:
            require_same_vocabulary(self.observer, self.performer)

    @property
    def spark(self) -> SparkSession:
        return self.observer.sparkSession

    def token_metrics(self, texts: DataFrame, keys: Sequence[str], text: str, max_tokens: int | None) -> DataFrame:
        rows = texts.select(*keys, texts[text].cast("string").alias("text"))
        kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
        values, expected = self.values, [*keys, *VALUES]

        def run(batches: Batches) -> Batches:
            for batch in values(batches, max_tokens):
                yield _as_declared(batch, expected)

        return rows.mapInArrow(run, ", ".join([*kinds, *(f"{n} {k}" for n, k in _SQL.items())]))


def _as_declared(batch: pa.RecordBatch, expected: list[str]) -> pa.RecordBatch:
    """The batch with its columns in order, or an error that says what is wrong with it."""
    if sorted(batch.schema.names) != sorted(expected):
        raise ValueError(f"The models must yield the columns {expected}, not {batch.schema.names}.")
    batch = batch.select(expected)
    for name, kind in VALUES.items():
        if batch.schema.field(name).type != kind:
            raise ValueError(f"Column {name!r} must be {kind}, not {batch.schema.field(name).type}.")
    return batch
