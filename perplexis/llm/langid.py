"""Language of a text: averaged hashed subword embeddings under a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of a text in lower case, hashed to
``BUCKETS``. A text is the mean of their embeddings; a linear layer with softmax
gives the languages. Both are trained by stochastic gradient descent in numpy.
Afterwards embeddings and layer fold into one table of a logit per bucket and
language, which is the same function: the mean of a linear map.

The classifier learns from a bounded sample, the ``PER_LANG`` rows of least hash
of each language and ``SAMPLE`` at most, of which every fifth is held back to
calibrate: a temperature that makes the softmax a probability, and the least
score under which a prediction counts as rejected. Their subword counts are
gathered, not their texts. Every text is then scored whole.

Defined results: ``und`` with score 0 for a null text, one without a letter,
and if nothing was learned; a letter is a character of Unicode's letter
categories. Repeated rows score alike. An empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perplexis.llm import columns

BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 8
RATE = 0.5
PER_LANG = 500
SAMPLE = 4000
PARTS = 64
REJECTED_GOOD = 0.005
UNKNOWN = "und"
SEED = 11


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of subword: text and bucket of every subword."""
    low = columns.LOWER[data].astype(np.uint32)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = low
    for n in (2, 3, 4):
        if len(data) < n:
            return
        code = code[:-1] | (low[n - 1 :] << np.uint32(8 * (n - 1)))
        within = owner[: len(code)] == owner[n - 1 :]
        bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        yield owner[: len(code)][within], bucket[within]


class Model(NamedTuple):
    langs: list[str]
    table: np.ndarray  # bucket, language: logits, to be averaged
    bias: np.ndarray
    temperature: float
    least: float

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and its probability for each text."""
        data, offsets = columns.flat(texts)
        n = len(offsets) - 1
        logits, counts = np.zeros((n, len(self.langs))), np.zeros(n)
        for owner, bucket in subwords(data, offsets):
            counts += np.bincount(owner, minlength=n)
            for lang in range(len(self.langs)):
                logits[:, lang] += np.bincount(owner, weights=self.table[bucket, lang], minlength=n)
        logits = logits / np.maximum(counts, 1)[:, None] + self.bias
        chances = softmax(logits / self.temperature)
        best = chances.argmax(axis=1)
        return best, chances[np.arange(n), best]


def softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def train(buckets: list[np.ndarray], counts: list[np.ndarray], langs: list[str]) -> Model | None:
    """``buckets`` and ``counts`` of each text's subwords, and its language."""
    names = sorted(set(langs))
    if not names:
        return None
    y = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(SEED)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(names))), np.zeros(len(names))
    held = np.arange(len(y)) % 5 == 4
    shares = [c / max(1, c.sum()) for c in counts]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(np.flatnonzero(~held)):
            mean = shares[i] @ embeddings[buckets[i]]
            error = softmax(mean @ layer + bias)
            error[y[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # The mean spreads a text's gradient thinly; the size of the text restores it.
            embeddings[buckets[i]] -= rate * 50 * np.outer(shares[i], back)
    table = embeddings @ layer
    calibrating = np.flatnonzero(held) if held.any() else np.arange(len(y))
    logits = np.array([s @ table[b] for s, b in ((shares[i], buckets[i]) for i in calibrating)]) + bias
    right = np.arange(len(calibrating)), y[calibrating]
    grid = np.geomspace(0.05, 20, 60)
    temperature = min(grid, key=lambda t: -np.log(softmax(logits / t)[right] + 1e-12).mean())
    chances = softmax(logits / temperature)
    good = np.sort(chances.max(axis=1)[chances.argmax(axis=1) == y[calibrating]])
    least = float(good[int(REJECTED_GOOD * len(good))]) if len(good) else 1.0
    return Model(names, table, bias, float(temperature), least)


def learn(
    df: DataFrame, key: str, text: str, lang: str, per_lang: int = PER_LANG, sample: int = SAMPLE
) -> Model | None:
    """The model of a bounded sample of the rows of ``df`` that have a language."""
    rows = df.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull())
    by_hash = [F.xxhash64(key, F.lit(SEED)), F.col(key)]
    chosen = (
        rows.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), by_hash[0].alias("_hash"))
        # Parts of a language are ranked side by side, so that the last ranking sees few of its rows.
        .withColumn("_part", F.pmod(F.xxhash64("_key"), F.lit(PARTS)))
        .withColumn("_place", F.row_number().over(Window.partitionBy("_lang", "_part").orderBy("_hash", "_key")))
        .where(F.col("_place") <= per_lang)
        .withColumn("_place", F.row_number().over(Window.partitionBy("_lang").orderBy("_hash", "_key")))
        .where(F.col("_place") <= per_lang).orderBy("_place", "_hash", "_key").limit(sample)
    ).select("_key").distinct()
    taken = rows.select(F.col(key).alias("_key"), F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "_text"):
                data, offsets = columns.flat(part.column(2))
                found = list(subwords(data, offsets))
                code = [o.astype(np.int64) * BUCKETS + b for o, b in found]
                code, count = np.unique(np.concatenate(code) if code else np.zeros(0, np.int64), return_counts=True)
                at = np.searchsorted(code, np.arange(part.num_rows + 1) * BUCKETS)
                lists = [
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32()))
                    for x in (code % BUCKETS, count)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=["_key", "_lang", "b", "c"])

    kind = taken.schema["_key"].dataType.simpleString()
    found = (
        taken.join(F.broadcast(chosen), "_key", "left_semi")
        .mapInArrow(run, f"_key {kind}, _lang string, b array<int>, c array<int>")
        .orderBy(F.xxhash64("_key"), "_key", "_lang", F.xxhash64("b", "c")).limit(sample).toArrow()
    )
    lists = [[x.values.to_numpy() for x in found[c].combine_chunks()] for c in ("b", "c")]
    return train(*lists, found["_lang"].to_pylist())


def predict(df: DataFrame, keep: list[str], text: str, model: Model | None) -> DataFrame:
    """Columns ``keep`` and ``lang_pred, score, rejected`` for every row."""
    rows = df.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "_text"):
                texts = part.column(part.num_columns - 1)
                n = part.num_rows
                best, score = model.predict(texts) if model else (np.zeros(n, int), np.zeros(n))
                known = has_letter(texts) & (model is not None)
                langs = np.array(model.langs if model else [UNKNOWN], object)[best]
                score = np.where(known, np.clip(score, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(np.where(known, langs, UNKNOWN), pa.string()),
                     pa.array(score), pa.array(score < (model.least if model else 1.0))],
                    names=[*keep, "lang_pred", "score", "rejected"],
                )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, "lang_pred string", "score double", "rejected boolean"]))
