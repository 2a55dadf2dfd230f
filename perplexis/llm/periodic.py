"""Runs of words that repeat with a period, by seeds on diagonals that are extended.

A run is a stretch of consecutive words with smallest period q, at least
``times`` periods and ``least`` words long, that can't be made longer. Laid over
itself at lag q it agrees on its length less q: at least ``max(least - q,
(times - 1) * q)`` words. So lags are taken in classes ``[m, 2m)``, and for each
class k is the least agreement that its lags guarantee. Every run then holds a
k-gram that comes again q words later.

The k-grams of a text are indexed by exact names (a name for each distinct gram,
doubled in length by naming pairs of names), and only grams that occur twice are
carried on to greater lengths. Pairs are each occurrence with the next one of
its gram. That is enough: since k is at least q, a gram that came again sooner
than q within the run would give the run a smaller period. For the same reason
a pair's lag is the smallest period of the stretch that it is extended to. A
pair is a seed on the diagonal of its lag; it is extended to both sides word by
word, and the table of how far each lag is covered skips the seeds behind.

Texts are a map over rows: nothing shuffles, and memory follows the longest text
or ``columns.PIECE_BYTES``. Defined results: null, empty and blank texts have no
words and no runs; repeated rows count each; the key is passed through with its
own type, nulls included. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.llm.debruijn import kept_words

LEAST = 6
TIMES = 4
RUN = ("start", "length", "period")


def agreement(lag: int, least: int, times: int) -> int:
    """Words on which any run with a period in ``[lag, 2 * lag)`` agrees with itself."""
    # One side falls with the period, the other rises: the least is near where they cross.
    return min(max(least - q, (times - 1) * q) for q in range(lag, min(2 * lag, max(lag, least) + 1)))


class Grams:
    """Names of the grams that occur twice or more in one text, of growing length.

    ``words`` are codes that are equal only for equal words of one text.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.length = 1
        self.at, self.names = self._again(np.arange(self.n), words)

    @staticmethod
    def _again(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
        names = names.reshape(-1)
        twice = counts[names] > 1
        return at[twice], names[twice].astype(np.int64)

    def longer(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, names)`` of the repeated grams of this length, at most twice the present one."""
        if length == self.length or not len(self.at):
            return self.at, self.names
        everywhere = np.full(self.n, -1, np.int64)
        everywhere[self.at] = self.names
        second = self.at + (length - self.length)
        inside = second < self.n
        follows = np.where(inside, everywhere[np.minimum(second, self.n - 1)], -1)
        some = follows >= 0
        return self._again(self.at[some], self.names[some] * (self.names.max() + 1) + follows[some])

    def grow_to(self, length: int) -> None:
        """To the greatest power of two that isn't above ``length``."""
        while 2 * self.length <= length:
            self.at, self.names = self.longer(2 * self.length)
            self.length *= 2


def agree_until(words: np.ndarray, at: int, lag: int) -> int:
    """First position from ``at`` whose word differs from the one ``lag`` words on."""
    step, end = 32, len(words) - lag
    while at < end:
        to = min(at + step, end)
        differ = np.flatnonzero(words[at:to] != words[at + lag : to + lag])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return end


def agree_from(words: np.ndarray, at: int, lag: int) -> int:
    """The same to the left: least position from which on all agree up to ``at``."""
    step = 32
    while at > 0:
        to = max(0, at - step)
        differ = np.flatnonzero(words[to:at] != words[to + lag : at + lag])
        if len(differ):
            return to + int(differ[-1]) + 1
        at, step = to, 2 * step
    return 0


def periodic(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """``[start, length, period]`` of all runs, by start, then period.

    ``words`` are codes that are equal only for equal words of one text, so
    that no run crosses from one text to the next.
    """
    if times < 3:
        raise ValueError("Runs of fewer than three periods guarantee too short an agreement.")
    grams, found, lag = Grams(words), [], 1
    while len(grams.at):
        k = agreement(lag, least, times)
        grams.grow_to(k)
        at, names = grams.longer(k)
        order = np.argsort(names, kind="stable")
        at, names = at[order], names[order]
        steps = at[1:] - at[:-1]
        seeds = np.flatnonzero((names[1:] == names[:-1]) & (steps >= lag) & (steps < 2 * lag))
        lags, starts = steps[seeds], at[seeds]
        order = np.lexsort((starts, lags))
        lags, starts = lags[order], starts[order]
        covered: dict[int, int] = {}
        i = 0
        while i < len(starts):
            q, at_seed = int(lags[i]), int(starts[i])
            if at_seed < covered.get(q, 0):
                # All seeds of this lag up to there are on the stretch already extended.
                same = int(np.searchsorted(lags, q, "right"))
                i += int(np.searchsorted(starts[i:same], covered[q]))
                continue
            start, end = agree_from(words, at_seed, q), agree_until(words, at_seed, q)
            covered[q] = end
            length = end - start + q
            if length >= max(least, times * q):
                found.append((start, length, q))
            i += 1
        lag *= 2
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def codes(words: columns.Words) -> np.ndarray:
    """A number for each word, equal exactly for equal words of one text."""
    lengths = words.ends - words.starts
    data = words.data[words.inside]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )
    encoded = column.dictionary_encode()
    return words.owner * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy().astype(np.int64)


def runs(df: DataFrame, key: str, text: str, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``key, n_words, runs, collapsed`` for every row.

    ``runs`` is an array of ``start, length, period`` (word numbers from 0).
    ``collapsed`` is the text without the words that a run holds after its first
    period, joined by one space.
    """
    agreement(1, least, times)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text"):
                words = columns.Words(*columns.flat(part.column(1)))
                found = periodic(codes(words), least, times)
                start, length, period = found.T
                dropped = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(dropped, start + period, 1)
                np.add.at(dropped, start + length, -1)
                owner = words.owner[start]
                ends = np.searchsorted(owner, np.arange(part.num_rows), "right")
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(x) for x in (start - words.firsts[owner], length, period)], RUN),
                )
                left = kept_words(words, np.cumsum(dropped[:-1]) > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.counts, pa.int64()), listed, pa.array([x.decode() for x in left], pa.string())],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    struct = ", ".join(f"{name}: bigint" for name in RUN)
    found = rows.mapInArrow(run, f"key {kind}, n_words long, runs array<struct<{struct}>>, collapsed string")
    return found.withColumnRenamed("key", key)
