"""Quality rules: an isolation forest on rule statistics, calibrated by labels.

The statistics of a text are computed over all of it, in one pass of numpy over
Arrow batches. Two fixed rules reject outright (too few words, too much
repeated). For the rest, trees of random splits isolate a text the sooner the
rarer its statistics; the score is ``2 ** (-mean path / expected path)``. There
is a forest for each statistic, and one for all of them together, each with its
threshold; a text is anomalous if it passes any.

The forests learn from all labelled rows, which are dealt to the trees: each row
is in one tree of a forest at least, in several if a tree had fewer than ``TREE_ROWS``
good rows (``BAD_TREE_ROWS`` bad ones) otherwise. Bad rows stand for outliers: they
widen the ranges from which splits are drawn. A tree grows by a level at a time
from counts and ranges of its leaves, down to ``MAX_DEPTH``; below, the expected path
counts. A threshold is the least that rejects at most ``MAX_GOOD_REJECTED``
of all good rows, moved halfway to the bad rows above it; a forest with
fewer bad rows above it than good ones is left out.

Defined results: a null or empty text has all statistics 0 and fails the first
rule; repeated rows are judged each; with several labels for a key the worst
counts; without good labels no text is anomalous; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.llm.columns import Words, mix, repeated
from perplexis.sources.workspace import cleared, stored

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
TREES = 50
TREE_ROWS = 256
BAD_TREE_ROWS = 6
MAX_DEPTH = 9
MAX_GOOD_REJECTED = 0.001
SEED = 7

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """One row for each text, one column for each of ``STATS``."""
    data, offsets = columns.flat(texts)
    words = Words(data, offsets)
    characters = words.inside & ((data & 0xC0) != 0x80)
    out = np.zeros((words.n_texts, len(STATS)), np.int64)
    out[:, 0] = words.counts
    out[:, 3] = _dup_lines(data, offsets, words)
    out[:, 4] = _repeat_words(words)
    for i, flags in ((1, characters), (2, _SYMBOL[data])):
        out[:, i] = columns.per_text(flags, offsets)
    return out


def _repeat_words(words: Words) -> np.ndarray:
    at, keys = words.windows(words.hashes(), 3)
    again = at[repeated(mix(keys + words.owner[at].astype(np.uint64)))]
    marks = columns.covered(again, 3, len(words.starts))
    return np.bincount(words.owner, weights=marks, minlength=words.n_texts).astype(np.int64)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    ends = np.unique(np.concatenate([np.flatnonzero(data == 0x0A), offsets[1:]]))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    starts = starts + (np.append(data, 0)[starts] == 0x0A)
    owner = np.searchsorted(offsets, starts, "right") - 1
    filled = np.searchsorted(words.starts, starts) < np.searchsorted(words.starts, ends)
    starts, ends, owner = starts[filled], ends[filled], owner[filled]
    keys = columns.spans(columns.sums(columns._codes(0)[data], 0), starts, ends, 0)
    keys = mix(keys + owner.astype(np.uint64))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(owner, minlength=words.n_texts) - np.bincount(owner[first], minlength=words.n_texts)


def base_failed(stats: np.ndarray) -> np.ndarray:
    n = stats[:, 0]
    return (n < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEATED_PERCENT * n)


def features(stats: np.ndarray) -> np.ndarray:
    """Shares that don't depend on a text's length."""
    n, chars = np.maximum(stats[:, 0], 1), np.maximum(stats[:, 1], 1)
    return np.stack([
        stats[:, 1] / n, stats[:, 2] / chars, stats[:, 3] / n, stats[:, 4] / n,
    ], axis=1)


class Tree(NamedTuple):
    column: np.ndarray  # -1 for a leaf
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray  # of a leaf: its depth and the expected rest

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each row reaches."""
        at = np.zeros(len(rows), np.int64)
        while (self.column[at] >= 0).any():
            column = np.maximum(self.column[at], 0)
            goes = rows[np.arange(len(rows)), column] <= self.split[at]
            at = np.where(self.column[at] < 0, at, np.where(goes, self.left[at], self.right[at]))
        return at


def expected_path(n: float) -> float:
    """Mean path of an unsuccessful search among ``n`` rows."""
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)


class Growing:
    """A tree that grows by a level at a time, from the extents of the rows in its open leaves."""

    def __init__(self, columns: list[int], number: int):
        self.columns, self.start = columns, number / TREES
        self.rng = np.random.default_rng([SEED, len(columns), columns[0], number])
        self.nodes: list[list] = [[-1, 0.0, 0, 0, 0.0]]
        self.open = {0: 0}  # leaf and depth
        self.limit = 0

    def tree(self) -> Tree:
        return Tree(*(np.array(c) for c in zip(*self.nodes, strict=True)))

    def grow(self, extents: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> None:
        """``extents``: number of rows, least and greatest values of each open leaf that has rows."""
        was, self.open = self.open, {}
        for at, depth in was.items():
            n, low, high = extents.get(at, (0, np.zeros(1), np.zeros(1)))
            if at == 0:
                self.limit = min(MAX_DEPTH, int(np.ceil(np.log2(max(2, n)))))
            varied = np.flatnonzero(high > low)
            self.nodes[at][4] = depth + expected_path(n)
            if depth < self.limit and n > 1 and len(varied):
                column = int(self.rng.choice(varied))
                new = len(self.nodes)
                self.nodes[at][:4] = column, self.rng.uniform(low[column], high[column]), new, new + 1
                for child in (new, new + 1):
                    self.nodes.append([-1, 0.0, child, child, 0.0])
                    self.open[child] = depth + 1


class Forest(NamedTuple):
    """Trees over some of the features, and the score above which a row is anomalous."""

    columns: list[int]
    trees: list[Tree]
    usual: float
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, 0 to 1; higher is rarer."""
        rows = rows[:, self.columns]
        total = np.zeros(len(rows))
        for tree in self.trees:
            total += tree.path[tree.leaves(rows)]
        return 2 ** (-total / len(self.trees) / self.usual)


class Extent(NamedTuple):
    """Rows of one leaf of a tree: how many, and their range in each feature of the tree."""

    tree: int
    leaf: int
    n: int
    low: np.ndarray
    high: np.ndarray


def extents(growing: list[Growing], rows: np.ndarray, places: np.ndarray, shares: np.ndarray) -> Iterator[Extent]:
    """The rows' extents in all open leaves.

    A row has a place from 0 to 1. It is in the trees that start less than its share before it.
    """
    for i, one in enumerate(growing):
        if not one.open:
            continue
        part = rows[(places - one.start) % 1.0 < shares][:, one.columns]
        at = one.tree().leaves(part)
        part, at = part[(is_open := np.isin(at, list(one.open)))], at[is_open]
        if not len(at):
            continue
        order = np.argsort(at, kind="stable")
        part, at = part[order], at[order]
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sizes = np.diff(np.append(starts, len(at)))
        lows, highs = np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts)
        yield from (Extent(i, int(at[s]), int(n), low, high) for s, n, low, high in zip(starts, sizes, lows, highs, strict=True))


def shares_of(n_good: int, n_bad: int) -> tuple[float, float]:
    """The part of the good and of the bad rows that a tree holds: every row is in one tree at least."""
    return tuple(min(1.0, max(1 / TREES, least / max(n, 1))) for least, n in ((TREE_ROWS, n_good), (BAD_TREE_ROWS, n_bad)))


def grown(n_good: int, n_bad: int, level: Callable[[list[Growing]], list[Extent]]) -> list[Forest]:
    """Forests without thresholds; ``level`` gives the extents of all rows in the open leaves."""
    every = list(range(len(STATS) - 1))
    kinds = [every, *([c] for c in every)]
    growing = [Growing(chosen, number) for chosen in kinds for number in range(TREES)]
    while any(one.open for one in growing):
        found: list[dict] = [{} for _ in growing]
        for e in level(growing):
            found[e.tree][e.leaf] = e.n, e.low, e.high
        for one, its in zip(growing, found, strict=True):
            one.grow(its)
    usual = expected_path(shares_of(n_good, n_bad)[0] * n_good) or 1.0
    return [
        Forest(chosen, [one.tree() for one in growing[i * TREES:(i + 1) * TREES]], usual, np.inf)
        for i, chosen in enumerate(kinds)
    ]


def allowed_above(n_good: int) -> int:
    return int(MAX_GOOD_REJECTED * n_good)


def with_threshold(forest: Forest, n_good: int, threshold: float, n_above: int, least_above: float | None) -> list[Forest]:
    """The forest, if more bad rows are above the threshold than good ones; it would else reject those for nothing."""
    if n_above <= allowed_above(n_good):
        return []
    return [forest._replace(threshold=float(threshold + least_above) / 2)]


def fit(good: np.ndarray, bad: np.ndarray) -> list[Forest]:
    """Forests on the statistics of few good and bad rows, with their thresholds. ``learn`` does the same over tables."""
    good, bad = (features(x[~base_failed(x)]) for x in (good, bad))
    if len(good) < 2:
        return []
    rows = np.concatenate([good, bad])
    places = np.random.default_rng(SEED).uniform(size=len(rows))
    shares = np.repeat(shares_of(len(good), len(bad)), [len(good), len(bad)])
    out = []
    for forest in grown(len(good), len(bad), lambda growing: list(extents(growing, rows, places, shares))):
        threshold = np.sort(forest.scores(good))[len(good) - 1 - allowed_above(len(good))]
        above = forest.scores(bad) if len(bad) else np.zeros(0)
        above = above[above > threshold]
        out += with_threshold(forest, len(good), threshold, len(above), above.min() if len(above) else None)
    return out


def _verdicts(forests: list[Forest], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the base rules fail, whether the row is kept, and its highest score over threshold."""
    failed, rows = base_failed(stats), features(stats)
    excess = np.full((len(stats), len(forests) + 1), -1.0)
    for i, forest in enumerate(forests):
        excess[:, i] = forest.scores(rows) - forest.threshold
    excess = excess.max(axis=1)
    return failed, ~failed & (excess <= 0), excess


def _over(batches: Iterator[pa.RecordBatch], text: str, make: Callable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in columns.pieces(batch, text):
            yield make(part, statistics(part.column(part.schema.get_field_index(text))))


def stats(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Columns ``keep`` and ``STATS`` of every row; names in ``keep`` must not clash."""
    rows = df.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _over(batches, "_text", lambda part, s: pa.RecordBatch.from_arrays(
            [*part.columns[:-1], *(pa.array(c, pa.int64()) for c in s.T)], names=[*keep, *STATS]
        ))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join(kept + [f"{s} long" for s in STATS]))


def learn(df: DataFrame, key: str, text: str, labels: DataFrame) -> list[Forest]:
    """The forests of all labelled rows; ``labels`` has ``key`` and ``quality`` (1 is good).

    Statistics meet the labels, texts don't travel. Trees grow by a level at a
    time: tasks send the extents of their rows in the open leaves, which combine to
    one row for each leaf, a bounded number whatever the size of the table.
    """
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_quality"))
    )
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_words"))
    with cleared(df.sparkSession):
        found = stats(rows, ["_key"], "_words").join(chosen, "_key")
        place = F.pmod(F.xxhash64("_key", *STATS), F.lit(1 << 40)) / F.lit(float(1 << 40))
        return _learned(stored(found.select((F.col("_quality") == 1).alias("good"), place.alias("place"), *STATS), "labelled"))


def _features_of(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows that pass the base rules, and their features."""
    values = np.stack([batch.column(s).to_numpy() for s in STATS], axis=1).reshape(batch.num_rows, len(STATS))
    passed = ~base_failed(values)
    return batch.filter(pa.array(passed)), features(values[passed])


def _learned(rows: DataFrame) -> list[Forest]:
    """``rows``: ``good, place`` and ``STATS`` of the labelled rows, stored."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    counts = rows.where(~failed).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).first()
    n_good, n_bad = counts.good, counts.bad
    if n_good < 2:
        return []
    of_good, of_bad = shares_of(n_good, n_bad)
    width = len(STATS) - 1

    def level(growing: list[Growing]) -> list[Extent]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch, values = _features_of(batch)
                shares = np.where(batch.column("good").to_numpy(zero_copy_only=False), of_good, of_bad)
                sent = list(extents(growing, values, batch.column("place").to_numpy(), shares))
                # A tree of one feature leaves the others 0.
                wide = lambda name: np.array([np.pad(getattr(e, name), (0, width - len(e.low))) for e in sent]).reshape(-1, width).T
                columns = [np.array([getattr(e, c) for e in sent], np.int64) for c in ("tree", "leaf", "n")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (*columns, *wide("low"), *wide("high"))], names=["tree", "leaf", "n", *lows, *highs]
                )

        lows, highs = ([f"{name}{c}" for c in range(width)] for name in ("low", "high"))
        sent = rows.mapInArrow(run, ", ".join(["tree long, leaf long, n long", *(f"{c} double" for c in (*lows, *highs))]))
        merged = sent.groupBy("tree", "leaf").agg(
            F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]
        )
        own = lambda r, names: np.array([r[c] for c in names[:len(growing[r.tree].columns)]])
        return [Extent(r.tree, r.leaf, r.n, own(r, lows), own(r, highs)) for r in merged.collect()]

    forests = grown(n_good, n_bad, level)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, values = _features_of(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), *(pa.array(f.scores(values)) for f in forests)], names=["good", *names]
            )

    names = [f"score{i}" for i in range(len(forests))]
    scored = stored(rows.mapInArrow(score, ", ".join(["good boolean", *(f"{c} double" for c in names)])), "forest_scores")
    out = []
    for forest, name in zip(forests, names, strict=True):
        # One good row in a thousand.
        highest = scored.where("good").select(name).orderBy(F.col(name).desc()).limit(allowed_above(n_good) + 1)
        threshold = highest.agg(F.min(name)).first()[0]
        above = scored.where(~F.col("good") & (F.col(name) > threshold)).agg(F.count("*"), F.min(name)).first()
        out += with_threshold(forest, n_good, threshold, above[0], above[1])
    return out


def judge(df: DataFrame, key: str, text: str, forests: list[Forest]) -> DataFrame:
    """``key``, ``STATS``, ``base_failed, kept, anomaly`` for every row."""
    rows = df.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))

    def make(part: pa.RecordBatch, s: np.ndarray) -> pa.RecordBatch:
        failed, kept, scores = _verdicts(forests, s)
        return pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(c, pa.int64()) for c in s.T),
             pa.array(failed), pa.array(kept), pa.array(scores)],
            names=["_key", *STATS, "base_failed", "kept", "anomaly"],
        )

    schema = ", ".join(["_key long", *(f"{s} long" for s in STATS), "base_failed boolean, kept boolean, anomaly double"])
    return rows.mapInArrow(lambda batches: _over(batches, "_text", make), schema).withColumnRenamed("_key", key)


def keep(df: DataFrame, text: str, forests: list[Forest]) -> DataFrame:
    """The rows that pass, with all their columns, in one pass over the table."""
    return df.mapInArrow(
        lambda batches: _over(batches, text, lambda part, s: part.filter(pa.array(_verdicts(forests, s)[1]))), df.schema
    )
