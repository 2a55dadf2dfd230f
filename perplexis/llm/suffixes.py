"""Repeated byte strings by a Burrows-Wheeler transform built column by column.

Removed is every byte covered by a ``length``-byte string (a window) that starts
anywhere else too. The work narrows in exact steps.

1. Every window has an anchor, a short string inside it chosen by its content
   alone, so that equal windows have equal anchors at equal places. Windows of a
   document with the same anchor form a segment. An anchor that occurs once, in
   all documents, has no repeated window. One whose segments are all equal, and
   occur twice or more, has only repeated ones.
2. The remaining segments part by the place of the anchor in the window, in
   ranges of ``RANGE`` bytes. The windows of one range share a core; those that
   can be equal have equal cores, so ranges meet by core. Around it a range has
   a left and a right flank of less than ``RANGE`` bytes. Equal ranges are one
   weighted string, so that copies count once.
3. Strings with equal core form a collection, and collections are dealt to
   shards. A shard builds the transform of all its strings together: in each
   round every string inserts one more symbol, from its end on; a core is one
   symbol of its length. The new rows' places follow from symbol counts, and
   their common prefixes, in bytes, from range minima. Transform, common
   prefixes and places stand in files that each round reads and writes in
   sequence. A window is repeated if it shares ``length`` bytes with the row
   before or after, or if its string has weight 2 or more.

A collection too large for a shard parts by whole windows instead, whose
strings are all equal. No step drops windows. Cores, segments and anchors are
compared by hashes of 128 bits.

Defined results: a null text has no bytes, a text shorter than a window no
window; matches never cross texts; rows of equal id are separate texts, also if
alike. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.sources.workspace import stored

LENGTH = 400
GRAM = 32
RANGE = 40
PLACE_BITS = 24
CHUNK = 4 << 20
SHARD_STRINGS = 20_000
NO_ID = (1 << 63) - 1
ROW = ["id", "tag", "more"]
CORE = 256
ENDED = (1 << 16) - 1


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """``(owner, first, last, anchor)`` of each segment as flat positions, and the hash of its anchor.

    A window's anchor is the leftmost of its ``gram``-byte strings of least
    hash, so that equal windows have it at the same place; every window belongs
    to exactly one segment.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4, np.zeros(0, np.uint64)
    prefix = columns.sums(columns._codes(201)[data], 201)
    at = np.arange(len(data) - gram + 1)
    grams = columns.spans(prefix, at, at + gram, 201)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~mask) | at.astype(np.uint64)
    width, reach = 1, length - gram + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    anchor = (least[:n] & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = owner[:n] == owner[length - 1 :]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1]) | (owner[1:n] != owner[: n - 1])
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], n] - 1
    good = valid[starts]
    starts, ends = starts[good], ends[good]
    return (owner[starts], starts, ends, anchor[starts]), grams[anchor[starts]]


def chunks(batch: pa.RecordBatch, column: str, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """``(rows, bytes, offsets, skipped)``; a very long text comes in parts that overlap by all but a window's start."""
    for part in columns.pieces(batch, column, min(columns.PIECE_BYTES, CHUNK)):
        data, offsets = columns.flat(part.column(part.schema.get_field_index(column)))
        step = CHUNK - length + 1
        if len(data) <= CHUNK:
            yield part, data, offsets, 0
            continue
        for at in range(0, max(1, len(data) - length + 1), step):
            piece = data[at : at + CHUNK]
            yield part, piece, np.array([0, len(piece)]), at


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id, tag, more, text``; 96 bits of tag and more part rows of equal id and different text."""
    return df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("tag"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("more"), F.col(text).alias("text"),
    )


def segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``anchor, one, two, id, tag, more, first, windows, behind``: every segment of every text.

    ``one, two`` name its content; ``behind`` is the anchor's distance from the first window.
    """
    names = ["anchor", "one", "two", "id", "tag", "more", "first", "windows", "behind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets, skipped in chunks(batch, "text", length):
                (owner, starts, ends, anchor), grams = anchors(data, offsets, length, gram)
                both = [
                    columns.spans(columns.sums(columns._codes(s)[data], s), starts, ends + length, s).view(np.int64)
                    for s in (202, 203)
                ]
                owners = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    pa.array(grams.view(np.int64)), *map(pa.array, both), *(rows.column(i).take(owners) for i in range(3)),
                    pa.array(starts - offsets[owner] + skipped), pa.array((ends - starts + 1).astype(np.int32)),
                    pa.array((anchor - starts).astype(np.int32)),
                ], names=names)

    return texts.mapInArrow(
        run, "anchor long, one long, two long, id long, tag long, more long, first long, windows int, behind int"
    )


def ranges(texts: DataFrame, wanted: DataFrame, length: int, width: int) -> DataFrame:
    """``core, place, left, right, one, two, low, high, n``: ranges of the wanted segments.

    ``place`` numbers the range; ``low`` and ``high`` bound the anchor's distance
    in it; ``n`` is how often the segment occurs.
    """
    listed = wanted.groupBy(*(F.col(c).alias(f"_{c}") for c in ROW)).agg(
        F.collect_list(F.struct("one", "two", "first", "windows", "behind", "n")).alias("wanted")
    )
    rows = texts.join(listed, [F.col(c) == F.col(f"_{c}") for c in ROW]).select("text", "wanted")
    names = ["core", "place", "left", "right", "one", "two", "low", "high", "n"]
    kinds = (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, items in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                for item in items.as_py():
                    anchor = item["first"] + item["behind"]
                    low, high = item["behind"] - item["windows"] + 1, item["behind"]
                    for place in range(low // width, high // width + 1):
                        a, b = max(low, place * width), min(high, place * width + width - 1)
                        start, end = anchor - place * width, anchor - place * width - width + 1 + length
                        core = hashlib.blake2b(data[start:end], digest_size=16).digest()
                        out.append((core, place, data[anchor - b : start], data[end : anchor - a + length], item["one"], item["two"], a, b, item["n"]))
            parts = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(p, kind) for p, kind in zip(parts, kinds, strict=True)], names=names)

    return rows.mapInArrow(
        run, "core binary, place int, left binary, right binary, one long, two long, low int, high int, n long"
    )


class Collection:
    """Transform and common prefixes of many strings, built by one symbol a round.

    Rows stand in suffix order. ``symbol`` is what precedes the suffix, ``common``
    the bytes it shares with the row before, ``place`` its string and start. The
    three live in files of a folder; a round reads and writes each once.
    """

    def __init__(self, strings: list[np.ndarray], core_bytes: int, folder: str):
        self.strings, self.core_bytes, self.folder = strings, core_bytes, folder
        self.lengths = np.array([len(s) for s in strings])
        self.text = np.concatenate(strings) if strings else np.zeros(0, np.uint16)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)])
        n = len(strings)
        self._write(self._before(np.arange(n), self.lengths), np.zeros(n, np.uint16), self.begin[:-1] + self.lengths)
        self.newest = np.arange(n)  # rows of the suffixes that came last, by string
        self.active = np.arange(n)
        for done in range(1, int(self.lengths.max(initial=0)) + 1):
            self._round(done)

    def _before(self, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Symbol before the suffix at ``start`` of each string."""
        out = np.full(len(owner), ENDED, np.uint16)
        some = start > 0
        out[some] = self.text[self.begin[owner[some]] + start[some] - 1]
        return out

    def _write(self, symbol: np.ndarray, common: np.ndarray, place: np.ndarray) -> None:
        for name, values, kind in (("symbol", symbol, np.uint16), ("common", common, np.uint16), ("place", place, np.uint32)):
            values.astype(kind).tofile(os.path.join(self.folder, name))

    def read(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(
            np.fromfile(os.path.join(self.folder, name), kind)
            for name, kind in (("symbol", np.uint16), ("common", np.uint16), ("place", np.uint32))
        )

    def _round(self, done: int) -> None:
        """Inserts, for every string that has one, the suffix of ``done`` symbols."""
        symbol, common, place = self.read()
        still = self.lengths[self.active] >= done
        self.active, rows = self.active[still], self.newest[still]
        n, n_strings = len(symbol), len(self.strings)
        # A row's suffix with the symbol before it stands, among suffixes of that
        # first symbol, where the row stands among rows of that symbol.
        order = np.argsort(symbol, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        same = np.zeros(n + 1, bool)
        same[1:n] = symbol[order[1:]] == symbol[order[:-1]]
        minima = _Minima(common)
        at = rank[rows]
        weight = np.where(symbol[rows] >= CORE, self.core_bytes, 1)
        before, after = order[np.maximum(at - 1, 0)], order[np.minimum(at + 1, n - 1)]
        share = np.where(same[at], weight + minima.least(np.where(same[at], before, rows - 1) + 1, rows), 0)
        share_next = np.where(same[at + 1], weight + minima.least(rows + 1, np.where(same[at + 1], after, rows + 1)), 0)
        # In the new order: empty suffixes, then all rows that have a symbol, by symbol.
        target = n_strings + at
        total = n + len(rows)
        fresh = np.zeros(total, bool)
        fresh[target] = True
        out = [np.empty(total, values.dtype) for values in (symbol, common, place)]
        for new, old in zip(out, (symbol, common, place), strict=True):
            new[~fresh] = old
        start = self.lengths[self.active] - done
        out[0][target] = self._before(self.active, start)
        out[2][target] = self.begin[self.active] + start
        # What stood after a new row now shares with that row.
        follows = target + 1
        inside = follows < total
        out[1][follows[inside]] = share_next[inside]
        out[1][target] = share
        self._write(*out)
        self.newest = target

    def repeated(self, length: int) -> np.ndarray:
        """Flat starts of suffixes that share ``length`` bytes with another."""
        _, common, place = self.read()
        close = common >= length
        close[:-1] |= common[1:] >= length
        return place[close].astype(np.int64)


class _Minima:
    """Range minima by a table of doubling widths."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > (width := 1 << (len(self.levels) - 1)):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value of each ``[first, last]``; 0 where that is empty."""
        n = len(self.levels[0])
        span = last - first + 1
        good = (span > 0) & (last < n) & (first >= 0)
        out = np.zeros(len(first), np.int64)
        level = np.frexp(np.where(good, span, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[good]):
            which = np.flatnonzero(good & (level == k))
            table = self.levels[k]
            out[which] = np.minimum(table[first[which]], table[last[which] - (1 << k) + 1])
        return out


def in_shards(strings: DataFrame, length: int, width: int, shards: int) -> DataFrame:
    """``core, place, left, right, high, hits``: which windows of each string repeat, by the transform.

    ``hits`` are distances of the anchor from the window.
    """
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        groups = {g: i for i, g in enumerate(dict.fromkeys((r["core"], r["place"]) for r in rows))}
        out = []
        # Symbols have 16 bits; cores beyond those go to further collections.
        numbers = np.array([groups[r["core"], r["place"]] for r in rows], np.int64)
        most = ENDED - CORE - 1
        for lot in np.unique(numbers // most):
            some = np.flatnonzero(numbers // most == lot)
            strings = [
                np.concatenate([
                    np.frombuffer(rows[i]["left"], np.uint8).astype(np.uint16), [np.uint16(CORE + numbers[i] % most)],
                    np.frombuffer(rows[i]["right"], np.uint8).astype(np.uint16),
                ]).astype(np.uint16) for i in some
            ]
            with tempfile.TemporaryDirectory() as folder:
                collection = Collection(strings, length - width + 1, folder)
                found = collection.repeated(length)
            owner = np.searchsorted(collection.begin, found, "right") - 1
            hits: list[list[int]] = [[] for _ in some]
            for o, start in zip(owner.tolist(), (found - collection.begin[owner]).tolist(), strict=True):
                hits[o].append(rows[some[o]]["high"] - start)
            for i, hit in zip(some, hits, strict=True):
                if hit:
                    r = rows[i]
                    out.append((r["core"], r["place"], r["left"], r["right"], r["high"], sorted(hit)))
        parts = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int32()))
        return pa.table({n: pa.array(p, k) for n, p, k in zip(("core", "place", "left", "right", "high", "hits"), parts, kinds, strict=True)})

    dealt = strings.withColumn("shard", F.pmod(F.xxhash64("core", "place"), F.lit(shards)))
    return dealt.select("shard", "core", "place", "left", "right", "high").groupBy("shard").applyInArrow(
        run, "core binary, place int, left binary, right binary, high int, hits array<int>"
    )


def by_window(strings: DataFrame, width: int) -> DataFrame:
    """The same for collections too large for a shard: strings of one window each, equal or not.

    A window with the anchor ``d`` bytes in takes the last ``d - place * width``
    bytes of the left flank and fills up with the first of the right.
    """
    one = strings.withColumn("hit", F.explode(F.sequence("low", "high")))
    before = F.col("hit") - F.col("place") * width
    after = F.lit(width - 1) - before
    one = one.withColumn(
        "window", F.concat(F.expr("right(hex(left), 2 * (hit - place * " + str(width) + "))"), F.lit("|"), F.substring(F.hex("right"), F.lit(1), after * 2))
    )
    again = one.groupBy("core", "place", "hit", "window").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return one.join(again, ["core", "place", "hit", "window"]).groupBy("core", "place", "left", "right", "high").agg(
        F.sort_array(F.collect_list("hit")).alias("hits")
    )


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, width: int = RANGE) -> DataFrame:
    """``id, tag, more, first, last``: runs of repeated windows by their starts; runs may touch or overlap."""
    found = stored(segments(texts, length, gram), "segments")
    content = ["one", "two"]
    distinct = found.groupBy("anchor", *content).agg(
        F.count("*").alias("n"), F.min(F.struct(*ROW, "first", "windows", "behind")).alias("at")
    )
    per_anchor = distinct.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    distinct = stored(distinct.join(per_anchor, "anchor").select(*content, "n", "kinds", "at.*"), "repeated-anchors")
    alone = distinct.where("kinds = 1").select(*content, F.array(F.struct(
        (F.col("behind") - F.col("windows") + 1).alias("low"), F.col("behind").alias("high")
    )).alias("hits"))
    parted = stored(ranges(texts, distinct.where("kinds > 1"), length, width), "ranges")
    string = ["core", "place", "left", "right"]
    strings = parted.groupBy(*string).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    cores = strings.groupBy("core", "place").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    strings = stored(strings.join(cores, ["core", "place"]), "strings")
    shards = max(1, -(-strings.count() // SHARD_STRINGS))
    small = F.col("kinds") <= SHARD_STRINGS
    hits = in_shards(strings.where(small & (F.col("kinds") > 1)), length, width, shards).unionByName(
        by_window(strings.where(~small), width)
    ).groupBy(*string).agg(F.first("hits").alias("hits"))
    judged = strings.join(hits, string, "left").select(*string, F.when(
        F.col("n") > 1, F.array(F.struct("low", "high"))
    ).otherwise(F.transform("hits", lambda h: F.struct(h.alias("low"), h.alias("high")))).alias("hits")).where("hits IS NOT NULL")
    again = parted.join(judged, string).groupBy(*content).agg(F.flatten(F.collect_list("hits")).alias("hits"))
    starts = found.join(alone.unionByName(again), content).select(
        *ROW, F.explode("hits").alias("hit"), (F.col("first") + F.col("behind")).alias("anchor")
    )
    return starts.select(
        *ROW, (F.col("anchor") - F.col("hit.high")).alias("first"), (F.col("anchor") - F.col("hit.low")).alias("last")
    )


def summary(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    texts = keyed(df, key, text)
    spans = repeated_windows(texts, length).groupBy(*(F.col(c).alias(f"_{c}") for c in ROW)).agg(
        F.collect_list(F.struct("first", "last")).alias("spans")
    )
    rows = texts.join(spans, [F.col(c) == F.col(f"_{c}") for c in ROW], "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                change = np.zeros(len(data) + 1, np.int64)
                if spans.is_valid:
                    first, last = (spans.values.field(i).to_numpy() for i in (0, 1))
                    np.add.at(change, first, 1)
                    np.add.at(change, last + length, -1)
                removed = np.cumsum(change[:-1]) > 0
                edges = np.count_nonzero(removed[1:] & ~removed[:-1]) + int(removed[:1].any())
                out.append((len(data), int(removed.sum()), edges, hashlib.sha256(data[~removed].tobytes()).hexdigest()))
            parts = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(p, k) for p, k in zip(parts, kinds, strict=True))],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    out = rows.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("id", F.nullif("id", F.lit(NO_ID))).withColumnRenamed("id", key)
