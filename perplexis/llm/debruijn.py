"""Repeated passages by a compacted de Bruijn graph over words.

Every run of ``k`` words is an edge between its first and its last ``k - 1``
words. Edges meet by hash in buckets of packed arrays; an edge that starts in
two documents or more is repeated, and its first occurrence, by document and
position, is its source coordinate. An occurrence in a later document is to be
removed.

Compaction has two steps. Within a document, edges at consecutive positions
whose source coordinates are consecutive too form one run. Then runs that
follow each other in documents are nodes of a graph; where a run has one
successor and that one predecessor, in every document, they join into one path,
by Spark joins that double their reach each time.

Hashes only propose. For every distinct source span its words are hashed again
with two other seeds at the source document and compared at each document that
claims it. If a span doesn't agree, all is done again with another seed, so
that no document loses a word to a collision. Edges are told apart by 72 bits:
among 5 billion distinct ones about 0.003 false matches are to be expected.

Texts shuffle once; that exchange serves the source spans and the documents.
Defined results: null or empty texts have no words; a text shorter than ``k``
words has no edges; rows of equal id don't remove from each other; null ids
count as the largest. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.sources.workspace import stored

K = 13
BUCKET_BYTES = 4 << 20
FLUSH = 1 << 19
PIECE_BYTES = 1 << 18
SECOND = 300  # from the seed of an edge's hash to that of its second
NO_ID = (1 << 63) - 1
RUN = ["id", "tag", "start", "edges", "source_id", "source_tag", "source_start"]


def n_buckets(df: DataFrame, per: int = BUCKET_BYTES) -> int:
    """Buckets for packed edges, by Spark's estimate of the table's size."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(16, min(1 << 20, size // per)) if size < 1 << 60 else 64


def tagged(text: Column, seed: int) -> Column:
    """What parts rows of equal id and different text: 64 bits, others with another seed."""
    return F.xxhash64(F.lit(seed), F.coalesce(text, F.lit("")))


def keyed(df: DataFrame, key: str, text: str, seed: int = 0) -> DataFrame:
    """``id, tag, text``."""
    return df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        tagged(F.col(text), seed).alias("tag"), F.col(text).alias("text"),
    )


def _steps(values: np.ndarray) -> bytes:
    """Differences of ascending numbers, a byte each, with wider ones behind 255."""
    step = np.diff(values, prepend=0)
    wide = step >= 255
    return np.where(wide, 255, step).astype(np.uint8).tobytes() + step[wide].astype(np.uint32).tobytes()


def _unsteps(data: bytes, n: int) -> np.ndarray:
    step = np.frombuffer(data, np.uint8, n).astype(np.int64)
    step[step == 255] = np.frombuffer(data, np.uint32, offset=n)
    return np.cumsum(step)


def _three_bytes(values: np.ndarray) -> bytes:
    """The lowest 24 bits of each number."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unthree_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel().astype(np.uint64)


def edges(rows: DataFrame, k: int, buckets: int, seed: int) -> DataFrame:
    """``bucket, ids, tags, firsts, steps, low, high, more``: packed edges of many documents.

    An edge has 56 bits of a hash and 16 more of a second one with another base.
    """
    def flush(kept: list[tuple]) -> pa.RecordBatch:
        ids, tags, counts, found, second = (np.concatenate(x) for x in zip(*kept, strict=True))
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint32)
        bucket = ((found >> np.uint64(48)) + ((found & np.uint64(0xFFFF)) << np.uint64(16))) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint32), kind="stable")
        bucket = bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        out: list[list] = [[] for _ in range(8)]
        for start, end in zip(starts, [*starts[1:], len(order)], strict=True):
            part = order[start:end]
            hashes = columns.mix(found[part])
            own = np.unique(np.searchsorted(firsts, part, "right") - 1)
            row = (
                int(bucket[start]), ids[own].tobytes(), tags[own].tobytes(), firsts[own].tobytes(), _steps(part),
                hashes.astype(np.uint32).tobytes(), _three_bytes(hashes >> np.uint64(32)), second[part].tobytes(),
            )
            for x, value in zip(out, row, strict=True):
                x.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
            names=["bucket", "ids", "tags", "firsts", "steps", "low", "high", "more"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            for part in columns.pieces(batch, "text", PIECE_BYTES):
                words = columns.Words(*columns.flat(part.column(2)))
                hashes = words.hashes(seed)
                at, found = words.windows(hashes, k, seed)
                second = (words.windows(hashes, k, seed + SECOND)[1] >> np.uint64(48)).astype(np.uint16)
                counts = np.maximum(words.counts - k + 1, 0)
                some = counts > 0
                if some.any():
                    kept.append((part.column(0).to_numpy()[some], part.column(1).to_numpy()[some], counts[some], found, second))
                    n += len(at)
                if n >= FLUSH:
                    yield flush(kept)
                    kept, n = [], 0
        if kept:
            yield flush(kept)

    return rows.mapInArrow(
        run, "bucket long, ids binary, tags binary, firsts binary, steps binary, low binary, high binary, more binary"
    )


def repeats(packed: DataFrame, buckets: int) -> DataFrame:
    """``bucket, data``: later occurrences of repeated edges with their source, by document bucket."""
    def run(table: pa.Table) -> pa.Table:
        ids, tags, places, hashes, seconds = [], [], [], [], []
        for row in table.to_batches():
            for i in range(row.num_rows):
                own, tag, first, steps, low, high, more = (row.column(c)[i].as_py() for c in range(1, 8))
                n = len(low) // 4
                at = _unsteps(steps, n)
                first = np.frombuffer(first, np.uint32)
                doc = np.searchsorted(first, at, "right") - 1
                ids.append(np.frombuffer(own, np.int64)[doc])
                tags.append(np.frombuffer(tag, np.int64)[doc])
                places.append((at - first[doc]).astype(np.uint32))
                hashes.append(np.frombuffer(low, np.uint32).astype(np.uint64) | (_unthree_bytes(high) << np.uint64(32)))
                seconds.append(np.frombuffer(more, np.uint16))
        hashes = np.concatenate(hashes)
        again = columns.repeated(hashes)
        hashes = hashes[again]
        ids, tags, places, seconds = (np.concatenate(x)[again] for x in (ids, tags, places, seconds))
        order = np.lexsort((places, tags, ids, seconds, hashes))
        hashes, ids, tags, places, seconds = (x[order] for x in (hashes, ids, tags, places, seconds))
        head = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (seconds[1:] != seconds[:-1])][: len(hashes)])
        source = np.repeat(head, np.diff(np.r_[head, len(hashes)]))
        later = np.flatnonzero(ids > ids[source])
        source = source[later]
        found = np.rec.fromarrays(
            [ids[later], tags[later], places[later], ids[source], tags[source], places[source]],
            names="id,tag,place,source_id,source_tag,source_place",
        )
        to = (columns.mix(found.id.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to, found = to[order], found[order]
        starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]][: len(to)])
        return pa.table({
            "bucket": pa.array(to[starts]),
            "data": pa.array([_columnar(found[a:b]) for a, b in zip(starts, [*starts[1:], len(to)], strict=False)], pa.binary()),
        })

    return packed.groupBy("bucket").applyInArrow(run, "bucket long, data binary")


_FIELDS = [("id", np.int64), ("tag", np.int64), ("place", np.uint32), ("source_id", np.int64), ("source_tag", np.int64), ("source_place", np.uint32)]
_WIDTH = sum(np.dtype(kind).itemsize for _, kind in _FIELDS)


def _columnar(found: np.recarray) -> bytes:
    """Fields one after another, sorted by document, which shuffles compress well."""
    found = found[np.lexsort((found.place, found.tag, found.id))]
    return b"".join(np.ascontiguousarray(found[f]).astype(kind).tobytes() for f, kind in _FIELDS)


def _uncolumnar(blobs: list[bytes]) -> list[np.ndarray]:
    parts: list[list] = [[] for _ in _FIELDS]
    for blob in blobs:
        n, at = len(blob) // _WIDTH, 0
        for part, (_, kind) in zip(parts, _FIELDS, strict=True):
            part.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


def runs(found: DataFrame) -> DataFrame:
    """``RUN``: edges in a row, in the document and at the source (first step of compaction)."""
    def run(table: pa.Table) -> pa.Table:
        fields = _uncolumnar(table["data"].to_pylist())
        order = np.lexsort((fields[2], fields[1], fields[0]))
        fields = [f[order].astype(np.int64) for f in fields]
        twice = np.ones(len(order), bool)
        twice[1:] = np.any([f[1:] != f[:-1] for f in fields[:3]], axis=0)
        i, tag, place, source, source_tag, source_place = (f[twice] for f in fields)
        goes_on = np.zeros(len(i), bool)
        goes_on[1:] = (
            (i[1:] == i[:-1]) & (tag[1:] == tag[:-1]) & (place[1:] == place[:-1] + 1)
            & (source[1:] == source[:-1]) & (source_tag[1:] == source_tag[:-1]) & (source_place[1:] == source_place[:-1] + 1)
        )
        at = np.flatnonzero(~goes_on)
        count = np.diff(np.r_[at, len(i)])
        return pa.table(dict(zip(RUN, (i[at], tag[at], place[at], count, source[at], source_tag[at], source_place[at]), strict=True)))

    return found.groupBy("bucket").applyInArrow(run, ", ".join(f"{c} long" for c in RUN))


def paths(found: DataFrame) -> DataFrame:
    """``RUN`` and ``path``: runs that always follow each other under one number (second step).

    ``path`` is the hash of the first source span of the path.
    """
    span = F.xxhash64("source_id", "source_tag", "source_start", "edges")
    rows = found.withColumn("span", span)
    order = Window.partitionBy("id", "tag").orderBy("start")
    after = F.when(F.lead("start").over(order) == F.col("start") + F.col("edges"), F.lead("span").over(order))
    rows = stored(rows.withColumn("after", after), "runs")
    uses = rows.groupBy("span").agg(F.count("*").alias("n"))
    links = rows.where("after IS NOT NULL").groupBy("span", "after").agg(F.count("*").alias("n"))
    # Nonbranching: each use of the one is followed by the other, each use of which follows it.
    sole = (
        links.join(uses, ["span", "n"])
        .join(uses.select(F.col("span").alias("after"), "n"), ["after", "n"])
        .where("span <> after").select("after", "span")
    )
    up = stored(sole.select(F.col("after").alias("node"), F.col("span").alias("head")), "links")
    while True:
        # Reach doubles. Links can't close a ring: the last use in a document has none after it.
        more = up.select(F.col("node").alias("_node"), F.col("head").alias("_head"))
        further = stored(up.join(more, F.col("head") == F.col("_node"), "left"), "reach")
        up = further.select("node", F.coalesce("_head", "head").alias("head"))
        if further.where("_head IS NOT NULL").isEmpty():
            break
    return rows.join(up, F.col("span") == F.col("node"), "left").select(
        *RUN, F.coalesce("head", "span").alias("path")
    )


def _words(texts: pa.Array) -> columns.Words:
    return columns.Words(*columns.flat(texts))


def _sums(words: columns.Words) -> list[np.ndarray]:
    return [columns.sums(words.hashes(seed), seed) for seed in (101, 102)]


def _spans(words: columns.Words, sums: list[np.ndarray], owner: np.ndarray, start: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    first = words.firsts[owner] + start
    return [columns.spans(s, first, first + n, seed).view(np.int64) for s, seed in zip(sums, (101, 102), strict=True)]


def _listed(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Owner and fields of the structs in a column of lists (null: empty)."""
    column = column.fill_null([])
    flat = column.flatten()
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    return owner, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def source_hashes(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``source_id, source_tag, source_start, edges, one, two`` of the wanted source spans."""
    asked = wanted.groupBy("source_id", "source_tag").agg(F.collect_list(F.struct("source_start", "edges")).alias("asked"))
    rows = texts.join(asked, (F.col("id") == F.col("source_id")) & (F.col("tag") == F.col("source_tag")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text", PIECE_BYTES):
                words = _words(part.column(2))
                owner, fields = _listed(part.column(3))
                one, two = _spans(words, _sums(words), owner, fields["source_start"], fields["edges"] + k - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)),
                     *map(pa.array, (fields["source_start"], fields["edges"], one, two))],
                    names=["source_id", "source_tag", "source_start", "edges", "one", "two"],
                )

    return rows.select("id", "tag", "text", "asked").mapInArrow(
        run, "source_id long, source_tag long, source_start long, edges long, one long, two long"
    ).distinct()


def cut(texts: DataFrame, spans: DataFrame, k: int, make, names: str) -> DataFrame:
    """Every text with its verified spans marked, as ``make(part, words, removed, agreed)`` turns it into rows."""
    listed = spans.groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_list(F.struct("start", "edges", "one", "two")).alias("spans")
    )
    rows = texts.join(listed, (F.col("id") == F.col("_id")) & (F.col("tag") == F.col("_tag")), "left").drop("_id", "_tag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text", PIECE_BYTES):
                words = _words(part.column(part.schema.get_field_index("text")))
                owner, fields = _listed(part.column(part.schema.get_field_index("spans")))
                agreed = np.ones(part.num_rows, bool)
                removed = np.zeros(len(words.starts), bool)
                if len(owner):
                    n = fields["edges"] + k - 1
                    one, two = _spans(words, _sums(words), owner, fields["start"], n)
                    agreed[owner[(one != fields["one"]) | (two != fields["two"])]] = False
                    change = np.zeros(len(removed) + 1, np.int64)
                    np.add.at(change, words.firsts[owner] + fields["start"], 1)
                    np.add.at(change, words.firsts[owner] + fields["start"] + n, -1)
                    removed = np.cumsum(change[:-1]) > 0
                yield make(part, words, removed, agreed)

    return rows.mapInArrow(run, names)


def kept_words(words: columns.Words, removed: np.ndarray) -> Iterator[bytes]:
    """Kept words of each text, joined by one space."""
    data = words.data.tobytes()
    for i in range(words.n_texts):
        a, b = words.firsts[i], words.firsts[i + 1]
        keep = np.flatnonzero(~removed[a:b]) + a
        yield b" ".join([data[s:e] for s, e in zip(words.starts[keep].tolist(), words.ends[keep].tolist(), strict=True)])


def verified_spans(df: DataFrame, key: str, text: str, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``(texts, spans)``: keyed texts, and what is to go with the source's hashes."""
    texts, buckets = keyed(df, key, text, seed), n_buckets(df)
    found = stored(paths(runs(repeats(edges(texts, k, buckets, seed), buckets))), "paths")
    span = ["source_id", "source_tag", "source_start", "edges"]
    hashes = source_hashes(texts, found.select(*span).distinct(), k)
    return texts, found.join(hashes, span)


def summary(df: DataFrame, key: str, text: str, k: int = K) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` for every row."""
    def make(part: pa.RecordBatch, words: columns.Words, removed: np.ndarray, agreed: np.ndarray) -> pa.RecordBatch:
        digests = [hashlib.sha256(x).hexdigest() for x in kept_words(words, removed)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(words.counts, pa.int64()),
             pa.array(np.bincount(words.owner, weights=removed, minlength=part.num_rows).astype(np.int64)),
             pa.array(digests), pa.array(agreed)],
            names=["id", "n_words", "n_removed", "kept_sha256", "agreed"],
        )

    seed = 0
    while True:
        texts, spans = verified_spans(df, key, text, k, seed)
        out = stored(cut(texts, spans, k, make, "id long, n_words long, n_removed long, kept_sha256 string, agreed boolean"), "cut")
        if out.where("NOT agreed").isEmpty():
            return out.select(F.nullif("id", F.lit(NO_ID)).alias(key), "n_words", "n_removed", "kept_sha256")
        seed += 1


def remove(df: DataFrame, key: str, text: str, k: int = K) -> DataFrame:
    """All rows and columns; of a text that loses words, what is left, joined by one space."""
    others = F.struct(*(c for c in df.columns if c != text)).alias("row")

    def make(part: pa.RecordBatch, words: columns.Words, removed: np.ndarray, agreed: np.ndarray) -> pa.RecordBatch:
        lost = np.bincount(words.owner, weights=removed, minlength=part.num_rows) > 0
        left = [x.decode() if was else None for x, was in zip(kept_words(words, removed), lost, strict=True)]
        texts = pc.if_else(pa.array(lost), pa.array(left, pa.string()), part.column(part.schema.get_field_index("text")))
        return pa.RecordBatch.from_arrays(
            [part.column(part.schema.get_field_index("row")), texts, pa.array(agreed)], names=["row", "text", "agreed"]
        )

    seed = 0
    while True:
        _, spans = verified_spans(df, key, text, k, seed)
        # The text moves once, beside its row.
        texts = df.select(others, F.col(text).alias("text")).select(
            F.coalesce(F.col(f"row.{key}").cast("long"), F.lit(NO_ID)).alias("id"), tagged(F.col("text"), seed).alias("tag"), "text", "row"
        )
        out = stored(cut(texts, spans, k, make, f"row {texts.schema['row'].dataType.simpleString()}, text string, agreed boolean"), "cut")
        if out.where("NOT agreed").isEmpty():
            return out.select(*(F.col("text" if c == text else f"row.{c}").alias(c) for c in df.columns))
        seed += 1
