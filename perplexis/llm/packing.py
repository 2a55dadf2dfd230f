"""Bounded-space online best-fit packing of token pieces into sequences.

Tokenising is a map over the documents: a document's ids, with one end id
after them, are cut only if longer than a sequence. Full pieces fill a sequence
by themselves; the rest is packed. What is shuffled is one narrow row a piece,
never ids.

A packer keeps a fixed number of open bins. A bitset keyed by free space finds
the tightest bin that takes a piece; if none does and all bins are open, the
fullest closes first. Pieces reach a packer in runs that fit in the open bins,
larger ones first within a run, so that small ones fill the gaps.

Groups of pieces are packed side by side. The bins that a group ends with go
on as pieces of their own to the next round, with fewer groups, until one group
is left, so that only the last packer leaves bins part-filled. Rounds shrink by
more than the group size over the open bins, and no task sees more than a
group's rows.

Defined results: a null or empty text is the end id alone; repeated rows and
repeated ids are packed as separate documents; an empty table gives no pieces.
Only the two named columns are read. A very long text is tokenised whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored

LENGTH = 2048
END_ID = 0
OPEN_BINS = 1024
GROUP = 200_000
# Sequences in a run, as a share of the open bins: a run fits in them whole.
RUN_SHARE = 0.4
TOKENIZER = "byte_bpe_50k"
CACHED = 300_000
# One space between two non-spaces: no token reaches across its left side.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
ODD_SPACE = re.compile(r"\s |^ | \s| $")


class Encoder(dict):
    """Ids of whole texts, as little-endian 32-bit bytes.

    The tokenizer splits at a lone space whatever stands around it, so ids of
    what is between such spaces can be remembered; the memory is cleared when
    full. Same ids as ``tokenizers`` gives with ``add_special_tokens=False``,
    for which the name of a special token in a text stands for its id.
    """

    def __init__(self, name: str = TOKENIZER):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokenizer = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def __missing__(self, chunk: str) -> bytes:
        found = np.array(self.tokenizer.encode_ordinary(chunk), "<u4").tobytes()
        if len(self) >= CACHED:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def ids(self, text: str) -> bytes:
        if self.special is not None and self.special.search(text):
            return np.array(self.tokenizer.encode(text, allowed_special="all"), "<u4").tobytes()
        chunks = LONE_SPACE.split(text) if ODD_SPACE.search(text) else text.split(" ")
        first = self[chunks[0]] if chunks[0] else b""
        return first + b"".join([self[" " + c] for c in chunks[1:]])


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces: whole, or full ones behind a shorter first."""
    head = n % length if n > length else n
    starts = [(0, head)] if head else []
    return starts + [(at, length) for at in range(head, n, length)] if n > length else starts


def pieces(
    df: DataFrame, key: str, text: str, length: int = LENGTH, tokenizer: str = TOKENIZER
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` for every piece of every row."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(t.as_py() or "") + end
                for i, (start, n) in enumerate(cut(len(ids) // 4, length)):
                    out.append((k, i, start, n, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    out = rows.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("key", key)


class Packer:
    """Best-fit over a fixed number of open bins, found by a bitset of free space."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.most = length, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits, self.n_open, self.n_bins = 0, 0, 0
        self.free: list[int] = []

    def put(self, size: int) -> tuple[int, int]:
        """``(bin, offset)`` of a piece of this size."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, at = self.length, self.n_bins
            self.n_bins += 1
            self.free.append(free)
        left = free - size
        self.free[at] = left
        if left:
            self.by_free[left].append(at)
            self.bits |= 1 << left
            self.n_open += 1
        return at, self.length - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        at = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.n_open -= 1
        return at

    def still_open(self) -> list[int]:
        return [at for bins in self.by_free for at in bins]


def pack_group(ids: np.ndarray, sizes: np.ndarray, length: int, open_bins: int):
    """Bin and offset of each piece, and which bins were open at the end."""
    order = np.argsort(ids, kind="stable")
    run = np.cumsum(sizes[order]) // (max(1, int(RUN_SHARE * open_bins)) * length)
    order = order[np.lexsort((-sizes[order], run))]
    packer = Packer(length, open_bins)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        bins[i], offsets[i] = packer.put(size)
    is_open = np.zeros(packer.n_bins, bool)
    is_open[packer.still_open()] = True
    return bins, offsets, is_open, np.array(packer.free, np.int64)


def pack(
    df: DataFrame, size: str, length: int = LENGTH, open_bins: int = OPEN_BINS, group: int = GROUP
) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset`` for every row.

    Sizes run from 1 to ``length``. Rows reach a group by the hash of a number
    given to each, so that no key of the data can gather in one.
    """
    rows = df.withColumn("_full", F.col(size) >= length)
    narrow = stored(rows, "pieces")
    loose = narrow.where("NOT _full")
    n = loose.count()
    groups = max(1, -(-n // group))

    def level(frame: DataFrame, groups: int, last: bool) -> DataFrame:
        """Packs ``_order, _size`` rows of each group; marks what goes on."""
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            sizes = table["_size"].to_numpy().astype(np.int64)
            bins, offsets, is_open, _ = pack_group(table["_order"].to_numpy(), sizes, length, open_bins)
            used = np.bincount(bins, weights=sizes).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
            return pa.table({
                "_node": table["_node"], "_offset": offsets,
                "_bin": bins * groups + key[0].as_py(), "_used": used[bins], "_goes_on": is_open[bins] & (not last),
            })

        return frame.withColumn("_group", F.pmod("_order", F.lit(groups))).groupBy("_group").applyInArrow(
            run, "_node long, _offset long, _bin long, _used long, _goes_on boolean"
        )

    loose = stored(loose.withColumn("_node", F.monotonically_increasing_id()), "loose")
    first = loose.select("_node", F.xxhash64("_node").alias("_order"), F.col(size).alias("_size"))
    at = stored(level(first, groups, groups == 1), "level-0")
    placed = at.select("_node", F.lit(0).alias("_level"), "_bin", "_offset", "_goes_on")
    depth = 0
    while groups > 1:
        depth += 1
        bins = at.where("_goes_on").groupBy("_bin").agg(F.first("_used").alias("_size"))
        groups = max(1, -(-groups * open_bins // group))
        frame = bins.select(F.col("_bin").alias("_node"), F.xxhash64("_bin").alias("_order"), "_size")
        at = stored(level(frame, groups, groups == 1), f"level-{depth}")
        up = at.select(
            F.col("_node").alias("_bin"), F.col("_bin").alias("_up"), F.col("_offset").alias("_more"),
            F.col("_goes_on").alias("_still"), F.lit(True).alias("_moved"),
        )
        placed = placed.withColumn("_wait", F.when(F.col("_goes_on"), F.col("_bin"))).join(
            up.withColumnRenamed("_bin", "_wait"), "_wait", "left"
        ).select(
            "_node",
            F.when(F.col("_moved"), F.lit(depth)).otherwise(F.col("_level")).alias("_level"),
            F.coalesce("_up", "_bin").alias("_bin"),
            (F.col("_offset") + F.coalesce("_more", F.lit(0))).alias("_offset"),
            F.coalesce("_still", F.lit(False)).alias("_goes_on"),
        )
    # Numbers of levels, and of full pieces, don't meet: the last digits differ.
    packed = loose.join(placed, "_node").select(
        *df.columns, (F.col("_bin") * 64 + F.col("_level") + 1).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )
    full = narrow.where("_full").select(
        *df.columns, (F.monotonically_increasing_id() * 64).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)
