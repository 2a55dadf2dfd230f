"""First-fit decreasing over a tournament tree, in randomised groups of documents.

A document's token ids, with one end id after them, fill whole sequences as far
as they go; what is left over, less than a sequence, is packed. Left-overs are
dealt at random to groups of about ``GROUP``, whose number follows the corpus,
and each group is packed on its own: no group waits for another and none grows.

Within a group the pieces come in falling size. A tournament tree over the bins
holds the greatest free space below each node, so that the first bin that takes a
piece is found from the root down. Bins that stay part-filled are then evened
out, since pieces may be cut: the emptiest give their tokens to the fullest until
one is left. A sequence is padded unless its length is a power of two, so that
the last one is cut into powers of two: nothing is padded at all, at the cost of a
few short sequences a group.

Where pieces are cut is known only after packing, so ids travel with the
left-overs (two bytes each) and are hashed there.

Defined results: a null or empty text is the end id alone; repeated rows and ids
are packed as separate documents; an empty table gives no pieces; the key passes
through with its own type, nulls included. Only the two named columns are read.
A very long text is tokenised whole.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored

LENGTH = 2048
END_ID = 1
GROUP = 8192
TOKENIZER = "word_bpe_49k"
CACHED = 400_000
# How the tokenizer parts a chunk without white space into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Printable characters up to U+017F: already composed, and lower-cased one by one.
SIMPLE = regex.compile("[\x21-\x7e\xa1-\xac\xae-ſ]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it prints, else one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Words(dict):
    """Ids of single words in lower case, by the tokenizer's model alone."""

    def __init__(self, model, kind: str):
        self.model, self.kind, self.characters = model, kind, byte_characters()

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join([self.characters[b] for b in word.encode()])
        found = array(self.kind, [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if len(self) >= CACHED:
            self.clear()
        self[word] = found
        return found


class Encoder(dict):
    """Ids of texts as ``tokenizers`` gives them with ``add_special_tokens=False``.

    The tokenizer drops white space, and no token reaches across it: ids of the
    chunks between spaces can be remembered. The memory is cleared when full.
    Chunks of common characters are parted into words here, others (marks that
    compose, names of special tokens) go through the whole tokenizer.
    """

    def __init__(self, name: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.kind = "H" if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.words = Words(self.whole.model, self.kind)
        self.special = regex.compile("|".join(
            regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()
        ) or "(?!)")

    def __missing__(self, chunk: str) -> bytes:
        if SIMPLE.fullmatch(chunk) and not self.special.search(chunk):
            found = b"".join(map(self.words.__getitem__, WORD.findall(chunk.lower())))
        else:
            found = array(self.kind, self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(self) >= CACHED:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        chunks = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, chunks)), f"<u{array(self.kind).itemsize}")


@cache
def encoder(name: str) -> Encoder:
    """One for each worker, so that tasks after the first find its memory filled."""
    return Encoder(name)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_documents(df: DataFrame, key: str, text: str, length: int, tokenizer: str) -> DataFrame:
    """``key, doc_tokens, start, length, ids_crc32, ids, row``: full sequences, and left-overs with their ids."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in batches:
            owner, out = [], []
            for i, t in enumerate(batch.column(1)):
                ids = known.ids(t.as_py() or "")
                ids = np.append(ids, ids.dtype.type(END_ID))
                n = len(ids)
                for start in range(0, n, length):
                    part = ids[start : start + length]
                    whole = len(part) == length
                    owner.append(i)
                    out.append((n, start, len(part), crc(part) if whole else None, None if whole else part.tobytes()))
            fields = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(f, pa.int64()) for f in fields[:4]),
                 pa.array(fields[4], pa.binary())],
                names=["key", "doc_tokens", "start", "length", "ids_crc32", "ids"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(run, f"key {kind}, doc_tokens long, start long, length long, ids_crc32 long, ids binary")
    return found.withColumn("row", F.monotonically_increasing_id())


class Tournament:
    """Bins in a row; each inner node holds the greatest free space below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """The first bin with room for ``size``, which it takes."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        leaf = at
        free[at] -= size
        while at > 1:
            at //= 2
            most = max(free[2 * at], free[2 * at + 1])
            if free[at] == most:
                break
            free[at] = most
        return leaf - self.leaves


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Pieces of each bin, in the order in which they came; equal sizes by position."""
    tree, bins = Tournament(len(sizes), capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        at = tree.put(int(sizes[i]))
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


Part = tuple[int, int, int]  # piece, first token in it, tokens


def evened(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[Part]]:
    """The bins with part-filled ones evened out: all full, but for powers of two at the end."""
    parts = [[(i, 0, int(sizes[i])) for i in lot] for lot in bins]
    used = [sum(p[2] for p in lot) for lot in parts]
    some = sorted((b for b in range(len(parts)) if used[b] < capacity), key=lambda b: (used[b], b))
    low, high = 0, len(some) - 1
    while low < high:
        giver, taker = parts[some[low]], some[high]
        piece, first, n = giver.pop()
        moved = min(n, capacity - used[taker])
        if moved < n:
            giver.append((piece, first, n - moved))
        parts[taker].append((piece, first + n - moved, moved))
        used[taker] += moved
        high -= used[taker] == capacity
        low += not giver
    done = [lot for b, lot in enumerate(parts) if lot and used[b] == capacity]
    for b in some[low : high + 1]:
        if used[b] < capacity:
            done += in_powers(parts[b])
    return done


def in_powers(parts: list[Part]) -> list[list[Part]]:
    """Parts cut into sequences whose lengths are the powers of two of their sum, greatest first."""
    total, waiting, out = sum(n for _, _, n in parts), parts[::-1], []
    for power in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << power)
        if room:
            out.append([])
        while room:
            piece, first, n = waiting.pop()
            taken = min(n, room)
            out[-1].append((piece, first, taken))
            if taken < n:
                waiting.append((piece, first + taken, n - taken))
            room -= taken
    return out


def pack(
    df: DataFrame, key: str, text: str, length: int = LENGTH, group: int = GROUP, tokenizer: str = TOKENIZER
) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece of every row."""
    cut = stored(cut_documents(df, key, text, length, tokenizer), "pieces")
    loose = cut.where("ids IS NOT NULL")
    groups = max(1, -(-loose.count() // group))
    kind = cut.schema["key"].dataType.simpleString()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(number: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        sizes, starts, totals = (table[c].to_numpy() for c in ("length", "start", "doc_tokens"))
        ids = table["ids"].combine_chunks()
        out: list[tuple] = []
        for at, lot in enumerate(evened(first_fit_decreasing(sizes, length), sizes, length)):
            offset = 0
            for piece, first, n in lot:
                data = ids[piece].as_buffer()
                whole = np.frombuffer(data, f"<u{len(data) // int(sizes[piece])}")
                out.append((
                    piece, starts[piece] + first, n, crc(whole[first : first + n]), totals[piece],
                    number[0].as_py() << 32 | at, offset,
                ))
                offset += n
        fields = list(zip(*out, strict=True)) or [[]] * 7
        keys = table["key"].combine_chunks().take(pa.array(fields[0], pa.int64()))
        return pa.table([keys, *(pa.array(f, pa.int64()) for f in fields[1:])], names=names)

    dealt = loose.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInArrow(run, f"key {kind}, " + ", ".join(f"{c} long" for c in names[1:]))
    # Numbers of full pieces are negative, those of groups aren't.
    full = cut.where("ids IS NULL").select(
        "key", "start", "length", "ids_crc32", "doc_tokens",
        (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full).withColumnRenamed("key", key)
