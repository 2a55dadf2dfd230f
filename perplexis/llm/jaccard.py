"""Exact Jaccard join of n-gram sets in their metric space.

Jaccard distance is a metric, so a document measured against a pivot bounds its
distance to all others. Links are distances up to ``1 - threshold``; asked for is
each document's component under links.

1. Equal sets are one class, so that copies count once from here on.
2. Distance 1 to every pivot says nothing, and it is the usual case: what has
   no chance of a link goes first. In a fixed order of shingles, two linked
   sets share at least an eighth of the smaller one within their first three
   eighths, so a set whose leading shingles occur in too few other sets has no
   link. Shingles meet in buckets of packed hashes. The rest are candidates.
3. Regions: candidates that share a shingle early in the order of rarity (rarest
   first, by exact counts over candidates), where any linked pair must share one.
   Regions of the same members are one. Frequent shingles come last and so
   matter only to sets made of them. Each member knows how many of its shingles
   come before the region's: for the first one a pair shares, the rest of either
   set bounds what they have in common, so that in its region this loses no link.
4. Rounds. A region takes pivots, measures those members against them that are
   in other components, near enough in size and have enough left to share, and
   links merge components. Pivots have the fewest rarer shingles of their own:
   a text that others were made from is near to all that can link at all. The
   first pivots, one in each of a few rounds, come from the region's main
   component and draw most members into it; later ones are what is left outside. A region
   within one component is done; so are pivots, and members that have too little
   left for the smallest of the region. A very large region splits into the pivots' Voronoi cells;
   a member also enters each cell whose pivot is no farther than its own pivot
   plus twice the link distance (triangle inequality), which loses no link. A
   split that replicates more than it parts is not made. Small regions measure
   their remaining pairs across components directly.

No step caps regions, partners or candidates. Defined results: a set of fewer
words than a shingle is the whole sequence; a text without words has no shingle,
links with nothing and is its own component; rows of equal id count as one
document with several texts; null ids lend no name to a component. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.llm.components import merged
from perplexis.sources.workspace import stored

SHINGLE = 5
PERCENT = 75
BUCKET_BYTES = 8 << 20
FLUSH = 1 << 19
PIECE_BYTES = 1 << 18
STARS = 4
PIVOTS = 64
SMALL = 64
PARTED = 1 << 14
MOST_COPIES = 1.5


def sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in lower case."""
    data, offsets = columns.flat(texts)
    words = columns.Words(columns.LOWER[data], offsets)
    hashes = words.hashes()
    at, found = words.windows(hashes, shingle)
    prefix = columns.sums(hashes, 0)
    firsts = np.searchsorted(at, words.firsts)
    for i in range(words.n_texts):
        n = words.counts[i]
        if n >= shingle:
            yield np.unique(found[firsts[i] : firsts[i + 1]])
        elif n:
            yield columns.spans(prefix, words.firsts[i : i + 1], words.firsts[i + 1 : i + 2], 0)
        else:
            yield found[:0]


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of a set of size n with any it links with."""
    return -(-percent * n // 100)


def leading(n: int, percent: int) -> int:
    """How many of the first shingles must hold ``shared(n)`` common ones."""
    return min(n, n - needed(n, percent) + -(-n // 8))


def shared(n: Column, percent: int) -> Column:
    return F.ceil(F.ceil(n * percent / 100) / 8)


def n_buckets(df: DataFrame) -> int:
    """Buckets for packed hashes, by Spark's estimate of the table's size."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(16, min(1 << 20, size // BUCKET_BYTES)) if size < 1 << 60 else 64


def packed(items: Iterator[tuple[bytes, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """``bucket, keys, counts, hashes``: hashes of many keys, dealt by their low bits."""
    def flush(keys: list[bytes], parts: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(parts)
        owner = np.repeat(np.arange(len(keys)), [len(p) for p in parts])
        bucket = (columns.mix(hashes) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, owner, hashes = bucket[order], owner[order], hashes[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
        out: list[list] = [[], [], [], []]
        for start, end in zip(starts, [*starts[1:], len(bucket)], strict=True):
            own, count = np.unique(owner[start:end], return_counts=True)
            out[0].append(int(bucket[start]))
            out[1].append(b"".join([keys[i] for i in own]))
            out[2].append(count.astype(np.uint32).tobytes())
            out[3].append(hashes[start:end].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
            names=["bucket", "keys", "counts", "hashes"],
        )

    keys: list[bytes] = []
    parts: list[np.ndarray] = []
    n = 0
    for key, values in items:
        keys.append(key)
        parts.append(values)
        n += len(values)
        if n >= FLUSH:
            yield flush(keys, parts)
            keys, parts, n = [], [], 0
    if n:
        yield flush(keys, parts)


PACKED = "bucket long, keys binary, counts binary, hashes binary"


def entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(keys, owner, hashes)`` of a bucket: distinct keys, and for each hash once per key its owner."""
    join = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    keys, back = np.unique(join("keys", "V16"), return_inverse=True)
    owner = np.repeat(back, join("counts", np.uint32))
    hashes = join("hashes", np.uint64)
    again = columns.repeated(hashes)
    owner, hashes = owner[again], hashes[again]
    order = np.lexsort((owner, hashes))
    owner, hashes = owner[order], hashes[order]
    fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    return keys, owner[fresh], hashes[fresh]


def frequencies(hashes: np.ndarray) -> np.ndarray:
    """How often each of the sorted hashes occurs."""
    _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return count[back]


def named_text(text: str) -> list[Column]:
    """``tag, mark``: a text as 128 bits, in two hashes of different seeds."""
    return [F.xxhash64(text).alias("tag"), F.xxhash64(F.lit(1), text).alias("mark")]


def classes_of(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``id, tag, mark, n, node`` for every row; ``node`` names the shingle set, ``tag`` and ``mark`` the text."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), *named_text(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text", PIECE_BYTES):
                found = [(len(s), set_key(s)) for s in sets(part.column(1), shingle)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), part.column(3),
                        pa.array([n for n, _ in found], pa.int64()), pa.array([k for _, k in found], pa.binary()),
                    ],
                    names=["id", "tag", "mark", "n", "node"],
                )

    return rows.mapInArrow(run, "id long, tag long, mark long, n long, node binary")


def candidates(df: DataFrame, text: str, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The classes that can have a link at all (step 2)."""
    buckets = n_buckets(df)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((
            (set_key(s), s[: leading(len(s), percent)])
            for batch in batches for part in columns.pieces(batch, "text", PIECE_BYTES)
            for s in sets(part.column(0), shingle) if len(s)
        ), buckets)

    def count(table: pa.Table) -> pa.Table:
        keys, owner, hashes = entries(table)
        owner = owner[frequencies(hashes) > 1]
        own, n = np.unique(owner, return_counts=True)
        return pa.table({"node": pa.array([keys[i].tobytes() for i in own], pa.binary()), "common": n.astype(np.int64)})

    rows = df.select(F.col(text).alias("text")).mapInArrow(emit, PACKED)
    common = rows.groupBy("bucket").applyInArrow(count, "node binary, common long").groupBy("node").agg(
        F.sum("common").alias("common")
    )
    return classes.join(common, "node").where(F.col("common") >= shared(F.col("n"), percent)).drop("common")


def full_sets(df: DataFrame, key: str, text: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """``node, n, hashes`` of the wanted classes, each computed again from the rows of one id and text."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tag"))
    ids = wanted.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("node").alias("_node"))
    some = rows.join(ids, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag"))).select("_node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in columns.pieces(batch, "text", PIECE_BYTES):
                nodes = part.column(0).to_pylist()
                found = [(k, len(s), s.tobytes()) for k, s in zip(nodes, sets(part.column(1), shingle), strict=True) if set_key(s) == k]
                kinds = (pa.binary(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], names=["node", "n", "hashes"]
                )

    # Rows alike in id and text give a class as often.
    return some.mapInArrow(run, "node binary, n long, hashes binary").groupBy("node").agg(
        F.first("n").alias("n"), F.first("hashes").alias("hashes")
    )


def regions(full: DataFrame, buckets: int, percent: int) -> DataFrame:
    """``region, node, n, pos``: which candidates share which early shingle, their ``pos``-th (step 3)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((
            (k, np.frombuffer(h, np.uint64)) for batch in batches
            for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ), buckets)

    def count(table: pa.Table) -> pa.Table:
        keys, owner, hashes = entries(table)
        often = frequencies(hashes)
        owner, hashes, often = owner[often > 1], hashes[often > 1], often[often > 1]
        order = np.argsort(owner, kind="stable")
        owner, hashes, often = owner[order], hashes[order], often[order].astype(np.uint64)
        own, starts = np.unique(owner, return_index=True)
        ends = [*starts[1:], len(owner)]
        return pa.table({
            "node": pa.array([keys[i].tobytes() for i in own], pa.binary()),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(starts, ends, strict=False)], pa.binary()),
            "often": pa.array([often[a:b].tobytes() for a, b in zip(starts, ends, strict=False)], pa.binary()),
        })

    def early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                node, n = batch.column(0)[i], batch.column(1)[i].as_py()
                parts = batch.column(2)[i].as_py()
                hashes, often = (np.frombuffer(b"".join([p[f] for p in parts]), np.uint64) for f in ("hashes", "often"))
                # Shingles of no other candidate come first of all.
                left = n - needed(n, percent) + 1 - (n - len(hashes))
                if left > 0:
                    chosen = hashes[np.lexsort((hashes, often))][:left].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(chosen), pa.array([node.as_py()] * len(chosen), pa.binary()),
                            pa.array(np.full(len(chosen), n), pa.int64()), pa.array(np.arange(len(chosen)) + (n - len(hashes)), pa.int64()),
                        ],
                        names=["region", "node", "n", "pos"],
                    )

    counted = full.select("node", "hashes").mapInArrow(emit, PACKED).groupBy("bucket").applyInArrow(
        count, "node binary, hashes binary, often binary"
    )
    gathered = counted.groupBy("node").agg(F.collect_list(F.struct("hashes", "often")).alias("parts"))
    rows = full.select("node", "n").join(gathered, "node").select("node", "n", "parts").mapInArrow(
        early, "region long, node binary, n long, pos long"
    )
    rows = stored(rows, "shingle-regions")
    # Of regions alike, the one whose shingle comes first: it comes first in every member.
    alike = rows.groupBy("region").agg(
        F.count("*").alias("members"), F.sum("pos").alias("place"),
        F.expr("bit_xor(xxhash64(node))").alias("one"), F.expr("bit_xor(xxhash64(node, 1))").alias("two"),
    ).where("members > 1").groupBy("members", "one", "two").agg(F.min(F.struct("place", "region"))["region"].alias("region"))
    return rows.join(alike.select("region"), "region")


def measured(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """``pivot, node, common, total`` of pairs: sizes of intersection and union."""
    one = full.select(F.col("node").alias("_node"), F.col("hashes").alias("left"))
    other = full.select(F.col("node").alias("_pivot"), F.col("hashes").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                both.sort()
                same = int(np.count_nonzero(both[1:] == both[:-1]))
                common.append(same)
                total.append(len(both) - same)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                names=["pivot", "node", "common", "total"],
            )

    return pairs.join(one, F.col("node") == F.col("_node")).join(other, F.col("pivot") == F.col("_pivot")).select(
        "pivot", "node", "left", "right"
    ).mapInArrow(run, "pivot binary, node binary, common long, total long")


def joined(rows: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """``node, comp``: components of the candidates under links (step 4)."""
    labels = full.select("node", F.col("node").alias("comp"))
    link = F.col("common") * 100 >= F.col("total") * percent
    distance = 1 - F.col("common") / F.col("total")
    near = 1 - percent / 100

    def enough(common: Column, sizes: Column) -> Column:
        return common * (100 + percent) >= sizes * percent

    turn = 0
    while True:
        at = labels.select(F.col("node").alias("_n"), "comp")
        rows = rows.join(at, F.col("node") == F.col("_n")).drop("_n")
        parts = rows.groupBy("region", "comp").agg(F.count("*").alias("n_comp"), F.min("n").alias("least"))
        state = parts.groupBy("region").agg(
            F.sum("n_comp").alias("members"), F.count("*").alias("comps"), F.min("least").alias("least"),
            F.max(F.struct("n_comp", "comp"))["comp"].alias("main"),
        ).where("comps > 1").drop("comps")
        smallest = F.greatest("least", F.ceil(F.col("n") * percent / 100))
        rows = rows.join(state, "region").where(enough(F.col("n") - F.col("pos"), F.col("n") + smallest)).drop("least")
        rows = stored(rows, "open-regions")
        if rows.isEmpty():
            return labels
        star = turn < STARS
        small = rows.where(F.lit(not star) & (F.col("members") <= SMALL))
        large = rows.where(F.lit(star) | (F.col("members") > SMALL))
        # Stars first pull what they can into the main component; what is left outside is then measured against all.
        outside = F.col("comp") != F.col("main")
        order = [outside if star else ~outside, F.col("pos"), F.xxhash64("node", F.lit(turn)), F.col("node")]
        place = F.row_number().over(Window.partitionBy("region").orderBy(*order))
        most = 1 if star else PIVOTS
        pivot = [F.col("region").alias("_region"), *(F.col(c).alias(f"pivot_{c}") for c in ("node", "n", "pos", "comp"))]
        chosen = large.withColumn("place", place).where(F.col("place") <= most).select(*pivot)
        may_link = (
            (F.col("comp") != F.col("pivot_comp"))
            & (F.col("n") * 100 >= F.col("pivot_n") * percent) & (F.col("pivot_n") * 100 >= F.col("n") * percent)
            & enough(F.least(F.col("n") - F.col("pos"), F.col("pivot_n") - F.col("pivot_pos")), F.col("n") + F.col("pivot_n"))
        )
        same = F.col("region") == F.col("_region")
        asked = large.join(chosen, same & may_link).select(F.col("pivot_node").alias("pivot"), "node")
        direct = small.join(small.select(*pivot), same & may_link & (F.col("pivot_node") < F.col("node"))).select(
            F.col("pivot_node").alias("pivot"), "node"
        )
        pairs = asked.unionByName(direct)
        huge = large.where(F.lit(not star) & (F.col("members") > PARTED))
        parting = not star and not huge.isEmpty()
        if parting:
            spread = huge.join(chosen, same & (F.col("node") != F.col("pivot_node"))).select(
                "region", F.col("pivot_node").alias("pivot"), "node"
            )
            pairs = pairs.unionByName(spread.select("pivot", "node"))
        found = stored(measured(pairs.distinct(), full), "measured")
        labels = merged(labels, found.where(link).select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        done = chosen.select(F.col("_region").alias("region"), F.col("pivot_node").alias("node"))
        rows = large.select("region", "node", "n", "pos").join(done, ["region", "node"], "left_anti")
        if parting:
            rows = cells(rows, spread.join(found.select("pivot", "node", distance.alias("distance")), ["pivot", "node"]), near)
        turn += 1


def cells(rows: DataFrame, distances: DataFrame, near: float) -> DataFrame:
    """Regions parted into Voronoi cells of their pivots where that parts more than it replicates."""
    home = F.min("distance").over(Window.partitionBy("region", "node"))
    inside = distances.withColumn("home", home).where(F.col("distance") <= F.col("home") + 2 * near + 1e-9)
    size = rows.groupBy("region").agg(F.count("*").alias("members"))
    copies = inside.groupBy("region").agg(F.count("*").alias("copies"))
    parted = size.join(copies, "region").where(F.col("copies") <= MOST_COPIES * F.col("members")).select("region")
    split = rows.join(parted, "region").join(inside.select("region", "node", "pivot"), ["region", "node"]).select(
        F.xxhash64("region", "pivot").alias("region"), "node", "n", "pos"
    )
    return split.unionByName(rows.join(parted, "region", "left_anti"))


def grouped(
    df: DataFrame, key: str, text: str, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``id, tag, mark, n, node, group, component_id`` for every row.

    ``group`` tells components apart, also those of one name; null without words.
    ``tag`` and ``mark`` (``named_text``) tell the row's text.
    """
    docs = stored(classes_of(df, key, text, shingle), "shingle-sets")
    # The least id, and one text of it; null only where all are.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag"))
    classes = docs.where("n > 0").groupBy("node").agg(F.min("n").alias("n"), first.alias("first")).select(
        "node", "n", F.col("first.id").alias("id"), F.col("first.tag").alias("tag")
    )
    wanted = stored(candidates(df, text, classes, shingle, percent), "candidates")
    full = stored(full_sets(df, key, text, wanted, shingle), "candidate-sets")
    labels = joined(regions(full, n_buckets(full), percent), full, percent)
    names = labels.join(wanted.select("node", "id"), "node")
    least = names.groupBy("comp").agg(F.min("id").alias("component"))
    found = names.join(least, "comp").select("node", "comp", "component")
    named = classes.select("node", "id").join(found, "node", "left").select(
        F.col("node").alias("_node"), F.coalesce("comp", "node").alias("group"), F.coalesce("component", "id").alias("component")
    )
    return docs.join(named, F.when(F.col("n") > 0, F.col("node")) == F.col("_node"), "left").select(
        "id", "tag", "mark", "n", "node", "group",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )


def join(
    df: DataFrame, key: str, text: str, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``key, n_shingles, component_id`` for every row."""
    return grouped(df, key, text, shingle, percent).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id"
    )
