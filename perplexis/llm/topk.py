"""Exact top-k by inner product: ball-tree branch and bound in every shard.

Rows are dealt to shards of bounded size by a hash; a shard is a ball tree of
integer vectors. A query searches a tree best-first: a node's bound is
``<query, centre> + |query| * radius``, a node is dropped when its bound is below
the query's kth score so far, and the search ends with the first such node.

The kth score is shared between shards: a query first searches one shard, its
home, and takes that kth score into all others, which then return only rows
that can still enter. Queries are blocked, so that a task holds one shard and
one block whatever the number of queries.

Defined results: vectors that are null, or hold null or non-finite components,
take no part; missing components of shorter vectors are 0; ties go to the
smaller id, null ids last; a repeated row is a candidate of its twin, and a
repeated query answers once for each row. Scores outside 64 bits stop at the
bound. An empty table gives no rows. Only id and vector are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored

SCALE = 256
LEAF = 64
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
EXACT = float(1 << 53)
NO_ID = (1 << 63) - 1


def quantised(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, row, vector`` of the rows that take part; ``row`` tells repeated rows apart."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(vector).isNotNull() & sound).select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.transform(parts, lambda x: F.floor(x * SCALE).cast("long")).alias("vector"),
    )


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of the width, filled up with zeros."""
    lists = lists.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


class BallTree:
    """Nodes in arrays; the rows of a node are a stretch of ``order``."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        values = rows.astype(np.float64)
        self.order = np.arange(len(rows))
        self.centres, self.radii, self.stretches, self.children = [], [], [], []
        waiting = [(0, len(rows), -1)]
        while waiting:
            start, end, parent = waiting.pop()
            at = len(self.radii)
            part = values[self.order[start:end]]
            centre = part.mean(axis=0)
            far = np.sqrt(((part - centre) ** 2).sum(axis=1))
            self.centres.append(centre)
            self.radii.append(far.max())
            self.stretches.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(at)
            if end - start > LEAF and far.max() > 0:
                # Along the line from the row farthest out to the one farthest from it.
                one = part[far.argmax()]
                other = part[((part - one) ** 2).sum(axis=1).argmax()]
                side = np.argsort(part @ (other - one), kind="stable")
                self.order[start:end] = self.order[start:end][side]
                middle = (start + end) // 2
                waiting += [(start, middle, at), (middle, end, at)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.norm = float(np.sqrt((values**2).sum(axis=1).max(initial=0)))

    def bounds(self, nodes: list[int], query: np.ndarray, norm: float) -> list[float]:
        raw = self.centres[nodes] @ query + norm * self.radii[nodes]
        return (raw + 1 + norm * self.norm * 1e-9).tolist()  # above any rounding

    def search(self, query: np.ndarray, k: int, ids: np.ndarray, own: int, kth: float) -> list[tuple]:
        """``(score, -id, place)`` of the k best with at least ``kth``, without place ``own``."""
        as_float = query.astype(np.float64)
        norm = float(np.sqrt(as_float @ as_float))
        exact = norm * self.norm < EXACT / 4
        best: list[tuple] = []
        heap = [(-self.bounds([0], as_float, norm)[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if self.children[node]:
                for b, child in zip(self.bounds(self.children[node], as_float, norm), self.children[node], strict=True):
                    if b >= kth:
                        heapq.heappush(heap, (-b, child))
                continue
            start, end = self.stretches[node]
            places = self.order[start:end]
            part = self.rows[places]
            if exact:
                scores = (part.astype(np.float64) @ as_float).astype(np.int64)
            else:
                exactly = part.astype(object) @ query.astype(object)
                scores = np.clip(exactly, -(1 << 63), (1 << 63) - 1).astype(np.int64)
            for i in np.flatnonzero(scores >= kth):
                if places[i] == own:
                    continue
                entry = (int(scores[i]), -int(ids[places[i]]), int(places[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    kth = max(kth, best[0][0])
        return best


def _search(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Queries (``left``) against one shard (``right``)."""
    out: list[tuple] = []
    if len(left) and len(right):
        width = max(max((len(v) for v in t["vector"]), default=0) for t in (left, right))
        queries, rows = matrix(left["vector"], max(width, 1)), matrix(right["vector"], max(width, 1))
        ids, numbers = right["id"].to_numpy(), right["row"].to_numpy()
        tree = BallTree(rows)
        place = dict(zip(numbers.tolist(), range(len(numbers)), strict=True))
        for i, (q, n, kth) in enumerate(zip(left["id"].to_pylist(), left["row"].to_pylist(), left["kth"].to_pylist(), strict=True)):
            for score, minus, at in tree.search(queries[i], k, ids, place.get(n, -1), -np.inf if kth is None else kth):
                out.append((q, n, -minus, int(numbers[at]), score))
    parts = list(zip(*out, strict=True)) or [[]] * 5
    names = ["query", "query_row", "id", "row", "score"]
    return pa.table({n: pa.array(p, pa.int64()) for n, p in zip(names, parts, strict=True)})


def top_k(
    rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block: int = BLOCK_QUERIES
) -> DataFrame:
    """``query_id, rank, vec_id, score`` over tables as ``quantised`` makes them.

    A query is left out of its own candidates by its ``row``.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    queries = queries.withColumn("home", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)))
    schema = "query long, query_row long, id long, row long, score long"

    def run(left: DataFrame, right: DataFrame) -> DataFrame:
        keys = ["shard", "block"]
        # Queries come from the rows: new names for the same columns, or they would be taken for those.
        left = left.select(*(F.col(c).alias(c) for c in left.columns))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            lambda a, b: _search(a, b, k), schema
        )

    order = [F.col("score").desc(), F.col("id"), F.col("row")]
    one = F.lit(0).cast("long")
    first = stored(run(
        queries.select("id", "row", "vector", F.lit(None).cast("double").alias("kth"), F.col("home").alias("shard"), one.alias("block")),
        rows.select("id", "row", "vector", "shard", one.alias("block")),
    ), "top-home")
    kth = (
        first.withColumn("place", F.row_number().over(Window.partitionBy("query_row").orderBy(*order)))
        .where(F.col("place") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("kth"))
    )
    found = first
    if shards > 1:
        waiting = queries.join(kth, "row", "left").withColumn("block", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)))
        others = waiting.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
        everywhere = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
        found = first.unionByName(run(
            others.where("shard <> home").select("id", "row", "vector", "kth", "shard", "block"),
            everywhere.select("id", "row", "vector", "shard", "block"),
        ))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select(
        F.nullif("query", F.lit(NO_ID)).alias("query_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif("id", F.lit(NO_ID)).alias("vec_id"), "score",
    )
