"""Extendible hashing: shards under a byte limit, split bit by bit.

A row's address is 60 bits of a hash of its key. A bucket holds the rows whose
address begins with its bits; a bucket over the byte limit splits on the next
bit, any other stays. The directory has one entry for each prefix of the global
depth and points to the bucket that owns it.

All of it is DataFrame expressions. The table is read once, into narrow rows of
key, address and size, which are summed by cells of the address; the splitting
looks at prefix sums over those cells only, so that its cost follows the number
of shards. Rows take their depth by a join on the cell, whose hot keys there
are none: a cell is a share of a shard. Cells that are too large themselves
are refined by more bits, for their rows alone, until all are decided.

Defined results: a null text has no bytes; rows of equal key (repeated rows,
null keys) share an address and can't be parted by it, so that a bucket of one
address may pass the limit and is marked ``oversized``. An empty table has no
shards. Only the key and the text are read; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored

ADDRESS_BITS = 60
LIMIT_BYTES = 1 << 20
# Bits by which the cells are finer than an even split into full shards.
FINER_BITS = 3


def address(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text (null: of nothing)."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, (F.lit(ADDRESS_BITS) - depth).cast("int"))


def depths(cells: DataFrame, finest: int, known: int, limit: int) -> DataFrame:
    """Depth of each cell's shard: the least whose bucket is within the limit.

    Depths from ``known`` to ``finest`` are tried; null where even the cell is
    over the limit. Buckets of one depth are sums over cells, one small
    aggregation per depth by an expansion of the cells.
    """
    tried = cells.select(
        "cell", "n_bytes", F.explode(F.sequence(F.lit(known), F.lit(finest))).alias("depth")
    ).withColumn("bucket", F.expr(f"shiftright(cell, {finest} - depth)"))
    fits = (
        tried.groupBy("depth", "bucket").agg(F.sum("n_bytes").alias("total"))
        .where(F.col("total") <= limit).select("depth", "bucket")
    )
    best = tried.join(fits, ["depth", "bucket"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return cells.select("cell").join(best, "cell", "left")


def shards(df: DataFrame, key: str, text: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """``key, n_bytes, depth, shard, shard_bytes, shard_rows, oversized`` for every row.

    ``shard`` is the bucket's prefix in bits, as text; its length is the depth.
    """
    rows = df.select(
        F.col(key).alias("key"), address(F.col(key)).alias("bits"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    rows = stored(rows, "addresses")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    known, finest = 0, min(ADDRESS_BITS, max(0, total // limit).bit_length() + FINER_BITS)
    decided = []
    while True:
        rows = rows.withColumn("cell", prefix(F.col("bits"), finest))
        cells = rows.groupBy("cell").agg(F.sum("n_bytes").alias("n_bytes"))
        found = stored(depths(cells, finest, known, limit), "depths")
        if finest == ADDRESS_BITS:
            found = found.withColumn("depth", F.coalesce("depth", F.lit(ADDRESS_BITS)))
        at = rows.join(found, "cell")
        decided.append(at.where("depth IS NOT NULL").drop("cell"))
        if finest == ADDRESS_BITS or found.where("depth IS NULL").isEmpty():
            break
        rows = stored(at.where("depth IS NULL").drop("cell", "depth"), "addresses")
        known, finest = finest + 1, min(ADDRESS_BITS, finest + 8)
    placed = decided[0]
    for more in decided[1:]:
        placed = placed.unionByName(more)
    placed = placed.withColumn("bucket", prefix(F.col("bits"), F.col("depth")))
    sizes = placed.groupBy("depth", "bucket").agg(
        F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")
    )
    name = F.when(F.col("depth") == 0, "").otherwise(
        F.lpad(F.bin("bucket"), F.col("depth"), F.lit("0"))
    )
    return placed.join(sizes, ["depth", "bucket"]).select(
        F.col("key").alias(key), "n_bytes", F.col("depth").cast("long").alias("depth"),
        name.alias("shard"), "shard_bytes", "shard_rows",
        (F.col("shard_bytes") > limit).alias("oversized"),
    )


def directory(placed: DataFrame) -> DataFrame:
    """``entry, shard, local_depth``: each prefix of the global depth and its bucket.

    Rows of the deepest shards decide the global depth; a shard of local depth
    d owns ``2 ** (global - d)`` entries, listed by a sequence for each shard.
    """
    names = placed.select("shard", "depth").distinct()
    deepest = names.agg(F.max("depth")).first()[0] or 0
    free = F.lit(deepest) - F.col("depth")
    first = F.coalesce(F.conv(F.nullif("shard", F.lit("")), 2, 10).cast("long"), F.lit(0))
    span = F.expr(f"CAST(shiftleft(1L, CAST({deepest} - depth AS INT)) AS LONG)")
    return names.withColumn("_first", first * span).select(
        F.explode(F.sequence(F.col("_first"), F.col("_first") + span - 1)).alias("entry"),
        "shard", F.col("depth").alias("local_depth"),
    ) if deepest else names.select(F.lit(0).cast("long").alias("entry"), "shard", (free * 0).alias("local_depth"))
