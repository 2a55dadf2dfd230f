"""Phrases whose words belong together, from a weighted de Bruijn graph over words.

Texts are split into pieces at marks of punctuation and line ends, pieces into
words. Each position of a piece starts one edge, the longest gram: the node of
its first two words leads to the node of its last two. Where the piece ends
sooner, the missing words are an end mark. Everything is per language.

Only edges are counted in the text. The count of a node (a pair of words) is its
outflow, the sum of its edges, to which the edges into the end mark belong as
the correction for pieces that end there; a word's count is the outflow of its
nodes together. Edges of many documents are summed by task, dealt to buckets by
the hash of the whole edge, so that no word, node or language gathers in one,
and summed again; nodes likewise. Buckets hold packed arrays over their own
short word lists.

Edges below ``least`` hold no candidate, nor do nodes and words below it. Among
the others, a node is unary if one edge brings all its flow and one takes all
of it away: edges that follow each other through such nodes have one count and
compact into a path, by joins whose reach doubles. Paths hold all candidates of
three words, with the counts of their inner nodes; a path's nodes tell which
pairs lie in a longer candidate.

Scores are compared in exact decimals of 38 digits, so that counts up to 10**14
may be squared. Defined results: null and empty texts have no words; a null
language is ``und``; repeated rows count each; an empty table gives no phrase;
words may be of any length. Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perplexis.llm import columns
from perplexis.operators.lookup import hot_keys_of, salted_lookup
from perplexis.sources.workspace import stored

# What parts words, and what parts pieces.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LEAST = 10
TOP = 2000
# Share of a phrase's count, in hundredths, from which a longer one replaces it.
INSIDE = 50
SCALE = 1_000_000
FLUSH = 1 << 20
BUCKET_BYTES = 8 << 20
EXACT = "decimal(14,0)"

BREAK = np.zeros(256, bool)
BREAK[list(BREAKS)] = True
APART = BREAK.copy()
APART[list(BLANKS)] = True


def n_buckets(df: DataFrame, per: int = BUCKET_BYTES) -> int:
    """Buckets for packed edges, by Spark's estimate of the table's size."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(16, min(1 << 20, size // per)) if size < 1 << 60 else 64


def chained(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(words, owner, joined)``: all words, their text, and whether the next word is in the same piece."""
    data, offsets = columns.flat(texts)
    data = columns.LOWER[data]
    inside = ~APART[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(BREAK[data])])
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (owner[1:] == owner[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])
    lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.tobytes()), pa.py_buffer(data[inside].tobytes())]
    )
    return words, owner, joined


def summed(keys: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the keys, ascending, and the sums of their weights (1 each if not given)."""
    sizes = [int(k.max(initial=0)) + 1 for k in keys]
    if math.prod(sizes) < 1 << 63:
        whole = keys[0]
        for k, size in zip(keys[1:], sizes[1:], strict=True):
            whole = whole * size + k
        order = np.argsort(whole)
    else:
        order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    if weights is None:
        sums = np.diff(np.r_[first, len(order)])
    else:
        sums = np.add.reduceat(weights[order], first) if len(first) else weights[:0]
    return [k[first] for k in keys], sums


def word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word, and behind them that of the end mark."""
    data, offsets = columns.flat(words)
    spread = columns.mix(data.astype(np.uint64) + np.uint64(1))
    found = columns.spans(columns.sums(spread, 0), offsets[:-1], offsets[1:], 0)
    return np.append(found, np.uint64(1))


def _narrow(values: np.ndarray) -> bytes:
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


PACKED = "bucket long, lang string, words binary, first binary, second binary, third binary, count binary, size long"
PACKED_NAMES = [field.split()[0] for field in PACKED.split(", ")]


def packed(lang: str, words: pa.Array, keys: list[np.ndarray], counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of ``PACKED`` for counted grams of two or three codes; the end mark's code is ``len(words)``."""
    hashes = word_hashes(words)
    seed = np.uint64(sum(lang.encode()) + 1)
    place = columns.mix(np.full(len(counts), seed))
    for key in keys:
        place = columns.mix(place + hashes[key])
    place = (place % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    place = place[order]
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])
    for a, b in zip(starts, [*starts[1:], len(place)], strict=False):
        some = order[a:b]
        own, codes = np.unique(np.concatenate([k[some] for k in keys]), return_inverse=True)
        real = own[own < len(words)]
        parts = [_narrow(x) for x in codes.reshape(len(keys), -1)]
        parts += [None] * (3 - len(keys))
        yield (
            int(place[a]), lang, b" ".join(words.take(pa.array(real)).to_pylist()), *parts, _narrow(counts[some]), len(some),
        )


def unpacked(table: pa.Table, keys: list[str]) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """``(words, codes, counts)`` of packed rows of one language, over one word list."""
    lists = [pa.array(x.split(b" "), pa.large_binary()) for x in table["words"].to_pylist()]
    encoded = pa.concat_arrays(lists).dictionary_encode()
    words, number = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
    out: list[list] = [[] for _ in keys]
    counts, at = [], 0
    sizes = table["size"].to_pylist()
    columns_of = [table[k].to_pylist() for k in keys]
    for i, (own, n, count) in enumerate(zip(lists, sizes, table["count"].to_pylist(), strict=True)):
        names = np.append(number[at : at + len(own)], len(words))
        at += len(own)
        for x, column in zip(out, columns_of, strict=True):
            x.append(names[_wide(column[i], n)])
        counts.append(_wide(count, n))
    return words, [np.concatenate(x) for x in out], np.concatenate(counts)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.binary()] * 5, pa.int64()]
    fields = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(f, k) for f, k in zip(fields, kinds, strict=True)], names=PACKED_NAMES)


def task_edges(df: DataFrame, text: str, lang: str, buckets: int) -> DataFrame:
    """``PACKED`` edges, summed over many documents of a task."""
    rows = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))

    def flush(kept: list[tuple], langs: list[str]) -> Iterator[pa.RecordBatch]:
        encoded = pa.concat_arrays([words for words, _, _ in kept]).dictionary_encode()
        words, code = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        spoken, joined = np.concatenate([x for _, x, _ in kept]), np.concatenate([x for _, _, x in kept])
        end = len(words)
        second, third = np.full(len(code), end), np.full(len(code), end)
        second[:-1] = np.where(joined[:-1], code[1:], end)
        third[:-1] = np.where(joined[:-1], second[1:], end)
        (spoken, *keys), counts = summed([spoken, code, second, third])
        edges = np.searchsorted(spoken, np.arange(len(langs) + 1))
        for name, a, b in zip(langs, edges, edges[1:], strict=False):
            yield _batch(list(packed(name, words, [k[a:b] for k in keys], counts[a:b], buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, numbers, n = [], {}, 0
        for batch in batches:
            for part in columns.pieces(batch, "text"):
                words, owner, joined = chained(part.column(1))
                spoken = [numbers.setdefault(x, len(numbers)) for x in part.column(0).to_pylist()]
                kept.append((words, np.array(spoken, np.int64)[owner], joined))
                n += len(words)
                if n >= FLUSH:
                    yield from flush(kept, list(numbers))
                    kept, numbers, n = [], {}, 0
        if n:
            yield from flush(kept, list(numbers))

    return rows.mapInArrow(run, PACKED)


GRAM = "gram_lang string, a binary, b binary, c binary, n long"


def _grams(lang: str, words: pa.Array, keys: list[np.ndarray], counts: np.ndarray) -> list[pa.Array]:
    """Columns of ``GRAM``; the end mark and absent words are null."""
    found = [words.take(pa.array(k, mask=k == len(words))).cast(pa.binary()) for k in keys]
    found += [pa.nulls(len(counts), pa.binary())] * (3 - len(keys))
    return [pa.array([lang] * len(counts), pa.string()), *found, pa.array(counts, pa.int64())]


def _by_language(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    for lang in pc.unique(table["lang"]).to_pylist():
        yield lang, table.filter(pc.equal(table["lang"], lang))


def _both(packs: list[tuple], grams: list[list[pa.Array]]) -> pa.Table:
    """Packed rows and grams under one another, the columns of the other kind null."""
    names = [field.split()[0] for field in GRAM.split(", ")]
    tables = [pa.Table.from_batches([_batch(packs)])]
    tables += [pa.table(x, names=names) for x in grams]
    kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    schema = pa.schema([*tables[0].schema, *(pa.field(n, k) for n, k in zip(names, kinds, strict=True))])
    return pa.concat_tables([*tables, schema.empty_table()], promote_options="default").select(schema.names)


def edge_sums(found: DataFrame, buckets: int, least: int) -> DataFrame:
    """``GRAM`` of the frequent edges, and ``PACKED`` partial sums of all nodes."""
    def run(table: pa.Table) -> pa.Table:
        packs, grams = [], []
        for lang, rows in _by_language(table):
            words, keys, counts = unpacked(rows, ["first", "second", "third"])
            keys, counts = summed(keys, counts)
            often = (counts >= least) & (keys[2] < len(words))
            grams.append(_grams(lang, words, [k[often] for k in keys], counts[often]))
            packs += packed(lang, words, *summed(keys[:2], counts), buckets)
        return _both(packs, grams)

    return found.groupBy("bucket").applyInArrow(run, f"{PACKED}, {GRAM}")


def node_sums(found: DataFrame, least: int) -> DataFrame:
    """``GRAM`` of the frequent nodes, and of words (``b`` null) with what their nodes here add up to."""
    names = [field.split()[0] for field in GRAM.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        tables = []
        for lang, rows in _by_language(table):
            words, keys, counts = unpacked(rows, ["first", "second"])
            keys, counts = summed(keys, counts)
            often = (counts >= least) & (keys[1] < len(words))
            tables.append(pa.table(_grams(lang, words, [k[often] for k in keys], counts[often]), names=names))
            tables.append(pa.table(_grams(lang, words, *summed(keys[:1], counts)), names=names))
        return pa.concat_tables(tables)

    return found.groupBy("bucket").applyInArrow(run, GRAM)


def graph(df: DataFrame, text: str, lang: str, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(edges, nodes, words)``: ``lang, a, b, c, n``, ``lang, a, b, n`` and ``lang, a, n``.

    Edges and nodes are those of ``least`` occurrences or more, words are all.
    """
    buckets = n_buckets(df)
    sums = stored(edge_sums(task_edges(df, text, lang, buckets), buckets, least), "edge-sums")
    edges = sums.where("bucket IS NULL").select(*_strings("a", "b", "c"), "n")
    found = stored(node_sums(sums.where("bucket IS NOT NULL").select(*PACKED_NAMES), least), "node-sums")
    nodes = found.where("b IS NOT NULL").select(*_strings("a", "b"), "n")
    words = found.where("b IS NULL").select(*_strings("a"), "n").groupBy("lang", "a").agg(F.sum("n").alias("n"))
    return edges, nodes, stored(words, "words")


def _strings(*names: str) -> list[Column]:
    return [F.col("gram_lang").alias("lang"), *(F.col(c).cast("string").alias(c) for c in names)]


def paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``path, place, lang, a, b, c, n, n_left, n_right``: edges by their place in their unary path.

    ``n_left`` and ``n_right`` are the counts of the nodes ``a b`` and ``b c``.
    """
    left = nodes.select("lang", "a", "b", F.col("n").alias("n_left"))
    right = nodes.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_right"))
    rows = edges.join(left, ["lang", "a", "b"]).join(right, ["lang", "b", "c"])
    rows = stored(rows.withColumn("edge", F.monotonically_increasing_id()), "edges")
    # An edge that is all of a node's flow is the only one on that side of it.
    into = rows.where("n = n_right").select("lang", F.col("b").alias("a"), F.col("c").alias("b"), F.col("edge").alias("head"))
    out = rows.where("n = n_left").select("lang", "a", "b", "edge")
    up = stored(out.join(into, ["lang", "a", "b"]).select("edge", "head", F.lit(1).alias("place")), "links")
    while True:
        # Every piece begins somewhere, so that no ring is unary throughout: reach doubles until heads are first edges.
        more = up.select(F.col("edge").alias("_edge"), F.col("head").alias("_head"), F.col("place").alias("_place"))
        further = stored(up.join(more, F.col("head") == F.col("_edge"), "left"), "reach")
        up = further.select(
            "edge", F.coalesce("_head", "head").alias("head"), (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place")
        )
        if further.where("_head IS NOT NULL").isEmpty():
            break
    return rows.join(up, "edge", "left").select(
        F.coalesce("head", "edge").alias("path"), F.coalesce("place", F.lit(0)).alias("place"),
        "lang", "a", "b", "c", "n", "n_left", "n_right",
    )


def compacted(placed: DataFrame) -> DataFrame:
    """``lang, words, n, n_left, n_right``: every path as one phrase, with the counts of its two end nodes."""
    inner = F.struct("place", "a", "b", "c", "n_left", "n_right")
    rows = placed.groupBy("path").agg(
        F.first("lang").alias("lang"), F.first("n").alias("n"), F.array_sort(F.collect_list(inner)).alias("edges")
    )
    first, last = F.element_at("edges", 1), F.element_at("edges", -1)
    return rows.select(
        "lang", F.concat(F.array(first["a"], first["b"]), F.col("edges.c")).alias("words"), "n",
        first["n_left"].alias("n_left"), last["n_right"].alias("n_right"),
    )


def candidates(phrases: DataFrame, nodes: DataFrame, least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """``lang, phrase, first, last, a, left, right`` of the phrases of two and three words that stay.

    ``left`` and ``right`` are the counts of a longer phrase without its last
    and its first word, null for two words.
    """
    size = F.size("words")
    windows = phrases.select("*", F.explode(F.sequence(F.lit(1), size - 2)).alias("at")).select(
        "lang", F.slice("words", F.col("at"), 3).alias("words"), "n",
        F.when(F.col("at") == 1, F.col("n_left")).otherwise(F.col("n")).alias("left"),
        F.when(F.col("at") == size - 2, F.col("n_right")).otherwise(F.col("n")).alias("right"),
    )
    triples = windows.select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("words")[0].alias("first"),
        F.col("words")[2].alias("last"), F.col("n").alias("a"), "left", "right",
    )
    # Every node of a path lies in a longer candidate of the path's count.
    held = phrases.select("lang", "n", "words", F.explode(F.sequence(F.lit(0), size - 2)).alias("at")).groupBy(
        "lang", F.get("words", F.col("at")).alias("a"), F.get("words", F.col("at") + 1).alias("b")
    ).agg(F.max("n").alias("longer"))
    pairs = nodes.where(F.col("n") >= least).join(held, ["lang", "a", "b"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("n"))
    ).select(
        "lang", F.concat_ws(" ", "a", "b").alias("phrase"), F.col("a").alias("first"), F.col("b").alias("last"),
        F.col("n").alias("a"), F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"),
    )
    return triples.unionByName(pairs)


def _word_key(word: str) -> Column:
    """Language and word: a word holds no tab, so that the last one parts them."""
    return F.concat(F.col("lang"), F.lit("\t"), F.col(word))


def _exact(name: str) -> Column:
    return F.col(name).cast(EXACT)


def scored(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``l, r, score`` of the lowest-scoring cut, the first of equals."""
    rows = stored(rows.withColumns({"at_first": _word_key("first"), "at_last": _word_key("last")}), "candidates")
    hot = {side: hot_keys_of(rows, f"at_{side}") for side in ("first", "last")}
    for side, keys in hot.items():
        # Words that start or end many candidates are dealt out.
        table = words.select(_word_key("a").alias(f"at_{side}"), F.col("n").alias(f"n_{side}"))
        rows = salted_lookup(rows, table, f"at_{side}", keys)

    def cut(place: int, l: str, r: str) -> Column:
        score = (_exact("a") * _exact("a") * F.lit(SCALE).cast("decimal(7,0)"), _exact(l) * _exact(r))
        floor = F.call_function("div", *score)
        return F.struct(floor.alias("score"), F.lit(place).alias("place"), F.col(l).alias("l"), F.col(r).alias("r"))

    pair = cut(1, "n_first", "n_last")
    triple = F.least(cut(1, "n_first", "right"), cut(2, "left", "n_last"))
    return rows.withColumn("_cut", F.when(F.col("left").isNull(), pair).otherwise(triple)).select(
        "lang", "phrase", "a", *(F.col(f"_cut.{c}").alias(c) for c in ("l", "r", "score"))
    )


def collocations(df: DataFrame, text: str, lang: str, least: int = LEAST, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    edges, nodes, words = graph(df, text, lang, least)
    phrases = stored(compacted(paths(edges, nodes)), "paths")
    found = scored(candidates(phrases, nodes, least, inside), words.where(F.col("n") >= least))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
