"""Top-k against brute force, all queries against their SQL, and the pipeline."""

import math
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from perplexis.llm import jaccard, mixing, packing, quality, queries, topk
from tests.llm import brute

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute_top(vectors, queried, k):
    out = []
    for q, vq in queried:
        scores = sorted((-sum(a * b for a, b in zip(vq, v, strict=False)), i is None, i or 0, n) for n, (i, v) in enumerate(vectors) if n != q)
        out += [(vectors[q][0], rank, None if none else i, -s) for rank, (s, none, i, _) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("shard", "block"), [(8192, 4096), (40, 7)])
def test_top_k(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-3, 4, 6) / 4).tolist()) for i in range(150)]
    rows += [rows[7], rows[50], (50, rows[3][1]), (None, rows[9][1]), (300, [0.25, 0.5]), (301, []), (400, [1e30, -1e30, 0.0])]
    bad = [(500, None), (550, [0.0, None]), (551, [float("nan")]), (552, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows[:-1] + bad], "vec_id long, embedding array<float>, id long, row long, shard string")
    quantised = topk.stored(topk.quantised(df, "vec_id", "embedding"), "vectors")
    got = topk.top_k(quantised, quantised.where((topk.F.col("id") % 50 == 0) & (topk.F.col("id") != topk.NO_ID)), 5, shard, block)
    vectors = [(i, [int(np.floor(256 * x)) for x in np.array(v, np.float32).astype(float)]) for i, v in rows[:-1]]
    queried = [(n, v) for n, (i, v) in enumerate(vectors) if i is not None and i % 50 == 0]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_top(vectors, queried, 5)
    huge = spark.createDataFrame([(i, [1e30 * (i - 1), 5.0]) for i in range(3)], "vec_id long, embedding array<double>")
    huge = topk.quantised(huge, "vec_id", "embedding")
    assert topk.top_k(huge, huge, 2).count() == 6
    none = quantised.where("false")
    assert topk.top_k(none, none, 5).isEmpty()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(frame):
    frame = frame[sorted(frame.columns)]
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted(map(repr, plain.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = queries.QUERIES[name](spark, FOLDER).toPandas(), duck.sql(queries.ORACLE[name]).df()
    assert {c: str(ours[c].dtype) for c in ours} == {c: str(theirs[c].dtype) for c in theirs}
    assert comparable(ours) == comparable(theirs)


def bigram_score(training, held):
    """Sum of log10 of ``(c(p, x) + 5 q(x)) / (c(p) + 5)``, where q is the smoothed share of a token."""
    tokens = lambda text: [None, *brute.words(text, lower=True), b""]
    single, pairs, first = Counter(), Counter(), Counter()
    for _, text in training:
        w = tokens(text)
        single.update(w[1:])
        pairs.update(zip(w, w[1:], strict=False))
        first.update(w[:-1])
    n = sum(single.values()) + len(single) + 1
    return sum(
        math.log10((pairs[p, x] + 5 * (single[x] + 1) / n) / (first[p] + 5))
        for text in held for p, x in zip(tokens(text), tokens(text)[1:], strict=False)
    )


def test_queries_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, FOLDER, "documents").collect()]
    got = queries.op4_suffix_dedup(spark, FOLDER).collect()
    expected = brute.byte_spans([t for _, t in docs], 400)
    assert {tuple(r) for r in got} == {(i, *e) for (i, _), e in zip(docs, expected, strict=True)} and len(got) == len(docs)
    got = queries.op2_quality_forest(spark, FOLDER).collect()
    assert {tuple(r)[:6] for r in got} == {(i, *brute.statistics(t)) for i, t in docs} and len(got) == len(docs)
    scores = queries.op1_recurrent_scores(spark, FOLDER).collect()
    assert all(r.held_out == (brute.in_fold(r.doc_id, 7) == 2) for r in scores) and len(scores) == len(docs)
    held = [r for r in scores if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # Better than counts of pairs, smoothed by those of single tokens.
    assert sum(r.score for r in held) > bigram_score([(i, t) for i, t in docs if brute.in_fold(i, 7) != 2], [t for i, t in docs if brute.in_fold(i, 7) == 2])


def stage(spark, name, rows):
    return dict(corpus_pipeline.STAGES)[name](spark, brute.documents(spark, rows), FOLDER)


def test_stages_one_by_one(spark):
    """Rows that each stage keeps, and what it makes of them, one by one."""
    rows = brute.odd_texts()
    pairs = [(i, t) for i, t, _ in rows]
    docs = brute.documents(spark, rows)
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())

    kept = stage(spark, "quality rules", rows)
    judged = quality.judge(docs, "doc_id", "text", quality.learn(docs, "doc_id", "text", spark.read.parquet(f"{FOLDER}/labels.parquet")))
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in judged.where("kept").collect())

    # One row of each group stays for the group's least id; rows without words or id are no group's.
    one = stage(spark, "n-gram Jaccard join", rows)
    assert one.columns == docs.columns
    names = [c for _, c in brute.components(pairs)]
    stay = {(i, g) for (i, _), g, name in zip(pairs, brute.groups(pairs), names, strict=True) if i is not None and i == name}
    assert Counter(r.doc_id for r in one.collect()) == Counter([i for i, _ in stay] + [None] * sum(i is None for i, _ in pairs))
    assert set(texts(one)) <= set(pairs)

    cut = stage(spark, "substring dedup", rows)
    assert cut.columns == docs.columns
    assert texts(cut) == Counter(
        (i, kept.decode() if gone else t) for (i, t), (_, gone, kept) in zip(pairs, brute.cut_words(pairs, 13), strict=True)
    )

    mixed = stage(spark, "mixing sources to target weights", rows)
    assert mixed.columns == docs.columns
    taken, size = Counter(), Counter()
    for r in mixing.mix(docs, "doc_id", "text", "source").collect():
        taken[r.doc_id] += r.taken
        size[r.doc_id] += r["size"]
    times = {i: round(taken[i] / size[i]) if size[i] else 1 for i in size}
    assert texts(mixed) == Counter({k: n * times[k[0]] for k, n in Counter(pairs).items() if times[k[0]]})

    placed = stage(spark, "best-fit packing", rows).collect()
    encoder = packing.Encoder()
    assert sum(r.length for r in placed) == sum(len(encoder.ids(t or "")) // 4 + 1 for _, t in pairs)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, docs.where("false"), FOLDER).isEmpty(), name


def test_stages_keep_columns_of_any_name(spark):
    """Names that the stages use inside are a table's own as well."""
    odd = ["_place", "_node", "_named", "_group", "_id", "_time", "_times", "place", "node", "group", "group_id", "group_node", "row", "times", "time", "mixed_id", "tag", "end", "size", "words", "block"]
    docs = brute.documents(spark).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(i).alias(c) for i, c in enumerate(odd)])
    for name, function in corpus_pipeline.STAGES[:-1]:
        left = function(spark, docs, FOLDER)
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert rows and all(r[c] == i for r in rows for i, c in enumerate(odd)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()


def test_rows_of_one_id_give_their_class_once(spark):
    """A third of all rows under one id: each class is computed from the rows of its own text."""
    rng = random.Random(2)
    texts = [brute.prose(rng, 40) for _ in range(60)]
    rows = [(5, t, "s") for t in texts] + [(100 + i, t + " end", "s") for i, t in enumerate(texts)] + [(300 + i, t, "s") for i, t in enumerate(texts)]
    df = brute.documents(spark, rows)
    docs = jaccard.stored(jaccard.classes_of(df, "doc_id", "text", 5), "sets")
    first = F.min(F.struct("id", "tag"))
    wanted = docs.groupBy("node").agg(first.alias("first")).select("node", "first.id", "first.tag")
    full = jaccard.full_sets(df, "doc_id", "text", wanted, 5)
    assert full.count() == docs.select("node").distinct().count() == 120
    got = jaccard.join(df, "doc_id", "text").collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (i, *e) for (i, _, _), e in zip(rows, brute.components([(i, t) for i, t, _ in rows]), strict=True)
    )


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert len(got) and (got.groupby("sequence_id").length.sum() <= packing.LENGTH).all()
    ids = {r.doc_id for r in queries.table(spark, FOLDER, "documents").collect()}
    assert set(got.doc_id) <= ids


def test_near_duplicates_of_one_id_with_other_texts(spark):
    """Rows of one id, each near to another id or to none: a row of every group stays."""
    rng = random.Random(6)
    a, b, c, d = (brute.prose(rng, 60) for _ in range(4))
    rows = [(5, a, "s"), (5, b, "s"), (5, b + " end", "s"), (3, a, "s"), (7, b, "s"), (5, c, "s"), (5, c, "s"), (8, d, "s"), (5, "", "s"), (5, None, "s"), (None, a, "s")]
    left = stage(spark, "n-gram Jaccard join", rows).collect()
    assert sorted((r.doc_id, (r.text or "").removesuffix(" end")) for r in left if r.doc_id is not None) == sorted(
        [(3, a), (5, b), (5, c), (8, d), (5, "")]
    )
    assert [r.text for r in left if r.doc_id is None] == [a]


def test_near_duplicates_keep_rows_within_spark(spark):
    """Whole rows meet their groups without passing through Python, and their texts move once."""
    rng = random.Random(8)
    a, b = brute.prose(rng, 60), brute.prose(rng, 60)
    rows = [(4, a, "s"), (2, a, "s"), (4, b, "s"), (9, b + " end", "s"), (9, "a b", "s"), (9, "A  b", "s"), (6, "", "s"), (6, None, "s"), (None, a, "t")]
    left = stage(spark, "n-gram Jaccard join", rows)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "FlatMapGroupsInArrow" not in plan
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert len(kept) == 5 and {(2, a), (4, b), (None, a)} <= set(kept)
    assert sum(i == 9 and t.lower().split() == ["a", "b"] for i, t in kept) == 1 and sum(i == 6 and not t for i, t in kept) == 1


def test_small_sources_meet_their_targets(spark, monkeypatch):
    """One large source and small ones, in blocks larger than these."""
    sizes = {"a": [500] * 40, "b": [3, 4], "c": [40] * 3, None: [7]}
    rows = [(1000 * n + i, "w " * size, s) for n, (s, all_) in enumerate(sizes.items()) for i, size in enumerate(all_)]
    monkeypatch.setattr(mixing, "BLOCKS", 64)
    got = mixing.mix(brute.documents(spark, rows), "doc_id", "text", "source").collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    assert len(got) == len(rows)
    for r in got:
        assert abs(taken[r.source] - r.target) <= 0.5 + 1e-6 and r.source_size == sum(sizes[r.source])
    mixed = stage(spark, "mixing sources to target weights", rows)
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(brute.words(r.text))
    # Documents come in whole, so that a source may miss by one of its own.
    assert all(abs(words[r.source] - r.target) <= max(sizes[r.source]) for r in got)
