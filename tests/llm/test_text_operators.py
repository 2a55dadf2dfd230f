"""Operators on documents against brute force, with odd rows, and on empty tables."""

import hashlib
import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perplexis.llm import columns, debruijn, jaccard, langid, lm, mixing, packing, quality, queries, sharding, suffixes
from tests.llm import brute

ROWS = brute.odd_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return brute.documents(spark).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return brute.documents(spark, [])


def found(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_words_lines_and_windows():
    texts = pa.array([t for _, t, _ in ROWS])
    data, offsets = columns.flat(texts)
    assert columns.Words(data, offsets).counts.tolist() == [len(brute.words(t)) for _, t, _ in ROWS]
    got = quality.statistics(texts)
    assert [tuple(r) for r in got.tolist()] == [brute.statistics(t) for _, t, _ in ROWS]
    odd = ["a\na\n\na\nb", "\na", "a", "\n", None, "x y\nx  y\nx y", "\n\na\n\na\n"]
    assert quality.statistics(pa.array(odd))[:, 3].tolist() == [brute.statistics(t)[3] for t in odd]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(100 + i, int(i % 9 > 0), 0) for i in range(60)] + [(None, 1, 0), (101, None, 0)], "doc_id long, quality int, toxic int")
    forests = quality.learn(docs, "doc_id", "text", labels)
    got = quality.judge(docs, "doc_id", "text", forests)
    assert found(got, "doc_id", *quality.STATS) == Counter((i, *brute.statistics(t)) for i, t, _ in ROWS)
    for r in got.collect():
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.keep(docs, "text", forests)
    assert kept.columns == docs.columns and found(kept, "doc_id") == found(got.where("kept"), "doc_id")
    assert quality.learn(none, "doc_id", "text", labels) == [] and quality.judge(none, "doc_id", "text", []).isEmpty()


def test_forest_tells_outliers():
    rng = np.random.default_rng(0)
    good = np.stack([np.full(400, 200), rng.integers(950, 1050, 400), np.zeros(400), np.zeros(400), rng.integers(0, 30, 400)], axis=1).astype(int)
    bad = good[:40].copy()
    bad[:, 2] = rng.integers(100, 300, 40)
    forests = quality.fit(good[:200], bad[:20])
    assert quality._verdicts(forests, good[200:])[1].mean() > 0.98 and not quality._verdicts(forests, bad[20:])[1].any()
    assert quality.fit(good[:1], bad) == []


def test_forest_learns_from_every_labelled_row(spark, monkeypatch):
    rng, n = np.random.default_rng(3), 7000
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) + (" #$%" * 30 if i % 50 == 0 else "") for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 50 > 0)) for i in range(n)], "doc_id long, quality int")
    roots, original = [], quality.Growing.grow

    def watched(self, found):
        if self.open == {0: 0}:
            roots.append((len(self.columns), found[0][0]))
        original(self, found)

    monkeypatch.setattr(quality.Growing, "grow", watched)
    forests = quality.learn(docs, "doc_id", "text", labels)
    trees = [rows for width, rows in roots if width == 4]
    assert len(trees) == quality.TREES and sum(trees) >= n and max(trees) < 3 * quality.TREE_ROWS
    got = quality.judge(docs, "doc_id", "text", forests).select("doc_id", "kept").collect()
    # Thresholds hold over all good rows.
    lost = sum(not r.kept for r in got if r.doc_id % 50)
    assert forests and lost <= len(forests) * quality.MAX_GOOD_REJECTED * n
    assert not any(r.kept for r in got if r.doc_id % 50 == 0)


def test_rows_are_in_a_tree_at_least():
    for n_good, n_bad in ((2, 0), (300, 5), (10**6, 10**5)):
        for share in quality.shares_of(n_good, n_bad):
            places = np.linspace(0, 1, 997, endpoint=False)
            held = sum(((places - i / quality.TREES) % 1.0 < share).astype(int) for i in range(quality.TREES))
            assert held.min() >= 1


def test_shards(spark, docs, none):
    got = sharding.shards(docs, "doc_id", "text", limit=4000).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t, _ in ROWS)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.n_bytes
    for r in got:
        assert len(r.shard) == r.depth and r.shard_bytes == sizes[r.shard] and r.oversized == (r.shard_bytes > 4000)
        if r.oversized:  # one address
            assert r.depth == sharding.ADDRESS_BITS and len({x.doc_id for x in got if x.shard == r.shard}) == 1
        elif r.depth:  # the bucket one bit up was over the limit
            assert sum(x.n_bytes for x in got if x.shard.startswith(r.shard[:-1])) > 4000
    few = sharding.shards(docs.where("doc_id >= 100"), "doc_id", "text", limit=4000)
    listed = sharding.directory(few).collect()
    depth = max(r.local_depth for r in listed)
    assert sorted(r.entry for r in listed) == list(range(2**depth))
    assert all(format(r.entry, f"0{depth}b").startswith(r.shard) for r in listed)
    assert sharding.shards(none, "doc_id", "text").isEmpty()
    plan = few._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_tokens_are_those_of_the_tokenizer():
    import public_tokenizers
    import tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder()
    odd = [" a", "a ", "a  b", "a\n b", "a \nb", "\t", "it's 'twas", "a  b", "　x y", "don 't", "x \x1c y", "<|endoftext|>a <|endoftext|>"]
    for text in [t or "" for _, t, _ in ROWS] + odd:
        for _ in range(2):
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, length):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by_sequence)


def test_pieces_and_packing(spark, docs, none):
    got = packing.pack(packing.pieces(docs, "doc_id", "text", length=256), "length", length=256).collect()
    encoder = packing.Encoder()
    expected = Counter()
    for i, t, _ in ROWS:
        ids = [*np.frombuffer(encoder.ids(t or ""), "<u4").tolist(), 0]
        head = len(ids) % 256 or 256
        cuts = [0, *range(head, len(ids), 256), len(ids)] if len(ids) > 256 else [0, len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    total = sum(r.length for r in got)
    assert check_packing(got, 256) <= 1.05 * total / 256 + 1
    assert packing.pack(packing.pieces(none, "doc_id", "text"), "length").isEmpty()


@pytest.mark.parametrize(("group", "open_bins"), [(150, 20), (100_000, 16), (1000, 500)])
def test_packing_in_groups_and_rounds(spark, group, open_bins):
    length = F.floor(F.pmod(F.xxhash64("id"), F.lit(200)) * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) / 9) + 1
    rows = spark.range(3000).select(F.col("id").alias("n"), length.alias("length"))
    got = packing.pack(rows, "length", 256, open_bins, group).collect()
    assert sorted(r.n for r in got) == list(range(3000))
    assert check_packing(got, 256) <= 1.08 * sum(r.length for r in got) / 256


def test_packer_takes_the_tightest_and_closes_the_fullest():
    packer = packing.Packer(10, 2)
    assert [packer.put(s) for s in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert packer.n_open == 0
    packer = packing.Packer(10, 2)
    assert [packer.put(s) for s in (6, 7, 5, 3)] == [(0, 0), (1, 0), (2, 0), (0, 6)]  # bin 1 has closed


def test_mix(spark, docs, none):
    got = mixing.mix(docs, "doc_id", "text", "source").collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((i, len(brute.words(t)), s) for i, t, s in ROWS)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = left / sum(weights[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and share * weights[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for r in got:
        target = 3 * sizes[r.source] if r.source in capped else share * weights[r.source]
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target, rel_tol=1e-9)
        assert abs(taken[r.source] - target) <= 0.5 + 1e-6
        assert (r.first_slot < 0) <= (r.taken == 0 or r.target < 50)
    again = mixing.mix(docs.repartition(5), "doc_id", "text", "source").collect()
    assert Counter(got) == Counter(again)
    assert mixing.mix(none, "doc_id", "text", "source").isEmpty()
    wordless = mixing.mix(docs.where("text IS NULL OR text = ''"), "doc_id", "text", "source").collect()
    assert all(r.taken == r["size"] == r.target == 0 for r in wordless) and wordless


def test_schedule_spreads_every_source(spark, docs, monkeypatch):
    """Slots are the blocks of each pass in turn, each source's evenly over all points."""
    monkeypatch.setattr(mixing, "BLOCKS", 64)
    goals, _ = mixing.lines(mixing.sizes(docs, "doc_id", "text", "source"))
    sized = mixing.slots_of(goals)
    slots = {r.source: r for r in sized.collect()}
    by_source = {}
    for r in mixing.schedule(sized).orderBy("slot").collect():
        by_source.setdefault(r.source, []).append(r)
    total = sum(r.slots for r in slots.values())
    for source, rows in by_source.items():
        s = slots[source]
        assert [(r["rank"], r["pass"], r.block) for r in rows] == [(i, i // s.n_blocks, i % s.n_blocks) for i in range(s.slots)]
        for r in rows:
            assert abs(r.slot * s.slots / total - r["rank"]) <= 8
    assert set(by_source) == {k for k, r in slots.items() if r.slots}


@pytest.mark.parametrize("seed", [0, 1])
def test_substrings_of_bytes(spark, seed, monkeypatch):
    import random

    rng = random.Random(seed)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randrange(5, 60))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 9))), None) for i in range(60)] + [(3, None, None), (None, "ab" * 60, None), (5, "aaaa" * 30, None)]
    monkeypatch.setattr(suffixes, "SHARD_STRINGS", 40 if seed else 20_000)
    texts = suffixes.keyed(brute.documents(spark, rows), "doc_id", "text")
    got = suffixes.repeated_windows(texts, length=24, gram=6, width=5)
    flags = defaultdict(set)
    for r in got.collect():
        flags[r.id, r.tag] |= set(range(r["first"], r["last"] + 1))
    data = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(d[i : i + 24] for d in data for i in range(len(d) - 23))
    for (i, _, _), d in zip(rows, data, strict=True):
        key = (suffixes.NO_ID if i is None else i, zlib.crc32(d))
        assert flags[key] == {j for j in range(len(d) - 23) if seen[d[j : j + 24]] > 1}


def test_collection_equals_sorted_suffixes(tmp_path):
    rng = np.random.default_rng(1)
    strings = [rng.integers(97, 100, n).astype(np.uint16) for n in (0, 1, 5, 30, 30, 41)] + [np.array([97, 98, 300, 99], np.uint16)] * 2
    built = suffixes.Collection(strings, 7, str(tmp_path))
    _, common, place = built.read()
    suffix = lambda i, j: tuple(strings[i][j:].tolist())
    owner = np.searchsorted(built.begin, place, "right") - 1
    # Empty strings share their place with the next; they stand first.
    rows = sorted((suffix(i, j), i, j) for i in range(len(strings)) for j in range(len(strings[i]) + 1))
    assert len(place) == len(rows)
    shared = [0]
    for (a, _, _), (b, _, _) in zip(rows, rows[1:], strict=False):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        shared.append(sum(7 if x >= 256 else 1 for x in a[:n]))
    assert common.tolist() == shared and len(owner) == len(rows)


def test_suffix_summary(spark, docs, none):
    got = suffixes.summary(docs, "doc_id", "text", length=100)
    expected = brute.byte_spans([t for _, t, _ in ROWS], 100)
    assert found(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(
        (i, *e) for (i, _, _), e in zip(ROWS, expected, strict=True)
    )
    assert suffixes.summary(none, "doc_id", "text").isEmpty()


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    monkeypatch.setattr(columns, "PIECE_BYTES", 700)
    texts = [t for _, t, _ in ROWS if t][:14]
    data = pa.record_batch({"text": texts})
    seen = Counter()
    for rows, part, offsets, skipped in suffixes.chunks(data, "text", 100):
        (owner, first, last, _), _ = suffixes.anchors(part, offsets, 100, 32)
        for o, a, b in zip(owner, first, last, strict=True):
            seen.update((rows["text"][o].as_py(), i - offsets[o] + skipped) for i in range(a, b + 1))
    assert seen == Counter((t, i) for t in texts for i in range(len(t.encode()) - 99))


def test_de_bruijn(spark, docs, none):
    rows = [(i, t) for i, t, _ in ROWS]
    got = debruijn.summary(docs, "doc_id", "text")
    expected = Counter((i, *e) for (i, _), e in zip(rows, brute.word_spans(rows, 13), strict=True))
    assert found(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    left = debruijn.remove(docs, "doc_id", "text")
    assert left.columns == docs.columns and left.count() == len(rows)
    assert debruijn.summary(none, "doc_id", "text").isEmpty() and debruijn.remove(none, "doc_id", "text").isEmpty()


def test_tables_of_powers_stay_short():
    """Powers of a long text come from short tables, and are the powers."""
    values = np.ones(3 * columns.COLUMN + 5, np.uint64)
    base, inverse = columns._base(7)
    raised = [pow(base, i, 1 << 64) for i in range(len(values))]
    assert columns.powers(len(values), 7).tolist() == raised
    assert columns.inverse_powers(np.arange(len(values)), len(values), 7).tolist() == [pow(inverse, i, 1 << 64) for i in range(len(values))]
    assert columns.sums(values, 7).tolist() == [0, *(int(x) for x in np.cumsum(np.array(raised, np.uint64)))]
    columns.sums(np.ones(1 << 21, np.uint64), 7)
    assert sum(len(t) for tables in columns._powers.values() for t in tables) < 1 << 17


def test_texts_move_once_where_passages_go(spark, docs, monkeypatch):
    """Beside its text a row holds its other columns only, and all come out as they were."""
    asked, cut = [], debruijn.cut
    monkeypatch.setattr(debruijn, "cut", lambda texts, *others: asked.append(texts.schema) or cut(texts, *others))
    left = debruijn.remove(docs, "doc_id", "text")
    assert [c for c in docs.columns if c != "text"] == asked[0]["row"].dataType.names
    rows = [(i, t) for i, t, _ in ROWS]
    assert found(left, "doc_id", "text", "source") == Counter(
        (i, kept.decode() if gone else t, s) for (i, t, s), (_, gone, kept) in zip(ROWS, brute.cut_words(rows, 13), strict=True)
    )


def test_paths_join_runs_that_always_follow(spark):
    # Source 0 holds [0, 4), source 1 [7, 9); documents 5 and 6 take one after the other.
    runs = [(5, 0, 0, 4, 0, 0, 0), (5, 0, 4, 2, 1, 0, 7), (6, 0, 10, 4, 0, 0, 0), (6, 0, 14, 2, 1, 0, 7), (7, 0, 0, 3, 2, 0, 0)]
    got = debruijn.paths(spark.createDataFrame(runs, ", ".join(f"{c} long" for c in debruijn.RUN))).collect()
    paths = {(r.source_id): r.path for r in got}
    assert len(got) == 5 and paths[0] == paths[1] != paths[2]


def test_collisions_are_found_and_tried_again(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), None) for i in range(4)]
    true = columns.Words.hashes
    monkeypatch.setattr(columns.Words, "hashes", lambda self, seed=0: np.full(len(self.starts), 7, np.uint64) if seed == 0 else true(self, seed))
    texts, spans = debruijn.verified_spans(brute.documents(spark, rows), "doc_id", "text", 13, 1)
    assert spans.isEmpty() and texts.count() == 4


def test_jaccard(spark, docs, none):
    rows = [(i, t) for i, t, _ in ROWS]
    got = jaccard.join(docs, "doc_id", "text")
    assert found(got, "doc_id", "n_shingles", "component_id") == Counter(
        (i, *e) for (i, _), e in zip(rows, brute.components(rows), strict=True)
    )
    assert jaccard.join(none, "doc_id", "text").isEmpty()


@pytest.mark.parametrize(("small", "pivots"), [(4, 4), (8, 3)])
def test_jaccard_of_one_crowded_region(spark, monkeypatch, small, pivots):
    """Chains of near copies and texts that only share passages, in regions that must recurse."""
    import random

    rng = random.Random(8)
    base = brute.prose(rng, 60).split(" ")
    rows = []
    for i in range(24):
        text = list(base)
        for _ in range(rng.randrange(0, 6)):
            text[rng.randrange(60)] = f"new{rng.randrange(30)}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "PARTED", small)
    monkeypatch.setattr(jaccard, "STARS", pivots - 2)
    got = jaccard.join(brute.documents(spark, [(i, t, None) for i, t in rows]), "doc_id", "text")
    assert found(got, "doc_id", "n_shingles", "component_id") == Counter(
        (i, *e) for (i, _), e in zip(rows, brute.components(rows), strict=True)
    )


def test_jaccard_measures_a_family_against_few(spark, monkeypatch):
    """Near copies of one text, many of which link with none: pairs measured follow the members."""
    import random

    rng = random.Random(4)
    base = brute.prose(rng, 100).split(" ")
    rows = []
    for i in range(160):
        # Some are of other sizes, so that what is left to share depends on both.
        text = base[: 100 - 12 * (i % 5 == 4)]
        for j in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = f"new{i}x{j}"
        rows.append((i, " ".join(text)))
    pairs = []

    def counted(asked, full):
        pairs.append(asked.count())
        return measured(asked, full)

    measured = jaccard.measured
    monkeypatch.setattr(jaccard, "measured", counted)
    got = jaccard.join(brute.documents(spark, [(i, t, None) for i, t in rows]), "doc_id", "text")
    want = Counter((i, *e) for (i, _), e in zip(rows, brute.components(rows), strict=True))
    assert found(got, "doc_id", "n_shingles", "component_id") == want
    assert len({c for _, _, c in want}) > 30
    assert sum(pairs) <= 3 * len(rows)


def test_language(spark, none):
    import random

    rng = random.Random(2)
    sounds = {"aa": "bago nemu tira", "bb": "strz kwopf xyli", "cc": "éàü ñoß çaê"}
    rows = [(i, lang, " ".join(rng.choice(sounds[lang].split()) for _ in range(30))) for i, lang in enumerate(list(sounds) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.learn(df.where("doc_id < 120"), "doc_id", "text", "lang")
    got = langid.predict(df, ["doc_id", "lang"], "text", model).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %% 34"), (None, "bago nemu"), (4, "é"), (4, "x " * 20_000)], "doc_id long, text string")
    got = langid.predict(odd, ["doc_id"], "text", model).collect()
    assert sorted(r.lang_pred == langid.UNKNOWN for r in got) == [False] * 3 + [True] * 3
    assert langid.learn(none, "doc_id", "text", "lang") is None
    assert {(r.lang_pred, r.score) for r in langid.predict(odd, ["doc_id"], "text", None).collect()} == {(langid.UNKNOWN, 0.0)}


def test_language_query_learns_from_its_fold(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    got = queries.op6_language_id(spark, folder).collect()
    assert all(r.held_out == (brute.in_fold(r.doc_id, 4) == 2) for r in got)
    lang = {r.doc_id: r.lang for r in queries.table(spark, folder, "documents").collect()}
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert len(got) == len(lang) and sum(held) >= 0.95 * len(held)


def base_scores(rows, training):
    counts, tokens = Counter(), []
    for r, t in zip(rows, training, strict=True):
        w = [*brute.words(r[1], lower=True), None]
        tokens.append(w)
        if t:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [(len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for w in tokens]


def test_language_model(spark, docs, none):
    is_training = lambda i: i is not None and i % 3 > 0
    got = lm.score(docs, "doc_id", "text", F.col("doc_id") % 3 > 0).collect()
    rows = [(i, t) for i, t, _ in ROWS]
    expected = base_scores(rows, [is_training(i) for i, _ in rows])
    key = lambda i, held, e: (i, held, *e[:3], round(e[3], 6))
    assert Counter(key(r.doc_id, r.held_out, (r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == Counter(
        key(i, not is_training(i), e) for (i, _), e in zip(rows, expected, strict=True)
    )
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    alike = {r.score for r in got if r.doc_id == 0}
    assert max(alike) - min(alike) < 1e-5 * -min(alike)
    assert lm.score(none, "doc_id", "text", F.lit(True)).isEmpty()
    assert lm.score(docs, "doc_id", "text", F.lit(False)).count() == len(rows)


def test_net_gradients_and_carried_state():
    rng = np.random.default_rng(0)
    vocab_weights = rng.integers(1, 50, lm.WORDS + lm.ENDINGS + 1)
    net = lm.Net(vocab_weights)
    net.values = {k: (v + rng.normal(0, 0.05, v.shape)).astype(np.float64) for k, v in net.values.items()}
    ids = [rng.integers(0, lm.WORDS + lm.ENDINGS + 1, n) for n in (1, 7, 30, 200)]
    inputs, nexts, _ = lm.laid_out(ids[1:3], 2, lm.FIRST)
    state = np.zeros((2, lm.HIDDEN))

    def loss():
        states, _, _ = net.forward(inputs, inputs == lm.FIRST, state)
        good = nexts.reshape(-1) >= 0
        return -net.chances(states.reshape(-1, lm.HIDDEN).astype(np.float64)[good], nexts.reshape(-1)[good])[0].sum()

    gradients, _, _ = net.learn(inputs, nexts, state)
    for name, g in gradients.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = net.values[name][at]
        net.values[name][at] = before + 1e-3
        up = loss()
        net.values[name][at] = before - 1e-3
        down = loss()
        net.values[name][at] = before
        assert math.isclose((up - down) / 2e-3, g[at], rel_tol=0.03, abs_tol=0.02), name
    # One text at a time, unbroken, gives the same as many in windows.
    together = lm.likelihoods(net, ids)
    for i, one in enumerate(ids):
        states, _, _ = net.forward(np.r_[lm.FIRST, one[:-1]][:, None], np.arange(len(one))[:, None] == 0, np.zeros((1, lm.HIDDEN)))
        assert math.isclose(net.chances(states[:, 0], one)[0].sum(), together[i], rel_tol=1e-4)
    # All continuations of a state have a chance of 1 together, ending classes counted once.
    every = np.arange(lm.WORDS + lm.ENDINGS + 1)
    chance = net.chances(np.repeat(np.zeros((1, lm.HIDDEN)), len(every), axis=0), every)[0]
    assert math.isclose(np.exp(chance).sum(), 1, rel_tol=1e-4)


def test_net_learns_from_every_training_row(spark, none, monkeypatch):
    rows = [(i % 50 if i % 3 else None, f"w{i} " * (1 + i % 7), "s") for i in range(300)] + [(1, "same words", "s")] * 40
    df = brute.documents(spark, rows).repartition(3)
    monkeypatch.setattr(lm, "GROUP_TOKENS", 60)
    vocab = lm.vocabulary(lm.counts(df, "text"))
    groups = lm.n_groups(vocab.n_tokens)
    assert groups == -(-vocab.n_tokens // 60) > 20
    dealt = lm.grouped(df, "doc_id", "text", vocab, groups).collect()
    assert len(dealt) == len(rows) and sum(len(r.ids) // 2 for r in dealt) == vocab.n_tokens
    same = Counter(r.ids for r in dealt).most_common(1)[0][0]
    assert len({r.group for r in dealt if r.ids == same}) > 3
    # Learners and the groups that each goes through both grow with the corpus.
    assert [lm.n_learners(n) for n in (1, 2, 4, 9, 10, 10_000)] == [1, 2, 2, 3, 4, 100]
    assert lm.n_passes(5, 1) == lm.MOST_PASSES and lm.n_passes(10**9, 1000) == 1
    values = lm.learn(df, "doc_id", "text", vocab)
    start = lm.Net(vocab.weights).values
    assert all(np.isfinite(v).all() and v.shape == start[k].shape for k, v in values.items())
    assert any((values[k] != start[k]).any() for k in values)
    monkeypatch.setattr(lm, "AVERAGED", 2)
    again = lm.learn(df, "doc_id", "text", vocab)
    assert all(np.allclose(values[k], again[k], atol=1e-5) for k in values)


class Here:
    """Runs the Arrow functions of a frame in this process, where patches hold; all rows are one group."""

    def __init__(self, table):
        self.table = table

    def mapInArrow(self, run, _):  # noqa: N802
        return Here(pa.Table.from_batches(list(run(iter(self.table.to_batches())))))

    def groupBy(self, *_):  # noqa: N802
        return self

    def applyInArrow(self, run, _):  # noqa: N802
        return Here(run(self.table))


def test_edges_of_one_hash_are_told_apart(monkeypatch):
    """All windows have one hash of 64 bits under seed 1; the second hash parts them."""
    texts = [" ".join(f"w{i % 3}x{j}" for j in range(40)) for i in range(4)]
    true = columns.Words.windows

    def windows(self, hashes, n, seed=0):
        at, found = true(self, hashes, n, seed)
        return at, np.full_like(found, 7) if seed == 1 else found

    monkeypatch.setattr(columns.Words, "windows", windows)
    rows = Here(pa.table({"id": [0, 1, 2, 3], "tag": [0, 0, 0, 0], "text": texts}))
    spans = debruijn.runs(debruijn.repeats(debruijn.edges(rows, 13, 1, 1), 1)).table.to_pylist()
    assert [(r["id"], r["start"], r["edges"], r["source_id"], r["source_start"]) for r in spans] == [(3, 0, 28, 0, 0)]


def test_collisions_end_with_the_right_result(spark, monkeypatch):
    """Under seed 0 no span agrees, so that the loop has to go on to another seed."""
    rows = [(i, " ".join(f"w{i % 3}x{j}" for j in range(40))) for i in range(4)]
    seeds, once = [], debruijn.verified_spans

    def verified_spans(*args):
        seeds.append(args[-1])
        texts, spans = once(*args)
        return texts, spans if args[-1] else spans.withColumn("one", F.col("one") + 1)

    monkeypatch.setattr(debruijn, "verified_spans", verified_spans)
    got = debruijn.summary(brute.documents(spark, [(i, t, None) for i, t in rows]), "doc_id", "text")
    expected = Counter((i, *e) for (i, _), e in zip(rows, brute.word_spans(rows, 13), strict=True))
    assert found(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected and seeds == [0, 1]


def test_texts_of_one_id_and_crc32(spark, monkeypatch):
    """Two texts that share id and crc32; only one repeats a passage."""
    import random

    rng = random.Random(9)
    shared, other = brute.prose(rng, 40), brute.prose(rng, 30)
    mark = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:12]
    by_crc = {zlib.crc32((t := f"{shared} {mark(i)}").encode()): t for i in range(100_000)}
    one, two = next(
        (by_crc[c], t) for i in range(1_000_000) if (c := zlib.crc32((t := f"{other} {mark(-i)}").encode())) in by_crc
    )
    rows = [(1, shared), (9, one), (9, two), (9, two + " more"), (None, two), (None, one)]
    df = brute.documents(spark, [(i, t, None) for i, t in rows])
    got = debruijn.summary(df, "doc_id", "text")
    expected = Counter((i, *e) for (i, _), e in zip(rows, brute.word_spans(rows, 13), strict=True))
    assert found(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    rows = rows[:3]
    df = brute.documents(spark, [(i, t, None) for i, t in rows])
    got = suffixes.summary(df, "doc_id", "text", length=100)
    expected = Counter((i, *e) for (i, _), e in zip(rows, brute.byte_spans([t for _, t in rows], 100), strict=True))
    assert found(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    few, true = 2, lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda table: true(table, few))
    scores = lm.score(df, "doc_id", "text", F.lit(True)).collect()
    assert Counter((r.doc_id, r.n_known, round(r.base_score, 6)) for r in scores) == Counter(
        (i, e[1], round(e[3], 6)) for (i, _), e in zip(rows, base_scores(rows, [True] * 3), strict=True)
    )


def test_an_edge_takes_nine_bytes_of_hash(spark):
    texts = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(30)), None) for i in range(20)]
    rows = debruijn.keyed(brute.documents(spark, texts), "doc_id", "text")
    packed = debruijn.edges(rows, 13, 4, 1).toArrow()
    size = {c: sum(len(x) for x in packed[c].to_pylist()) for c in ("low", "high", "more")}
    assert size == {"low": 4 * 20 * 18, "high": 3 * 20 * 18, "more": 2 * 20 * 18}
    numbers = np.array([0, 1, 255, 256, (1 << 24) - 1, (1 << 32) - 1], np.uint64)
    assert debruijn._unthree_bytes(debruijn._three_bytes(numbers)).tolist() == [0, 1, 255, 256, (1 << 24) - 1, (1 << 24) - 1]
