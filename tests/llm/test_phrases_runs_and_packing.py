"""Collocations, periodic runs and tournament packing against brute force, with odd rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from perplexis.llm import collocations, periodic, queries, tournament
from tests.llm import brute

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS = brute.odd_texts() + [
    (200, "a b " * 40 + "c", "s0"), (201, "x " * 6, "s0"), (202, "x " * 5, "s0"), (203, "p q r p q r p q r p q r", "s0"),
    (204, "u u u u u u v v v v v v u u u u u u v v v v v v " * 5, "s0"), (200, "a b " * 40 + "c", "s0"), (200, None, "s0"),
]


def documents(spark, rows=ROWS):
    return brute.documents(spark, rows).repartition(3)


# Periodic runs

def brute_runs(words, least=6, times=4):
    """Every stretch that can't be longer, for every lag, unless a smaller period holds throughout."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, times * q):
                stretch = words[start : start + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(0, 30), st.integers(1, 9), st.integers(2, 7))
def test_runs_of_any_words(words, at, period, times):
    words = words[:at] + words[at : at + period] * times + words[at:]
    got = periodic.periodic(np.array(words, np.int64))
    assert [tuple(r) for r in got.tolist()] == brute_runs(words)
    got = periodic.periodic(np.array(words, np.int64), least=4, times=3)
    assert [tuple(r) for r in got.tolist()] == brute_runs(words, 4, 3)


def test_runs_of_words_that_never_come_twice_in_a_row():
    """Thue-Morse words and their like hold squares only; hashes of them often meet, names don't."""
    words = [bin(i).count("1") % 2 for i in range(1 << 13)]
    assert len(periodic.periodic(np.array(words))) == 0
    twice = words[:1500] * 5
    assert [tuple(r) for r in periodic.periodic(np.array(twice)).tolist()] == [(0, 7500, 1500)]
    with pytest.raises(ValueError):
        periodic.periodic(np.array(words), times=2)


def test_many_seeds_are_skipped():
    words = np.array([0] * 200_000 + [1, 2] * 100_000 + list(range(3, 1003)) * 20)
    assert [tuple(r) for r in periodic.periodic(words).tolist()] == [
        (0, 200_000, 1), (200_000, 200_000, 2), (400_000, 20_000, 1000),
    ]


def test_runs_of_documents(spark):
    got = periodic.runs(documents(spark), "doc_id", "text").collect()
    expected = Counter()
    for i, t, _ in ROWS:
        words = brute.words(t)
        runs = brute_runs(words)
        expected[i, len(words), tuple(runs), collapsed(words, runs).decode()] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == expected
    assert periodic.runs(documents(spark, []), "doc_id", "text").isEmpty()
    named = spark.createDataFrame([("k", "a a a a a a a"), (None, "a")], "key string, runs string")
    assert sorted(map(tuple, periodic.runs(named, "key", "runs").select("key", "collapsed").collect()), key=str) == [("k", "a"), (None, "a")]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark):
    expected = Counter()
    for r in queries.table(spark, FOLDER, "documents").collect():
        words = planted(r.doc_id, brute.words(r.text))
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected[r.doc_id, len(runs), *figures, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()] += 1
    got = queries.op13_periodic_runs(spark, FOLDER)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == expected
    assert sum(k[1] for k in expected) > 0


def test_planting_keeps_odd_rows(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(ROWS * 4)] + [(None, "a b c", "s")]
    got = Counter((r.doc_id, tuple(brute.words(r.text))) for r in queries.planted_runs(documents(spark, rows)).collect())
    assert got == Counter((i, tuple(planted(i, brute.words(t)) if i is not None else brute.words(t))) for i, t, _ in rows)


# Packing

def test_ids_are_those_of_the_tokenizer(spark):
    import public_tokenizers
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known = tournament.Encoder()
    odd = [
        " a", "a ", "a  b", "a\n b", "\t", "it's 'TWAS we'LL", "é Å", " x ", " y\u0085z", "ΟΔΟΣ Σ", "İstanbul ŉ ſ", "x²³½",
        "don 't", "x \x1c y\x00z", "<|endoftext|>a <|startoftext|>", "<|ENDOFTEXT|>", "日本語 テキスト", "😀👍🏽 ok", "ß ẞ ﬁ", "a​b", "w" * 300, "́ x",
        "naïve café — “quoted”…", "¡hola! ¿qué? ª º µ",
    ]
    texts = [t or "" for _, t, _ in ROWS] + odd + [r.text or "" for r in queries.table(spark, FOLDER, "documents").collect()]
    for text in texts:
        for _ in range(2):
            assert known.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def naive_first_fit(sizes, capacity):
    bins, free = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
        if at is None:
            at = len(bins)
            bins.append([])
            free.append(capacity)
        bins[at].append(i)
        free[at] -= sizes[i]
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=70), st.integers(40, 64))
def test_first_fit_and_evening_out(sizes, capacity):
    sizes = np.array(sizes, np.int64)
    bins = tournament.first_fit_decreasing(sizes, capacity)
    assert bins == naive_first_fit(sizes.tolist(), capacity)
    lots = tournament.evened(bins, sizes, capacity)
    covered = defaultdict(list)
    for lot in lots:
        total = sum(n for _, _, n in lot)
        assert total == capacity or (total < capacity and total & (total - 1) == 0)
        for piece, first, n in lot:
            assert n > 0
            covered[piece].append((first, n))
    for piece, size in enumerate(sizes.tolist()):
        at = 0
        for first, n in sorted(covered[piece]):
            assert first == at
            at += n
        assert at == size
    assert sum(sum(n for _, _, n in lot) < capacity for lot in lots) <= capacity.bit_length()


def check_packed(got, ids_of, rows, length):
    """Pieces cover every document once, hash as they should, and leave no padding."""
    sequences, by_start = defaultdict(list), defaultdict(Counter)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_start[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    wanted = defaultdict(list)
    for i, t, _ in rows:
        wanted[i].append([*ids_of(t or ""), 1])
    for i, documents_of in wanted.items():
        left = by_start[i]
        assert sum(n * k for (_, n, _, _), k in left.items()) == sum(map(len, documents_of))
        if len(documents_of) == 1:
            at, ids = 0, documents_of[0]
            for start, n, crc, total in sorted(left.elements()):
                assert start == at and total == len(ids)
                assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
                at += n
            assert at == len(ids)
    return len(sequences)


@pytest.mark.parametrize(("length", "group"), [(2048, 8192), (256, 7), (100, 20)])
def test_packing_of_documents(spark, length, group):
    known = tournament.Encoder()
    got = tournament.pack(documents(spark), "doc_id", "text", length, group).collect()
    n = check_packed(got, lambda t: known.ids(t).tolist(), ROWS, length)
    total = sum(len(known.ids(t or "")) + 1 for _, t, _ in ROWS)
    groups = -(-len(ROWS) // group)
    assert n <= total // length + groups * (length.bit_length() + 1)


def test_packing_odd_tables(spark):
    assert tournament.pack(documents(spark, []), "doc_id", "text").isEmpty()
    named = spark.createDataFrame([("a", "one two"), (None, None)], "row string, ids string")
    got = tournament.pack(named, "row", "ids").collect()
    assert sum(r.length for r in got) == 4 and {r.row for r in got} == {"a", None}


def test_packing_query(spark):
    rows = [(r.doc_id, r.text, None) for r in queries.table(spark, FOLDER, "documents").collect()]
    known = tournament.Encoder()
    check_packed(queries.op12_tournament_packing(spark, FOLDER).collect(), lambda t: known.ids(t).tolist(), rows, 2048)


# Collocations

def brute_collocations(rows, least, top, inside):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for q in (p[:2], p[1:]):
                if len(p) == 3:
                    longer[q] = max(longer[q], a)
        ranked = []
        for p, a in found.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        n = sum(a for p, a in counts.items() if len(p) == 1)
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return out


def phrase_rows():
    rng = random.Random(8)
    texts = []
    for i in range(220):
        words = [rng.choice(["new", "york", "city", "of", "The", "the", "über", "x-y", " odd", "w" * 90]) for _ in range(rng.randrange(40))]
        words += ["one", "long", "unary", "path", "of", "words"] * (i % 3 == 0)
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?"]) for w in words)
        texts.append((i, text, rng.choice(["en", "de", None, ""])))
    texts += [(900, None, "en"), (901, "", "fr"), (902, " .. ", "fr"), (903, "lone", "fr"), (None, "a b c", None), (904, "loop " * 30, "en")]
    return texts + texts[:5]


@pytest.mark.parametrize(("least", "top", "inside", "flush", "buckets"), [(10, 2000, 50, 1 << 20, 16), (3, 12, 80, 50, 5), (2, 2000, 100, 200, 1)])
def test_collocations(spark, monkeypatch, least, top, inside, flush, buckets):
    monkeypatch.setattr(collocations, "n_buckets", lambda df: buckets)
    monkeypatch.setattr(collocations, "FLUSH", flush)
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, s, 1, "b", "x") for i, t, s in rows], "doc_id long, text string, lang string, n int, bucket string, words string").repartition(3)
    got = collocations.collocations(df, "text", "lang", least, top, inside)
    assert {tuple(r) for r in got.collect()} == brute_collocations([(s, t) for _, t, s in rows], least, top, inside)
    assert collocations.collocations(df.where("false"), "text", "lang").isEmpty()


def test_paths_and_flow(spark):
    """Derived counts are those of the text, and every path is as long as it can be."""
    rows = [("en", "start one long unary path here")] * 12 + [("en", "go one long unary path there")] * 11 + [("en", "unary")] * 3
    df = spark.createDataFrame(rows, "lang string, text string")
    edges, nodes, words = collocations.graph(df, "text", "lang", 10)
    assert {(r.a, r.b): r.n for r in nodes.collect()} == {
        ("start", "one"): 12, ("go", "one"): 11, ("one", "long"): 23, ("long", "unary"): 23, ("unary", "path"): 23, ("path", "here"): 12, ("path", "there"): 11,
    }
    assert {r.a: r.n for r in words.collect()} == {"start": 12, "go": 11, "one": 23, "long": 23, "unary": 26, "path": 23, "here": 12, "there": 11}
    found = collocations.compacted(collocations.paths(edges, nodes)).collect()
    assert {(" ".join(r.words), r.n, r.n_left, r.n_right) for r in found} == {
        ("start one long", 12, 12, 23), ("go one long", 11, 11, 23), ("one long unary path", 23, 23, 23),
        ("unary path here", 12, 23, 12), ("unary path there", 11, 23, 11),
    }


def test_scores_beyond_64_bits(spark):
    a = 10**12
    rows = spark.createDataFrame([("en", "x y", "x", "y", a, None, None), ("en", "x y x", "x", "x", a - 1, a, a)], "lang string, phrase string, first string, last string, a long, left long, right long")
    words = spark.createDataFrame([("en", "x", a + 7), ("en", "y", a + 3)], "lang string, a string, n long")
    got = {r.phrase: (r.l, r.r, r.score) for r in collocations.scored(rows, words).collect()}
    assert got["x y"] == (a + 7, a + 3, 10**6 * a * a // ((a + 7) * (a + 3)))
    cuts = [(10**6 * (a - 1) ** 2 // ((a + 7) * a), k) for k in (1, 2)]
    assert got["x y x"] == (a + 7, a, min(cuts)[0])
