"""Plain Python versions of the operators, and documents with all the odd cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use inside.
    "id long, tag long, key string, size long, n long, node string, row string, spans string, _text string, bucket int"
)


def prose(rng, n, words=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(words)}" for _ in range(n))


def odd_texts():
    """Texts with every odd case: ``(doc_id, text, source)``, ids partly repeated or null."""
    rng = random.Random(3)
    shared = prose(rng, 90)
    base = prose(rng, 300)
    edited = base.split(" ")
    edited[40] = "changed"
    long = prose(rng, 4000)
    texts = [
        base, " ".join(edited), base, None, "", "  \n\t ", "one", "two  words", "é ü ß – „ñ“",
        f"{prose(rng, 60)} {shared} {prose(rng, 60)}", f"{shared} {prose(rng, 30)}", f"{prose(rng, 80)}\n{shared}",
        long, long + " end", "a" * 3000, "ab " * 700, "x\n" * 80, "\n\n" + prose(rng, 55), prose(rng, 4), "one",
        "the # $ % rows | of < > & *\n" * 30, "<|endoftext|> " + prose(rng, 20), "  lead and trail \n ",
    ]
    rows = [(i, t, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[9], rows[3]]  # repeated rows
    rows += [(None, base, "s1"), (None, "", "s1"), (9, prose(rng, 70), "s2")]  # no id; an id with another text
    rows += [(100 + i, f"{prose(rng, 20 + i)} {shared if i % 3 == 0 else ''}", "s0") for i in range(60)]
    return rows


def documents(spark, rows=None):
    rows = odd_texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or ""), 1, 2, "k", 3, 4, "x", "r", "p", "t", 5) for i, t, s in rows], SCHEMA
    )


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def statistics(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    marks = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(marks),
    )


def byte_spans(texts, length):
    """``(n_bytes, n_removed, n_spans, sha256)`` of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def word_spans(rows, k):
    """``(n_words, n_removed, sha256)`` of each ``(doc_id, text)``; null ids are the largest."""
    return [(n, gone, hashlib.sha256(kept).hexdigest()) for n, gone, kept in cut_words(rows, k)]


def cut_words(rows, k):
    """``(n_words, n_removed, kept words)`` of each ``(doc_id, text)``."""
    order = lambda i: math.inf if i is None else i
    first: dict = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - k + 1):
            g = tuple(w[j : j + k])
            first[g] = min(first.get(g, math.inf), order(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < order(i):
                gone[j : j + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), kept))
    return out


def shingles(text, n=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(rows, percent=75):
    """A number for each ``(doc_id, text)``, equal for rows that links connect; rows without words have none."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    return [find(a) if s else None for a, s in enumerate(sets)]


def components(rows, percent=75):
    """``(n_shingles, component)`` of each ``(doc_id, text)``; rows of equal set are one node."""
    least: dict = {}
    found = groups(rows, percent)
    for group, (i, _) in zip(found, rows, strict=True):
        if i is not None and group is not None:
            least[group] = min(least.get(group, math.inf), i)
    return [
        (len(shingles(t)), i if group is None else least.get(group)) for group, (i, t) in zip(found, rows, strict=True)
    ]


def in_fold(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor
