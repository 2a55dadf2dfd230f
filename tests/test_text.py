import sys

from pyspark.sql import functions as F

from perplexis.functions import text as T
from perplexis.operators import tokens as K


def test_blank_equals_python_strip(spark):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c, chr(c)) for c in points], "cp int, t string")
    wrong = [
        r.cp for r in rows.select("cp", T.is_scoreable("t").alias("ok")).collect()
        if r.ok != bool(chr(r.cp).strip())
    ]
    assert wrong == []


def test_null_and_mixed_blanks(spark):
    rows = spark.createDataFrame([(None,), ("",), ("\t \n",), ("!!!",), (" a ",)], "t string")
    got = [r.ok for r in rows.select(T.is_scoreable("t").alias("ok")).collect()]
    assert got == [False, False, False, True, True]
    assert [r.t for r in rows.select(T.text_or_empty("t").alias("t")).collect()][0] == ""


def test_numbers_are_coerced(spark):
    assert spark.range(7, 8).select(T.tokens("id").alias("t")).first().t == ["7"]


def test_tokens_and_truncation(spark):
    row = spark.createDataFrame([("Één, zwei-3 «Vier»!",)], "t string")
    assert row.select(T.tokens("t").alias("x")).first().x == ["één", "zwei", "3", "vier"]
    assert row.select(T.tokens("t", 2).alias("x")).first().x == ["één", "zwei"]
    assert row.select(T.token_count("t").alias("x")).first().x == 4


def _toks(spark, texts):
    return spark.createDataFrame(
        [(i, t.split()) for i, t in enumerate(texts)], "doc_id long, tokens array<string>"
    )


def test_pairs_follow_positions(spark):
    toks = _toks(spark, ["a b a", "c", ""])
    got = {tuple(r) for r in K.next_token_pairs(toks, ["doc_id"]).collect()}
    assert got == {(0, 1, "a", "b"), (0, 2, "b", "a"), (0, 3, "a", None), (1, 1, "c", None)}
    assert {tuple(r) for r in K.token_positions(toks, ["doc_id"]).collect()} == {
        (0, 1, "a"), (0, 2, "b"), (0, 3, "a"), (1, 1, "c")
    }


def test_padding(spark):
    toks = _toks(spark, ["a b c", "d", "e f", "g"])
    rows = {r.doc_id: r for r in K.pad_batches(toks, ["doc_id"], 2, "#").collect()}
    assert rows[0].padded == ["a", "b", "c"] and rows[0].mask == [1, 1, 1]
    assert rows[1].padded == ["d", "#", "#"] and rows[1].mask == [1, 0, 0]
    assert rows[2].mask == [1, 1] and rows[3].padded == ["g", "#"]
    assert [rows[i].batch_id for i in range(4)] == [0, 0, 1, 1]


def test_vocabularies(spark):
    left = K.vocabulary(_toks(spark, ["a b", "b c"]))
    right = K.vocabulary(_toks(spark, ["b c d"]))
    # a, b, c are 1, 2, 3 on the left; b, c, d are 1, 2, 3 on the right.
    assert {tuple(r) for r in K.vocabulary_difference(left, right).collect()} == {("a", 1, None), ("b", 2, 1), ("c", 3, 2), ("d", None, 3)}
    K.require_same_vocabulary(left, left)
    try:
        K.require_same_vocabulary(left, right)
    except ValueError:
        return
    raise AssertionError("different vocabularies must be refused")
