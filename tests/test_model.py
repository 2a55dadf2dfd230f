import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from perplexis.operators import logits as Z
from perplexis.operators import metrics as M
from perplexis.operators import model as L
from perplexis.operators import sampling as S
from perplexis.operators import tokens as K
from perplexis.operators.lookup import frequent_lookup, hot_keys, hot_keys_of, salted_lookup
from tests.dense import Dense

ALPHA, LAM = 0.4, 0.6


def corpus(seed=3, words="abcdef", texts=14):
    rng = random.Random(seed)
    made = [[rng.choice(words[: 2 + i % 5]) for _ in range(rng.randint(1, 9))] for i in range(texts)]
    return [("documents" if i % 2 else "conversations", i, t) for i, t in enumerate(made)]


def as_table(spark, rows):
    return spark.createDataFrame(rows, "src string, doc_id long, tokens array<string>")


@pytest.fixture(scope="module")
def rows():
    # `z` occurs at the end only: a context that no model has seen.
    return corpus() + [("conversations", 90, ["a", "y", "z"]), ("documents", 91, ["x"])]


@pytest.fixture(scope="module")
def model(spark, rows):
    return L.train(as_table(spark, rows), F.col("src") == "documents", F.lit(True), ALPHA, LAM)


def dense(rows, t=1.0):
    return Dense([r[2] for r in rows if r[0] == "documents"], [r[2] for r in rows], ALPHA, LAM, t)


def test_counts(model, rows):
    reference = dense(rows)
    for role in "pq":
        unigram, bigram, context = reference.counts[role]
        for r in model.words.collect():
            assert r[f"n_{role}"] == unigram[r.tok] and r[f"c_{role}"] == context[r.tok]
        for r in model.pairs.where(F.col("next") != K.END).collect():
            assert r[f"n_{role}"] == bigram[r.prev, r.next]
    assert model.vocabulary_size == len(reference.vocabulary)


def test_long_tables(model, rows):
    reference = dense(rows)
    for r in L.unigram_table(model).collect():
        assert r.u == pytest.approx(reference.unigram("p" if r.model == "observer" else "q", r.tok))
    bigrams = L.bigram_table(model).where("model = 'observer'").collect()
    assert {(r.prev, r.tok): r.n for r in bigrams} == dict(reference.counts["p"][1])
    contexts = L.context_table(model).where("model = 'performer'").collect()
    assert {r.prev: r.n for r in contexts} == dict(reference.counts["q"][2])


@pytest.mark.parametrize("t", [0.6, 1.0, 1.7])
def test_closed_form_equals_dense_sum(model, rows, t):
    contexts = L.train_contexts(model, t)
    reference = dense(rows, t)
    for r in contexts.table.collect():
        assert r.h == pytest.approx(reference.h(r.tok), abs=1e-12)
        if t == 1:
            assert r.mass_p == pytest.approx(1) and r.mass_q == pytest.approx(1)
    assert contexts.unseen_h == pytest.approx(reference.h("never seen"), abs=1e-12)


@pytest.mark.parametrize("t", [0.6, 1.0, 1.7])
def test_new_texts_with_unseen_tokens(spark, model, rows, t):
    reference = dense(rows, t)
    contexts = L.train_contexts(model, t)
    texts = [["a", "b", "new", "a"], ["z", "z", "f"], ["new"], ["f", "e", "d", "a", "a"]]
    toks = as_table(spark, [("new", i, text) for i, text in enumerate(texts)])
    positions = K.token_pairs(toks, "doc_id")
    values = M.token_metrics(positions, M.pair_metrics(positions, contexts), ["doc_id"])
    for r in values.collect():
        text = texts[r.doc_id]
        assert r.h == pytest.approx(reference.h(r.tok), abs=1e-12)
        if r.pos == len(text):
            assert r.nll is None
        else:
            assert r.nll == pytest.approx(reference.nll(r.tok, text[r.pos]), abs=1e-12)
    scores = {r.doc_id: r for r in M.document_scores(values, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        assert scores[i].n_tokens == len(text)
        assert scores[i].score == pytest.approx(reference.score(text), nan_ok=True)
    assert math.isnan(scores[2].score)


def test_hot_and_cold_pairs_agree(spark, model, rows):
    contexts = L.train_contexts(model)
    positions = K.token_pairs(as_table(spark, rows), "doc_id")
    pairs = M.trained_pair_metrics(contexts)
    results = []
    # All pairs broadcast, some, and none.
    for hot in (10 ** 9, 20, 1):
        values = M.token_metrics(positions, pairs, ["doc_id"], hot_pairs=hot)
        results.append(sorted(map(tuple, M.document_scores(values, ["doc_id"]).select("doc_id", "n_tokens", F.round("score", 10)).collect())))
    assert str(results[0]) == str(results[1]) == str(results[2])
    assert len(results[0]) == len(rows)


def test_pair_without_values_fails(spark, model, rows):
    contexts = L.train_contexts(model)
    positions = K.token_pairs(as_table(spark, [("x", 1, ["a", "new"])]), "doc_id")
    with pytest.raises(Exception, match="without values"):
        M.token_metrics(positions, M.trained_pair_metrics(contexts), ["doc_id"]).collect()


def test_same_model_gives_its_entropy(model, rows):
    one = L.same_model(model, "p")
    documents = [r[2] for r in rows if r[0] == "documents"]
    everything = [r[2] for r in rows]
    reference = Dense(documents, documents, ALPHA, LAM)
    reference.vocabulary = Dense(documents, everything, ALPHA, LAM).vocabulary
    both = L.train_contexts(model).table.select("tok", F.col("h").alias("cross"))
    for r in L.train_contexts(one).table.join(both, "tok").collect():
        assert r.h == pytest.approx(reference.h(r.tok), abs=1e-12)
        assert r.cross >= r.h - 1e-12


def test_saved_model(spark, tmp_path, rows):
    path = str(tmp_path / "model")
    model = L.train(as_table(spark, rows), F.col("src") == "documents", F.lit(True), ALPHA, LAM, path)
    again = L.load_model(spark, path)
    assert (again.alpha, again.lam, again.vocabulary_size, again.total_q) == (
        ALPHA, LAM, model.vocabulary_size, model.total_q
    )


def test_parameters_are_checked(spark, rows):
    for alpha, lam in ((0, 0.5), (1, 1.0), (1, 0.0)):
        with pytest.raises(ValueError):
            L.train(as_table(spark, rows), F.lit(True), F.lit(True), alpha, lam)


def test_partitioning_does_not_change_scores(spark, rows):
    found = []
    for n in (1, 7):
        toks = as_table(spark, rows).repartition(n)
        m = L.train(toks, F.col("src") == "documents", F.lit(True), ALPHA, LAM)
        positions = K.token_pairs(toks, "doc_id")
        values = M.token_metrics(positions, M.pair_metrics(positions, L.train_contexts(m)), ["doc_id"])
        found.append({r.doc_id: r.score for r in M.document_scores(values, ["doc_id"]).collect()})
    assert found[0].keys() == found[1].keys()
    for k, v in found[0].items():
        assert v == pytest.approx(found[1][k], nan_ok=True)


def test_salted_lookup_splits_hot_keys(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )
    table = rows.groupBy("k").agg(F.min("id").alias("v"))
    assert hot_keys_of(rows, "k") is None and salted_lookup(rows, table, "k", None).count() == 3000
    hot = hot_keys_of(rows, "k", target=46)
    assert [r.salts for r in hot.collect()] == [22]
    joined = salted_lookup(rows, table, "k", hot)
    assert joined.count() == 3000 and joined.columns == ["k", "id", "v"]
    assert joined.where("k = 'hot' AND v = 0").count() == 1000
    assert joined.where("k <> 'hot' AND v = id").count() == 2000
    missing = salted_lookup(rows, table.where("k <> 'hot'"), "k", hot)
    assert missing.where("v IS NULL").count() == 1000


METRICS = "doc_id long, pos int, tok string, nll double, h double"


def test_median_mean_and_masks(spark):
    nan = math.nan
    table = spark.createDataFrame([
        (1, 1, "a", 1.0, 2.0), (1, 2, "#", 5.0, 8.0), (1, 3, "b", 3.0, 4.0), (1, 4, "c", None, 1.0),
        (2, 1, "a", 1.0, nan), (2, 2, "b", nan, 3.0), (2, 3, "c", 2.0, 5.0), (2, 4, "c", None, 4.0),
        (3, 1, "a", None, 2.0),
    ], METRICS)
    mean = {r.doc_id: r for r in M.document_scores(table, ["doc_id"]).collect()}
    assert mean[1].ppl == 3.0 and mean[1].x_ppl == 3.75 and mean[1].score == 0.8
    assert math.isnan(mean[2].ppl) and math.isnan(mean[3].score) and mean[3].n_tokens == 1
    median = {r.doc_id: r for r in M.document_scores(table, ["doc_id"], median=True).collect()}
    assert median[1].ppl == 3.0 and median[1].x_ppl == 3.0
    assert median[2].ppl == 1.5 and median[2].x_ppl == 4.0
    # A mask token inside a text leaves x_ppl but stays in ppl.
    masked = {r.doc_id: r for r in M.document_scores(table, ["doc_id"], mask_tokens=["#"]).collect()}
    assert masked[1].ppl == 3.0 and masked[1].x_ppl == pytest.approx(7 / 3)


def test_ratio_follows_floating_point(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (math.nan, 0.0)], "a double, b double")
    got = [r.r for r in rows.select(M.ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got[0] == 0.5 and got[1] == math.inf and math.isnan(got[2]) and math.isnan(got[3])


@pytest.mark.parametrize(("t", "range_rows"), [(1.0, 1 << 18), (1.7, 1 << 18), (1.0, 5)])
def test_alias_tables_hold_the_observer_distribution(model, rows, t, range_rows):
    """Bigram and unigram parts together give each context's distribution."""
    reference = dense(rows, t)
    contexts = L.train_contexts(model, t)
    names = {r.id: r.tok for r in model.words.collect()} | {K.UNSEEN_ID: "<unk>"}
    parts = defaultdict(Counter)
    cells = defaultdict(list)
    for r in S.alias_tables(S.observer_weights(model, t), rows=range_rows).collect():
        assert 0 <= r.share <= 1
        cells[r.ctx].append((r.cell, r.cells))
        parts[r.ctx][names[r.own]] += r.share / r.cells
        parts[r.ctx][names[r.other]] += (1 - r.share) / r.cells
    for found in cells.values():
        assert sorted(found) == [(i, len(found)) for i in range(len(found))]
    for r in contexts.table.collect():
        expected = reference.distribution("p", r.tok)
        for word in reference.vocabulary:
            mixed = r.pick * parts[r.id][word] + (1 - r.pick) * parts[S.UNIGRAM_ID][word]
            assert mixed == pytest.approx(expected[word], abs=1e-6)


@pytest.mark.parametrize("range_rows", [1 << 18, 40])
def test_alias_tables_of_any_weights(spark, range_rows):
    rng = random.Random(5)
    weights = [(c, i, rng.choice([0, 1, 1, 5, rng.randrange(10**6), 10**12]) + (i == 0)) for c, n in enumerate([1, 2, 3, 50, 200]) for i in range(n)]
    weights += [(9, i, 7) for i in range(12)]
    df = spark.createDataFrame(weights, "ctx long, next_id long, w long").selectExpr("ctx", "next_id", "CAST(w AS DECIMAL(38, 0)) AS weight", "CAST(next_id AS DOUBLE) AS value")
    shares = defaultdict(Fraction)
    for r in S.alias_tables(df, rows=range_rows).collect():
        assert (r.own_value, r.other_value) == (r.own, r.other)
        shares[r.ctx, r.own] += Fraction(r.share) / r.cells
        shares[r.ctx, r.other] += (1 - Fraction(r.share)) / r.cells
    total = Counter()
    for c, _, w in weights:
        total[c] += w
    for c, i, w in weights:
        assert float(shares[c, i]) == pytest.approx(w / total[c], abs=1e-12)


@pytest.mark.parametrize("target", [1 << 20, 150])
def test_draws(spark, model, rows, target):
    contexts = L.train_contexts(model)
    reference = dense(rows)
    toks = as_table(spark, [("x", i, ["a"] * 200) for i in range(20)])
    positions = K.token_pairs(toks, "doc_id")
    words = model.words.select(F.col("id").alias("next_id"), F.col("tok").alias("next"))
    drawn = S.draw_tokens(positions, contexts, ["doc_id"], seed=1, target=target)
    counts = {r.next or "<unk>": r["count"] for r in drawn.join(words, "next_id", "left").groupBy("next").count().collect()}
    assert sum(counts.values()) == 4000
    for word, p in reference.distribution("p", "a").items():
        assert counts.get(word, 0) / 4000 == pytest.approx(p, abs=0.04)
    # The same seed draws the same, whatever the partitioning.
    again = S.draw_tokens(positions.repartition(5), contexts, ["doc_id"], seed=1)
    assert drawn.exceptAll(again).isEmpty()
    assert not drawn.exceptAll(S.draw_tokens(positions, contexts, ["doc_id"], seed=2)).isEmpty()
    value = S.sampled_cross_perplexity(positions, contexts, ["doc_id"], 1).agg(F.avg("x_ppl")).first()[0]
    assert value == pytest.approx(reference.h("a"), rel=0.05)


def test_draws_of_tokens_never_seen(spark, model, rows):
    contexts = L.train_contexts(model)
    positions = K.token_pairs(as_table(spark, [("x", i, ["new", "z", "a"] * 300) for i in range(4)]), "doc_id")
    value = S.sampled_cross_perplexity(positions, contexts, ["doc_id"], 1).agg(F.avg("x_ppl"), F.count("*")).first()
    reference = dense(rows)
    assert value[0] == pytest.approx(sum(map(reference.h, ["new", "z", "a"])) / 3, rel=0.05) and value[1] == 4


def test_no_key_of_a_draw_is_above_the_target(spark, model):
    """One context holds all positions, in few cells: each is repeated."""
    contexts = L.train_contexts(model)
    positions = K.token_pairs(as_table(spark, [("x", i, ["a"] * 100) for i in range(30)]), "doc_id")
    tables = S.alias_tables(S.observer_weights(model))
    cells = tables.where("ctx = 1").count()
    counted = []
    original = S.salted_lookup

    def watched(left, table, key, hot):
        if key == ["ctx", "cell"]:
            counted.append(hot.agg(F.sum("salts")).first()[0])
        return original(left, table, key, hot)

    S.salted_lookup = watched
    try:
        S.draw_tokens(positions, contexts, ["doc_id"], 1, tables, target=50).count()
    finally:
        S.salted_lookup = original
    assert counted[0] >= 3000 / 50 and cells < 30


@pytest.mark.parametrize("most, target", [(1 << 16, 10), (4, 10), (4, 1), (4, 10**6)])
def test_frequent_lookup_is_a_left_join(spark, most, target):
    keys = ["a"] * 20 + ["b"] * 9 + ["c", "d", "gone", None] + ["lost"] * 15
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = frequent_lookup(rows, table, "k", counts, len(keys), target, most)
    assert sorted(map(str, got.select("i", "k", "v").collect())) == sorted(map(str, rows.join(table, "k", "left").select("i", "k", "v").collect()))


def test_positions_travel_without_what_nobody_asks_for(spark, model, rows, monkeypatch):
    positions = K.token_pairs(as_table(spark, rows), "doc_id")
    contexts = L.train_contexts(model)
    pairs, n = M.trained_pair_metrics(contexts), positions.count()
    # More positions than the target, but no pair of the shuffled ones is.
    values = M.token_metrics(positions, pairs, ["doc_id"], hot_pairs=20, target=n - 1)
    plan = M.document_scores(values, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan and "pos#" not in plan.replace("posexplode", "")
    # Draws keep what their two parts need, and the words that are frequent don't shuffle.
    kept, original = [], S.stored
    monkeypatch.setattr(S, "stored", lambda df, name, path=None: kept.append((name, df.columns)) or original(df, name, path))
    S.sampled_cross_perplexity(positions, contexts, ["doc_id"], 1).count()
    assert "pos" not in dict(kept)["draws"]
    drawn = S.draw_tokens(positions, contexts, ["doc_id"], 1, target=n - 1).drop("pos")
    exchanges = [x for x in drawn._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning(tok" in x]
    assert not any("md5" in x or "part#" in x for x in exchanges)


def test_alias_tables_in_many_tasks(spark, model, monkeypatch):
    weights = S.observer_weights(model)
    whole = sorted(map(str, S.alias_tables(weights).collect()))
    monkeypatch.setattr(S, "TASK_ROWS", 5)
    assert sorted(map(str, S.alias_tables(weights).collect())) == whole


def test_long_hot_pairs_and_words_are_split(spark):
    long = "w" * 2000
    rows = [("documents", i, [long, long] * 30) for i in range(10)] + [("conversations", 100 + i, ["a", f"b{i}"]) for i in range(50)]
    toks = as_table(spark, rows)
    m = L.train(toks, F.col("src") == "documents", F.lit(True), ALPHA, LAM)
    positions = K.token_pairs(toks, "doc_id")
    pairs = M.trained_pair_metrics(L.train_contexts(m))
    whole = {r.doc_id: r for r in M.document_scores(M.token_metrics(positions, pairs, ["doc_id"]), ["doc_id"]).collect()}
    for r in M.document_scores(M.token_metrics(positions, pairs, ["doc_id"], target=20), ["doc_id"]).collect():
        assert (r.n_tokens, r.score) == pytest.approx((whole[r.doc_id].n_tokens, whole[r.doc_id].score))
    # 590 positions are followed by the long word itself.
    split = hot_keys(pairs, "pair", "n", 700, 20)
    assert [r.salts for r in split.collect()] == [30]
    # A pair of any length may be broadcast: it is a number.
    assert pairs.where("n > 500 AND length(tok) = 2000 AND length(next) = 2000").count() == 1


def test_pairs_that_share_a_number_get_another(spark, model, rows, monkeypatch):
    original = M.pair_key
    monkeypatch.setattr(M, "pair_key", lambda seed: F.lit(5).cast("long") if isinstance(seed, int) and seed < 2 else original(seed))
    contexts = L.train_contexts(model)
    pairs = M.trained_pair_metrics(contexts)
    assert [r.seed for r in pairs.select("seed").distinct().collect()] == [2]
    positions = K.token_pairs(as_table(spark, rows), "doc_id")
    scores = {r.doc_id: r.score for r in M.document_scores(M.token_metrics(positions, pairs, ["doc_id"]), ["doc_id"]).collect()}
    for _, i, text in rows:
        assert scores[i] == pytest.approx(dense(rows).score(text), nan_ok=True)


def test_ids(spark, rows, model):
    toks = as_table(spark, rows + [("x", 500, []), ("x", 501, ["never", "a"])])
    words = {r.tok: r.id for r in model.words.collect()}
    assert sorted(words.values()) == list(range(1, len(words) + 1)) and sorted(words) == [w for w, _ in sorted(words.items(), key=lambda x: x[1])]
    for r in K.token_ids(toks, model.vocabulary, ["src", "doc_id"]).collect():
        assert r.ids == [words.get(t, K.UNSEEN_ID) for t in r.tokens]
    for r in model.pairs.collect():
        assert r.prev_id == words[r.prev] and r.next_id == words.get(r.next, K.END_ID) and r.n >= max(r.n_p, r.n_q)


def test_vocabularies_compare_tokens_and_ids(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "tok string, id long")
    K.require_same_vocabulary(left, left)
    right = spark.createDataFrame([("a", 1), ("c", 2), ("d", 3)], "tok string, id long")
    assert {tuple(r) for r in K.vocabulary_difference(left, right).collect()} == {("b", 2, None), ("c", 3, 2), ("d", None, 3)}
    with pytest.raises(ValueError, match="vocabularies differ"):
        K.require_same_vocabulary(left, right)
    toks = spark.createDataFrame([(["b", "a"],), (["c", "a"],), ([],)], "tokens array<string>")
    assert {tuple(r) for r in K.vocabulary(toks).select("tok", "id").collect()} == {("a", 1), ("b", 2), ("c", 3)}


def dense_logits(rng, size):
    return [rng.gauss(0, 3) for _ in range(size)]


def log_softmax(logits, t):
    whole = math.log(sum(math.exp(x / t) for x in logits))
    return [x / t - whole for x in logits]


@pytest.mark.parametrize("t", [0.6, 1.0, 1.7])
def test_metrics_of_given_logits(spark, t):
    """Whole lists, and lists cut short whose other tokens are alike."""
    rng = random.Random(3)
    rows, expected = [], {}
    for i in range(30):
        p, q, size = dense_logits(rng, 9), dense_logits(rng, 9), 1 + i % 5
        label = None if i % 7 == 6 else rng.randrange(9)
        rows.append((i, 1, "w", label, p, q, None, None, None))
        lp, lq = log_softmax(p, t), log_softmax(q, t)
        expected[i] = (None if label is None else -lq[label], -sum(math.exp(a) * b for a, b in zip(lp, lq, strict=True)))
        more_p, more_q = p + [p[0] - 1] * size, q + [q[1] + 0.5] * size
        tails = [math.log(size * math.exp(x)) for x in (p[0] - 1, q[1] + 0.5)]
        rows.append((100 + i, 1, "w", -1 if i % 2 else label, p, q, *tails, size))
        lp, lq = log_softmax(more_p, t), log_softmax(more_q, t)
        chosen = -lq[-1] if i % 2 else None if label is None else -lq[label]
        expected[100 + i] = (chosen, -sum(math.exp(a) * b for a, b in zip(lp, lq, strict=True)))
    rows.append((900, 1, "w", -1, [], [], 0.0, 0.0, 4))
    expected[900] = (math.log(4), math.log(4))
    rows.append((901, 1, "w", 0, [2000.0, 0.0], [0.0, 2000.0], None, None, 0))
    expected[901] = (2000 / t, 2000 / t)
    df = spark.createDataFrame(rows, "doc_id long, pos int, tok string, label int, observer array<double>, performer array<double>, observer_tail double, performer_tail double, tail_size long")
    got = Z.logit_metrics(df, ["doc_id"], t)
    assert {r.doc_id for r in got.collect()} == set(expected)
    for r in got.collect():
        nll, h = expected[r.doc_id]
        assert r.h == pytest.approx(h, abs=1e-9) and (r.nll is None if nll is None else r.nll == pytest.approx(nll, abs=1e-9))
    assert M.document_scores(got, ["doc_id"]).count() == len(expected)
    with pytest.raises(ValueError):
        Z.logit_metrics(df, ["doc_id"], 0)


def test_models_store_counts_and_pair_values_nothing(spark, rows, monkeypatch, tmp_path):
    kept = []
    for module in (L, M):
        original = module.stored
        monkeypatch.setattr(
            module, "stored", lambda df, name, path=None, write=original: kept.append((name, df.columns)) or write(df, name, path)
        )
    trained = L.train(as_table(spark, rows), F.col("src") == "documents", F.lit(True), ALPHA, LAM, str(tmp_path / "m"))
    assert not {"u_p", "u_q", "prob_p", "prob_q"} & set(dict(kept)["pairs"])
    # Probabilities follow from the counts, before and after loading; ends have none.
    listed = lambda m: sorted(map(str, m.pairs.collect()))
    assert listed(trained) == listed(L.load_model(spark, str(tmp_path / "m")))
    reference = dense(rows)
    for r in trained.pairs.collect():
        if r.next == K.END:
            assert r.u_q is None and r.prob_q is None
        else:
            assert -math.log(r.prob_q) == pytest.approx(reference.nll(r.prev, r.next), abs=1e-12)
    kept.clear()
    contexts = L.train_contexts(trained)
    pairs = M.trained_pair_metrics(contexts)
    positions = K.token_pairs(as_table(spark, rows), "doc_id")
    scores = {r.doc_id: r.score for r in M.document_scores(M.token_metrics(positions, pairs, ["doc_id"], hot_pairs=20), ["doc_id"]).collect()}
    for _, i, text in rows:
        assert scores[i] == pytest.approx(reference.score(text), nan_ok=True)
    assert [name for name, _ in kept] == ["contexts", "hot_pairs"]
    metadata = pairs.schema["pair"].metadata
    assert metadata == {"seed": 0, "total": sum(len(text) for _, _, text in rows)}


def test_slices_hold_every_row_once(spark, tmp_path):
    texts = [("documents", i, ["w%d" % (i % 7), "v%d" % (i % 3)][: i % 3] * 50) for i in range(300)]
    as_table(spark, texts).coalesce(1).write.parquet(str(tmp_path / "toks"))
    toks = spark.read.parquet(str(tmp_path / "toks"))
    parts = K.sliced(toks, slice_bytes=200)
    assert parts.rdd.getNumPartitions() > 1 and K.sliced(toks) is toks
    assert sorted(map(str, parts.collect())) == sorted(map(str, toks.collect()))
