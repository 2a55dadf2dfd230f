"""A pair of language models as Spark tables.

Observer and performer are bigram models interpolated with a smoothed unigram
model over one shared vocabulary:

    u_m(w)   = (n_m(w) + alpha) / (N_m + alpha V)
    P_m(w|c) = l_m(c) C_m(c,w) / C_m(c) + (1 - l_m(c)) u_m(w)
    l_m(c)   = lam if C_m(c) > 0 else 0

V counts the distinct tokens plus one slot for every token not seen in
training, so that any text can be scored. Both models live side by side in the
same rows (suffix ``_p`` observer, ``_q`` performer): one pass over the text
and one shuffle count both.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perplexis.operators.lookup import frequent_lookup
from perplexis.operators.tokens import END, END_ID, numbered_vocabulary, sliced, token_pairs
from perplexis.sources.workspace import cleared, first_row, new_path, stored

DEFAULT_ALPHA = 0.5
DEFAULT_LAM = 0.7


@dataclass(frozen=True)
class ModelPair:
    """Trained tables and their scalars.

    ``words``, the dictionary: id, tok, n_p, n_q (token counts), c_p, c_q (times
    followed by a token), types (number of distinct pairs it starts). Ids are
    dense, from 1, in the order of the tokens.
    ``pairs``: prev_id, next_id (``END_ID`` at ends of texts), prev, next (the
    same as text, ``END`` at ends), n (rows of either corpus), n_p, n_q, and for
    pairs of tokens the probabilities u_p, u_q (of the second token alone) and
    prob_p, prob_q (of it after the first). Counts are stored; probabilities follow from them.
    """

    pairs: DataFrame
    words: DataFrame
    alpha: float
    lam: float
    vocabulary_size: int
    total_p: int
    total_q: int
    pair_types: int

    @property
    def prev_counts(self) -> DataFrame:
        """``prev_id, n``: how many of the distinct pairs a word starts."""
        return self.words.select(F.col("id").alias("prev_id"), F.col("types").alias("n"))

    @property
    def vocabulary(self) -> DataFrame:
        """``tok, id``."""
        return self.words.select("tok", "id")

    def unigram(self, role: str, count: str | None = None) -> Column:
        total = self.total_p if role == "p" else self.total_q
        size = total + self.alpha * self.vocabulary_size
        n = F.coalesce(F.col(count or f"n_{role}"), F.lit(0))
        return (n + F.lit(self.alpha)) / F.lit(size)

    def unseen_unigram(self, role: str) -> float:
        total = self.total_p if role == "p" else self.total_q
        return self.alpha / (total + self.alpha * self.vocabulary_size)

    def backoff(self, context_count: str) -> Column:
        """1 - l(c): the whole mass for a context never followed by a token."""
        seen = F.coalesce(F.col(context_count), F.lit(0)) > 0
        return F.when(seen, F.lit(1 - self.lam)).otherwise(F.lit(1.0))

    def conditional(self, pair_count: str, context_count: str, unigram: Column) -> Column:
        observed = F.when(
            F.col(context_count) > 0,
            F.lit(self.lam) * F.coalesce(F.col(pair_count), F.lit(0)) / F.col(context_count),
        ).otherwise(F.lit(0.0))
        return observed + self.backoff(context_count) * unigram


def count_pairs(toks: DataFrame, observer: Column, performer: Column) -> DataFrame:
    """Adjacent token pairs with their counts in either training corpus.

    ``observer`` and ``performer`` are conditions on the rows of ``toks`` that
    select the corpora; they may overlap, and null selects nothing. Counts combine before the shuffle.
    """
    rows = toks.select(
        "tokens", *[
            F.coalesce(condition, F.lit(False)).cast("long").alias(name)
            for condition, name in ((observer, "_p"), (performer, "_q"))
        ]
    ).where("_p + _q > 0")
    return token_pairs(rows, "_p", "_q").groupBy(F.col("tok").alias("prev"), "next").agg(
        F.sum("_p").alias("n_p"), F.sum("_q").alias("n_q"), F.count("*").alias("n")
    )


def count_words(pairs: DataFrame) -> DataFrame:
    """Token and context counts out of the pair counts; the text isn't read again.

    Each position of a text starts one pair, the last one a pair with its end.
    """
    follows = (F.col("next") != END).cast("long")
    return pairs.groupBy(F.col("prev").alias("tok")).agg(
        *[F.sum(f"n_{r}").alias(f"n_{r}") for r in "pq"],
        *[F.sum(F.col(f"n_{r}") * follows).alias(f"c_{r}") for r in "pq"],
        F.count("*").alias("types"),
    )


def train(toks: DataFrame, observer: Column, performer: Column, alpha: float = DEFAULT_ALPHA,
          lam: float = DEFAULT_LAM, path: str | None = None) -> ModelPair:
    """Trains both models and writes their tables under ``path``.

    ``toks`` is a stored table. Only distinct pairs meet the dictionary, for ids and
    counts together; from there on all joins are on ids.
    """
    if not alpha > 0 or not 0 < lam < 1:
        raise ValueError("alpha must be positive and lam strictly between 0 and 1")
    spark = toks.sparkSession
    path = path or new_path(spark, "model")
    # The counts go once the pairs know their words.
    with cleared(spark):
        counted = stored(count_pairs(sliced(toks), observer, performer), "pair_counts")
        words = stored(numbered_vocabulary(count_words(counted)), "words", f"{path}/words")
        spark.range(1).select(F.lit(alpha).alias("alpha"), F.lit(lam).alias("lam")).write.json(f"{path}/parameters")
        model = _with_totals(counted, words, alpha, lam)
        pairs = stored(_known_pairs(model), "pairs", f"{path}/pairs")
    return _with_probabilities(replace(model, pairs=pairs))


def _known_pairs(model: ModelPair) -> DataFrame:
    """Counted pairs (of tokens as text) with ids, and the counts of both tokens: w of the second, c of the first."""
    counted, words = model.pairs, model.words
    nexts = words.select(
        F.col("tok").alias("next"), F.col("id").alias("next_id"), F.col("n_p").alias("w_p"), F.col("n_q").alias("w_q")
    )
    prevs = words.select(F.col("tok").alias("prev"), F.col("id").alias("prev_id"), "c_p", "c_q")
    ends = stored(counted.groupBy("next").agg(F.count("*").alias("n")), "ends")
    starts = words.select(F.col("tok").alias("prev"), F.col("types").alias("n"))
    joined = frequent_lookup(counted, nexts, "next", ends, model.pair_types)
    joined = frequent_lookup(joined, prevs, "prev", starts, model.pair_types)
    return joined.select(
        "prev_id", F.coalesce("next_id", F.lit(END_ID)).alias("next_id"), "prev", "next", "n", "n_p", "n_q",
        "w_p", "w_q", "c_p", "c_q",
    )


def _with_probabilities(model: ModelPair) -> ModelPair:
    """The model with probabilities of its pairs out of their counts; ends have none."""
    alone = {f"u_{r}": F.when(F.col("next_id") != END_ID, model.unigram(r, f"w_{r}")) for r in "pq"}
    pairs = model.pairs.withColumns(alone).select(
        "prev_id", "next_id", "prev", "next", "n", "n_p", "n_q", "u_p", "u_q",
        *[model.conditional(f"n_{r}", f"c_{r}", F.col(f"u_{r}")).alias(f"prob_{r}") for r in "pq"],
    )
    return replace(model, pairs=pairs)


def load_model(spark: SparkSession, path: str) -> ModelPair:
    parameters = spark.read.schema("alpha double, lam double").json(f"{path}/parameters").first()
    model = _with_totals(
        spark.read.parquet(f"{path}/pairs"), spark.read.parquet(f"{path}/words"),
        parameters.alpha, parameters.lam,
    )
    # Earlier models hold the probabilities themselves.
    return model if "prob_p" in model.pairs.columns else _with_probabilities(model)


def _with_totals(pairs: DataFrame, words: DataFrame, alpha: float, lam: float) -> ModelPair:
    # One row of four numbers reaches the driver.
    t = first_row(words.agg(
        F.count("*").alias("v"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_p", "n_q", "types")],
    ))
    return ModelPair(pairs, words, alpha, lam, t.v + 1, t.n_p, t.n_q, t.types)


def same_model(model: ModelPair, role: str = "p") -> ModelPair:
    """One model in both roles, out of the tables of the pair.

    ``n`` stays, so that pairs frequent in either corpus are still known as such.
    """
    both = lambda *names: {f"{c}_{r}": F.col(f"{c}_{role}") for c in names for r in "pq"}
    total = model.total_p if role == "p" else model.total_q
    return replace(
        model, pairs=model.pairs.withColumns(both("n", "u", "prob")), words=model.words.withColumns(both("n", "c")),
        total_p=total, total_q=total,
    )


def power(value: Column, temperature: float) -> Column:
    return value if temperature == 1 else F.pow(value, F.lit(1 / temperature))


@dataclass(frozen=True)
class Contexts:
    """What a position's context contributes, at one temperature.

    ``table``: id, tok, n_q, c_q, types, h (cross-entropy of the
    performer under the observer), log_z (log normaliser of the performer),
    pick (share of the observer's mass that its bigram counts add to the
    unigram part), mass_p, mass_q (total probability, 1 up to rounding).
    ``unseen_h`` and ``unseen_log_z`` hold for any context without a row.
    """

    model: ModelPair
    temperature: float
    table: DataFrame
    unseen_h: float
    unseen_log_z: float


def train_contexts(model: ModelPair, temperature: float = 1.0, path: str | None = None) -> Contexts:
    """Exact full-vocabulary cross-entropy of every context, in closed form.

    A sum over the vocabulary splits into the few words seen after the context
    and a remainder that depends on the context through sums over those words
    only, so the cost is the number of distinct pairs.
    """
    if not temperature > 0:
        raise ValueError("temperature must be positive")
    t = temperature
    u_p, u_q = model.unigram("p"), model.unigram("q")
    g = model.words.agg(
        F.sum(power(u_p, t)).alias("s_p"), F.sum(power(u_q, t)).alias("s_q"),
        F.sum(power(u_p, t) * F.ln(u_q)).alias("x"),
    ).first()
    u0_p, u0_q = model.unseen_unigram("p") ** (1 / t), model.unseen_unigram("q") ** (1 / t)
    s_p = (g.s_p or 0.0) + u0_p
    s_q = (g.s_q or 0.0) + u0_q
    x = (g.x or 0.0) + u0_p * math.log(model.unseen_unigram("q"))

    pw_p = power(F.col("prob_p"), t)
    a = power(F.col("u_p"), t)
    sums = model.pairs.where(F.col("next_id") != END_ID).groupBy(F.col("prev_id").alias("id")).agg(
        F.sum(pw_p).alias("e_p"),
        F.sum(power(F.col("prob_q"), t)).alias("e_q"),
        F.sum(pw_p * F.ln("prob_q")).alias("cross"),
        F.sum(a).alias("a"),
        F.sum(power(F.col("u_q"), t)).alias("b"),
        F.sum(a * F.ln("u_q")).alias("a_log"),
    )
    zero = F.lit(0.0)
    full = model.words.join(sums, "id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("e_p", "e_q", "cross", "a", "b", "a_log")}
    )
    full = full.withColumns({
        "k_p": power(model.backoff("c_p"), t), "k_q": power(model.backoff("c_q"), t),
        "log_k": F.ln(model.backoff("c_q")),
    }).withColumns({
        "z_p": F.col("e_p") + F.col("k_p") * (F.lit(s_p) - F.col("a")),
        "log_z": F.ln(F.col("e_q") + F.col("k_q") * (F.lit(s_q) - F.col("b"))),
    })
    rest = (F.col("log_k") / t - F.col("log_z")) * (F.lit(s_p) - F.col("a")) + (F.lit(x) - F.col("a_log")) / t
    inside = F.col("cross") / t - F.col("log_z") * F.col("e_p") + F.col("k_p") * rest
    table = full.select(
        "id", "tok", "n_q", "c_q", "types",
        (-inside / F.col("z_p")).alias("h"),
        "log_z",
        F.when(F.col("c_p") > 0, 1 - F.col("k_p") * s_p / F.col("z_p")).otherwise(0.0).alias("pick"),
        *[
            (F.col(f"e_{r}") + F.col(f"k_{r}") * (F.lit(s) - F.col(c))).alias(f"mass_{r}")
            for r, s, c in (("p", s_p, "a"), ("q", s_q, "b"))
        ],
    )
    log_s = math.log(s_q)
    return Contexts(model, t, stored(table, "contexts", path), log_s - x / (t * s_p), log_s)


def _long(df: DataFrame, keys: Sequence[str], columns: dict) -> DataFrame:
    """One row per model out of the side-by-side columns."""
    structs = [
        F.struct(F.lit(name).alias("model"), *[c.alias(out) for out, c in columns[role].items()])
        for role, name in (("p", "observer"), ("q", "performer"))
    ]
    return df.select(*keys, F.inline(F.array(*structs)))


def unigram_table(model: ModelPair) -> DataFrame:
    """``model, tok, n, u`` over the shared vocabulary."""
    return _long(model.words, ["tok"], {
        r: {"n": F.col(f"n_{r}"), "u": model.unigram(r)} for r in "pq"
    })


def bigram_table(model: ModelPair) -> DataFrame:
    """``model, prev, tok, n``."""
    inner = model.pairs.where(F.col("next") != END).withColumnRenamed("next", "tok")
    return _long(inner, ["prev", "tok"], {r: {"n": F.col(f"n_{r}")} for r in "pq"}).where("n > 0")


def context_table(model: ModelPair) -> DataFrame:
    """``model, prev, n``."""
    words = model.words.withColumnRenamed("tok", "prev")
    return _long(words, ["prev"], {r: {"n": F.col(f"c_{r}")} for r in "pq"}).where("n > 0")
