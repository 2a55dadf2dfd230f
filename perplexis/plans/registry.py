"""One query per operator over the given tables.

Tables that several queries share (tokens, models, pair values, scores) are
built once per session and data folder, written to the workspace and read from
there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perplexis.functions import decision as D
from perplexis.functions import text as T
from perplexis.functions.naming import DEFAULT_OUTPUT_SUFFIX
from perplexis.operators import evaluation as E
from perplexis.operators import metrics as M
from perplexis.operators import logits as Z
from perplexis.operators import missing as G
from perplexis.operators import model as L
from perplexis.operators import tokens as K
from perplexis.operators.sampling import alias_tables, observer_weights, sampled_cross_perplexity
from perplexis.plans.scoring import Scorer, score_texts
from perplexis.sources import files
from perplexis.sources.workspace import new_path, spread, stored

KEYS = ("src", "doc_id", "turn")
TEMPERATURE = 1.7
SEED = 7
PAD = "<pad>"
BATCH_SIZE = 32
MASK_TOKENS = ("the", "de")
ROWS_PER_FILE = 10
FILES_PER_SOURCE = 4
LISTED_TOKENS = 8


def _round(column: str | Column, digits: int = 6) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    name = column if isinstance(column, str) else None
    return F.round(col, digits).alias(name) if name else F.round(col, digits)


class Tables:
    """Inputs and shared intermediate tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def texts(self) -> DataFrame:
        documents = self.read("documents").select(
            F.lit("documents").alias("src"), "doc_id", F.lit(0).cast("long").alias("turn"), "text"
        )
        conversations = self.read("conversations").select(
            F.lit("conversations").alias("src"), F.col("conv_id").alias("doc_id"), "turn", "text"
        )
        return spread(documents.unionByName(conversations))

    @cached_property
    def toks(self) -> DataFrame:
        return stored(K.tokenize(self.texts, KEYS), "tokens")

    @property
    def positions(self) -> DataFrame:
        return K.token_pairs(self.toks, *KEYS)

    @property
    def in_documents(self) -> Column:
        return F.col("src") == "documents"

    @cached_property
    def model(self) -> L.ModelPair:
        return L.train(self.toks, observer=self.in_documents, performer=F.lit(True))

    @cached_property
    def contexts(self) -> L.Contexts:
        return L.train_contexts(self.model)

    @cached_property
    def alias_tables(self) -> DataFrame:
        return alias_tables(observer_weights(self.model))

    @cached_property
    def tempered(self) -> L.Contexts:
        return L.train_contexts(self.model, TEMPERATURE)

    @cached_property
    def pair_values(self) -> DataFrame:
        return M.trained_pair_metrics(self.contexts)

    @cached_property
    def tempered_pair_values(self) -> DataFrame:
        return M.trained_pair_metrics(self.tempered)

    @property
    def token_metrics(self) -> DataFrame:
        return M.token_metrics(self.positions, self.pair_values, KEYS)

    @cached_property
    def scores(self) -> DataFrame:
        return stored(M.document_scores(self.token_metrics, KEYS), "scores")

    @property
    def dirty(self) -> DataFrame:
        """``documents`` by file, and with each a further row of null or junk, of negative key."""
        documents = spread(self.read("documents")).select(
            "doc_id", F.col("source").alias("file"), "lang", "text"
        )
        kind = F.pmod("doc_id", F.lit(4))
        junk = (
            F.when(kind == 1, F.lit("")).when(kind == 2, F.lit("\t\u00a0")).when(kind == 3, F.lit("!!!"))
        )
        return documents.unionByName(
            self.read("documents").select(
                (-1 - F.col("doc_id")).alias("doc_id"), F.col("source").alias("file"), "lang", junk.alias("text")
            )
        )

    @property
    def dirty_scores(self) -> DataFrame:
        """Scores of the documents, which are those rows of ``dirty`` that have one."""
        return self.scores.where(self.in_documents)

    @cached_property
    def scored(self) -> DataFrame:
        """``dirty`` with its scores."""
        return stored(G.attach_scores(self.dirty, self.dirty_scores, ["doc_id"]), "scored")

    @property
    def named(self) -> Column:
        """Each source is a few input files."""
        return F.concat("file", F.lit("-"), F.pmod("doc_id", F.lit(FILES_PER_SOURCE)))

    @cached_property
    def scored_files(self) -> str:
        """A folder of input files and, beside them, the scored files that the job made of them."""
        folder = new_path(self.spark, "files")
        files.write_named(self.dirty.withColumn("name", self.named), folder, "name")
        Scorer(self.contexts).score_files([folder])
        return folder

    @property
    def partly_scored(self) -> DataFrame:
        """``scored`` with the scores of two languages lost."""
        kept = (
            F.when(F.col("lang") == "de", F.lit(None))
            .when(F.col("lang") == "es", F.lit(float("nan")))
            .otherwise(F.col("score"))
        )
        return self.scored.withColumn("score", kept)

    @cached_property
    def evaluation(self) -> DataFrame:
        roles = self.read("conversations").select(
            F.lit("conversations").alias("src"), F.col("conv_id").alias("doc_id"), "turn", "role"
        )
        # Equal texts tie exactly once the scores are rounded.
        scored = self.scores.join(roles, list(KEYS)).select("role", _round("score"))
        return stored(
            E.evaluation_table(
                scored.where("NOT (role <=> 'assistant')"), scored.where("role = 'assistant'")
            ),
            "evaluation",
        )

    @cached_property
    def cumulative(self) -> DataFrame:
        return E.cumulative_counts(self.evaluation)

    @property
    def listed_logits(self) -> DataFrame:
        """Positions of the conversations with logits of the tokens most often seen next, and a tail for all others."""
        model = self.model
        seen = model.pairs.where(F.col("next_id") != K.END_ID)
        place = F.row_number().over(Window.partitionBy("prev_id").orderBy(F.col("n_q").desc(), "next_id"))
        listed = seen.withColumn("place", place).where(F.col("place") <= LISTED_TOKENS)
        entry = F.struct("place", "next", F.ln("prob_p").alias("p"), F.ln("prob_q").alias("q"), "prob_p", "prob_q")
        lists = listed.groupBy("prev").agg(F.array_sort(F.collect_list(entry)).alias("list"))
        rest = lambda name: F.aggregate(F.col(f"list.prob_{name}"), F.lit(1.0), lambda left, x: left - x)
        lists = lists.select(
            F.col("prev").alias("tok"), F.col("list.next").alias("tokens"), F.col("list.p").alias("observer"),
            F.col("list.q").alias("performer"), F.ln(rest("p")).alias("observer_tail"), F.ln(rest("q")).alias("performer_tail"),
        )
        none, nothing = F.array().cast("array<double>"), F.array().cast("array<string>")
        positions = K.next_token_pairs(self.toks.where(~self.in_documents), KEYS).join(lists, "tok", "left")
        tokens = F.coalesce("tokens", nothing)
        return positions.select(
            *KEYS, "pos", "tok",
            (F.array_position(tokens, F.col("next")) - 1).cast("int").alias("label"),
            *[F.coalesce(c, none).alias(c) for c in ("observer", "performer")],
            *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("observer_tail", "performer_tail")],
            (F.lit(model.vocabulary_size) - F.size(tokens)).alias("tail_size"),
        )

    @property
    def external_metrics(self) -> DataFrame:
        """Per-position values that don't come from our models."""
        return K.next_token_pairs(self.toks, KEYS).select(
            *KEYS, "pos", "tok",
            F.ln(1 + F.length("next")).alias("nll"), F.ln(2 + F.length("tok")).alias("h"),
        )


_tables: dict[tuple[str, str], Tables] = {}


def forget() -> None:
    """Drops what was built of all folders, for data that have changed."""
    _tables.clear()


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = Tables(spark, folder)
    return _tables[key]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]):
    """Registers a query under its function's name."""
    QUERIES[build.__name__] = lambda spark, folder: build(tables(spark, folder))
    return build


def _rounded_scores(scores: DataFrame) -> DataFrame:
    return scores.select(*KEYS, "n_tokens", _round("ppl"), _round("x_ppl"), _round("score"))


# Sources and sinks

@query
def scan_documents(t: Tables) -> DataFrame:
    return t.read("documents")


@query
def collect_inputs(t: Tables) -> DataFrame:
    counts = files.count_rows(t.spark, files.collect_inputs(t.spark, [t.folder]))
    return counts.withColumn("file", F.element_at(F.split("file", "/"), -1))


@query
def exclude_outputs(t: Tables) -> DataFrame:
    """Rows of the input files of a folder that also holds the scored files."""
    counts = files.count_rows(t.spark, files.collect_inputs(t.spark, [t.scored_files]))
    return counts.select(F.element_at(F.split("file", "/"), -1).alias("file"), "n_rows")


@query
def scan_jsonl(t: Tables) -> DataFrame:
    path = new_path(t.spark, "jsonl")
    t.read("documents").select("doc_id", "lang", "text").write.json(path)
    return files.read_samples(t.spark, path).select("doc_id", "lang", "text")


@query
def write_scored(t: Tables) -> DataFrame:
    outputs = set(files.collect_inputs(t.spark, [t.scored_files], include_outputs=True))
    outputs -= set(files.collect_inputs(t.spark, [t.scored_files]))
    scored = files.read_texts(t.spark, sorted(outputs))
    return scored.select("doc_id", F.col("given_file").alias("file"), "lang", "text", _round("score"))


@query
def backfill_write(t: Tables) -> DataFrame:
    folder = new_path(t.spark, "output")
    name = F.concat(t.named, F.lit(DEFAULT_OUTPUT_SUFFIX))
    files.write_named(t.partly_scored.withColumn("name", name), folder, "name")
    Scorer(t.contexts).score_missing(folder)
    return t.spark.read.parquet(folder).select("doc_id", "file", _round("score"))


@query
def write_eval_csv(t: Tables) -> DataFrame:
    folder = new_path(t.spark, "csv")
    files.write_evaluation(t.evaluation, folder)
    return t.spark.read.option("header", True).schema("score double, class int, pred int").csv(folder)


# Text and tokens

@query
def normalize_text(t: Tables) -> DataFrame:
    return t.dirty.select("doc_id", T.text_or_empty("text").alias("text"))


@query
def split_scoreable(t: Tables) -> DataFrame:
    return t.dirty.select("doc_id", "file", T.is_scoreable("text").alias("scoreable"))


@query
def token_count(t: Tables) -> DataFrame:
    return t.texts.select(*KEYS, T.token_count("text").alias("n_tokens"))


def _joined_tokens(toks: DataFrame) -> DataFrame:
    return toks.select(*KEYS, F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query
def tokenize(t: Tables) -> DataFrame:
    numbered = K.token_ids(t.toks, t.model.vocabulary, KEYS)
    return numbered.select(
        *KEYS, F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"),
    )


@query
def truncate_tokens(t: Tables) -> DataFrame:
    return _joined_tokens(K.tokenize(t.texts, KEYS, max_tokens=T.DEFAULT_MAX_TOKENS))


@query
def token_positions(t: Tables) -> DataFrame:
    return K.token_positions(t.toks, KEYS)


@query
def next_token_pairs(t: Tables) -> DataFrame:
    return K.next_token_pairs(t.toks, KEYS)


@query
def pad_mask(t: Tables) -> DataFrame:
    return K.pad_batches(t.toks, ["doc_id", "turn"], BATCH_SIZE, PAD, by=["src"]).select(
        *KEYS, "batch_id",
        F.array_join("padded", " ").alias("padded"),
        F.array_join(F.col("mask").cast("array<string>"), "").alias("mask"),
    )


@query
def vocab_diff(t: Tables) -> DataFrame:
    """Tokens whose ids differ between two vocabularies; 0 where one lacks the token."""
    left, right = (K.vocabulary(t.toks.where(side)) for side in (t.in_documents, ~t.in_documents))
    different = K.vocabulary_difference(left, right)
    return different.select("tok", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("left_id", "right_id")])


# Models

@query
def lm_unigram(t: Tables) -> DataFrame:
    return L.unigram_table(t.model).select("model", "tok", "n", F.round("u", 12).alias("u"))


@query
def lm_bigram(t: Tables) -> DataFrame:
    return L.bigram_table(t.model)


@query
def lm_context(t: Tables) -> DataFrame:
    return L.context_table(t.model)


@query
def softmax_check(t: Tables) -> DataFrame:
    return t.contexts.table.select("tok", _round("mass_p"), _round("mass_q"))


@query
def xent_by_context(t: Tables) -> DataFrame:
    return t.contexts.table.select(F.col("tok").alias("prev"), _round("h"))


# Values per position and text

@query
def token_nll(t: Tables) -> DataFrame:
    return t.token_metrics.where("nll IS NOT NULL").select(*KEYS, "pos", "tok", _round("nll"))


@query
def token_xent(t: Tables) -> DataFrame:
    return t.token_metrics.select(*KEYS, "pos", "tok", _round("h"))


def _per_text(t: Tables, value: Column) -> DataFrame:
    return t.token_metrics.groupBy(*KEYS).agg(F.round(value, 6).alias("value"))


@query
def ppl_mean(t: Tables) -> DataFrame:
    return _per_text(t, M.perplexity()).withColumnRenamed("value", "ppl")


@query
def ppl_median(t: Tables) -> DataFrame:
    return _per_text(t, M.perplexity(median=True)).withColumnRenamed("value", "ppl")


@query
def x_ppl_mean(t: Tables) -> DataFrame:
    return _per_text(t, M.cross_perplexity()).withColumnRenamed("value", "x_ppl")


@query
def x_ppl_median(t: Tables) -> DataFrame:
    return _per_text(t, M.cross_perplexity(median=True)).withColumnRenamed("value", "x_ppl")


@query
def x_ppl_pad_masked(t: Tables) -> DataFrame:
    return _per_text(t, M.cross_perplexity(mask_tokens=MASK_TOKENS)).withColumnRenamed("value", "x_ppl")


@query
def ppl_temperature(t: Tables) -> DataFrame:
    metrics = M.token_metrics(t.positions, t.tempered_pair_values, KEYS)
    return metrics.groupBy(*KEYS).agg(F.round(M.perplexity(), 6).alias("ppl"))


@query
def x_ppl_temperature(t: Tables) -> DataFrame:
    metrics = M.token_metrics(t.positions, t.tempered_pair_values, KEYS)
    return metrics.groupBy(*KEYS).agg(F.round(M.cross_perplexity(), 6).alias("x_ppl"))


@query
def x_ppl_sampled(t: Tables) -> DataFrame:
    drawn = sampled_cross_perplexity(t.positions, t.contexts, KEYS, SEED, tables=t.alias_tables)
    return drawn.select(*KEYS, _round("x_ppl"))


@query
def doc_scores(t: Tables) -> DataFrame:
    return _rounded_scores(M.document_scores(t.token_metrics, KEYS))


@query
def doc_scores_window(t: Tables) -> DataFrame:
    """Only the first tokens of each text are observed, which is a feature."""
    return _rounded_scores(score_texts(t.texts, KEYS, t.contexts, max_tokens=T.DEFAULT_MAX_TOKENS))


@query
def score_from_metrics(t: Tables) -> DataFrame:
    return _rounded_scores(M.document_scores(t.external_metrics, KEYS))


@query
def logit_metrics(t: Tables) -> DataFrame:
    values = Z.logit_metrics(t.listed_logits, KEYS, TEMPERATURE)
    return values.select(*KEYS, "pos", "tok", _round("nll"), _round("h"))


@query
def self_entropy_scores(t: Tables) -> DataFrame:
    contexts = L.train_contexts(L.same_model(t.model, "p"))
    pairs = M.trained_pair_metrics(contexts)
    return _rounded_scores(M.document_scores(M.token_metrics(t.positions, pairs, KEYS), KEYS))


# Decisions

@query
def mode_threshold(t: Tables) -> DataFrame:
    modes = t.scores.select(*KEYS, "score", F.explode(F.array(*map(F.lit, D.THRESHOLDS))).alias("mode"))
    limit = D.mode_threshold(F.col("mode"))
    return modes.select(
        *KEYS, "mode", D.mode_display_name(F.col("mode")).alias("shown"),
        limit.alias("threshold"), D.label(F.col("score"), limit).alias("label"),
    )


@query
def predict_label(t: Tables) -> DataFrame:
    threshold = D.threshold_of(D.DEFAULT_MODE)
    return t.scores.select(*KEYS, D.label(F.col("score"), threshold).alias("label"))


@query
def predict_binary(t: Tables) -> DataFrame:
    threshold = D.threshold_of("accuracy")
    return t.scores.select(*KEYS, D.binary_prediction(F.col("score"), threshold).alias("pred"))


@query
def gated_predict(t: Tables) -> DataFrame:
    threshold = D.threshold_of(D.DEFAULT_MODE)
    return t.scored.select(
        "doc_id",
        T.token_count("text").alias("n_tokens"),
        D.is_too_short("text").alias("too_short"),
        D.gated_label("text", F.col("score"), threshold).alias("label"),
    )


# Missing scores and reports

@query
def attach_scores(t: Tables) -> DataFrame:
    return G.attach_scores(t.dirty, t.dirty_scores, ["doc_id"]).select("doc_id", "file", _round("score"))


@query
def find_missing(t: Tables) -> DataFrame:
    return G.find_missing(t.partly_scored).select("doc_id", "file", "scoreable")


@query
def backfill_scores(t: Tables) -> DataFrame:
    gaps = G.find_missing(t.partly_scored).where("scoreable")
    fresh = score_texts(gaps, ["doc_id"], t.contexts, max_tokens=None)
    return G.backfill_scores(t.partly_scored, fresh, ["doc_id"]).select("doc_id", "file", _round("score"))


@query
def score_counts(t: Tables) -> DataFrame:
    return G.score_counts(t.scored)


@query
def score_summary(t: Tables) -> DataFrame:
    return G.score_summary(t.scored)


@query
def missing_report(t: Tables) -> DataFrame:
    return G.missing_report(t.partly_scored)


@query
def missing_preview(t: Tables) -> DataFrame:
    return G.missing_preview(t.partly_scored, "doc_id")


@query
def scoreable_status(t: Tables) -> DataFrame:
    return G.scoreable_status(t.dirty)


@query
def limit_per_file(t: Tables) -> DataFrame:
    return G.limit_per_file(t.dirty, ROWS_PER_FILE, ["doc_id"]).select("doc_id", "file", "text")


# Evaluation

@query
def eval_table(t: Tables) -> DataFrame:
    return t.evaluation


@query
def confusion(t: Tables) -> DataFrame:
    return E.confusion(t.evaluation)


@query
def f1(t: Tables) -> DataFrame:
    return E.f1(t.evaluation).select(_round("f1"), "n", "n_missing")


def _rounded_curve(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", "fp", "tp", _round("fpr"), _round("tpr"))


@query
def roc_curve(t: Tables) -> DataFrame:
    return _rounded_curve(E.roc_curve(t.cumulative))


@query
def roc_curve_thin(t: Tables) -> DataFrame:
    return _rounded_curve(E.roc_curve_thin(t.cumulative))


@query
def roc_auc(t: Tables) -> DataFrame:
    return E.roc_auc(t.cumulative).select(_round("auc"))


@query
def roc_auc_rank(t: Tables) -> DataFrame:
    return E.roc_auc_rank(t.cumulative).select(_round("auc"))


@query
def tpr_at_fpr(t: Tables) -> DataFrame:
    return E.tpr_at_fpr(t.cumulative).select("fpr", _round("tpr"))


@query
def roc_log_grid(t: Tables) -> DataFrame:
    return E.roc_log_grid(t.cumulative).select(_round("fpr"), _round("tpr"))


@query
def eval_metrics(t: Tables) -> DataFrame:
    return E.evaluation_metrics(t.evaluation, t.cumulative).select(
        "n", "n_missing", _round("f1"), _round("auc"), _round("tpr_at_fpr")
    )


@query
def calibrate_f1(t: Tables) -> DataFrame:
    return E.calibrate_f1(t.cumulative).select("threshold", _round("f1"))


@query
def calibrate_fpr(t: Tables) -> DataFrame:
    return E.calibrate_fpr(t.cumulative).select("fpr_limit", "n_human", "threshold", _round("fpr"))
