"""Scoring jobs: literals, tables, and files with or without existing scores."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perplexis.functions.decision import DEFAULT_MODE, is_missing, label, threshold_of
from perplexis.functions.naming import DEFAULT_OUTPUT_SUFFIX
from perplexis.functions.text import is_scoreable
from perplexis.operators.metrics import document_scores
from perplexis.operators.missing import attach_scores, find_missing, missing_report, require_columns
from perplexis.operators.model import Contexts, load_model, train, train_contexts
from perplexis.operators.tokens import tokenize
from perplexis.plans.providers import Provider, TrainedModels
from perplexis.sources import files
from perplexis.sources.files import FILE_KEYS
from perplexis.sources.workspace import cleared, new_path, stored


def score_texts(texts: DataFrame, keys: Sequence[str], models: Contexts | Provider, text: str = "text",
                max_tokens: int | None = None) -> DataFrame:
    """``keys, n_tokens, ppl, x_ppl, score`` of the scoreable texts that have a token.

    ``keys`` tell the texts apart; two texts of the same fail the query. Texts
    are observed whole unless ``max_tokens`` says otherwise.
    """
    require_columns(texts, text)
    models = TrainedModels(models) if isinstance(models, Contexts) else models
    values = models.token_metrics(texts.where(is_scoreable(text)), keys, text, max_tokens)
    return document_scores(values, keys)


@dataclass(frozen=True)
class Written:
    """What a job over files wrote.

    ``summary`` has ``path, output, n_rows, n_good, n_null`` for each input and,
    with ``is_total`` 1, for all of the run; its counts come from the writing.
    """

    spark: SparkSession
    outputs: list[str]
    summary: DataFrame

    @property
    def table(self) -> DataFrame:
        """The written rows, with their ``file`` and ``row_id``."""
        return files.read_texts(self.spark, self.outputs)


@dataclass(frozen=True)
class Scorer:
    """Two models, a token window and a decision mode.

    ``models`` are trained tables (``Contexts``) or any other provider.
    """

    models: Contexts | Provider
    max_tokens: int | None = None
    mode: str = DEFAULT_MODE
    calibrated: float | None = None

    def __post_init__(self):
        threshold_of(self.mode)

    @classmethod
    def train(cls, texts: DataFrame, observer: Column, performer: Column, text: str = "text",
              path: str | None = None, alpha: float = 0.5, lam: float = 0.7, **options) -> Scorer:
        """``observer`` and ``performer`` are conditions that select the corpora."""
        rows = stored(tokenize(
            texts.withColumns({"_observer": observer, "_performer": performer}),
            ["_observer", "_performer"], text,
        ), "tokens")
        model = train(rows, F.col("_observer"), F.col("_performer"), alpha, lam, path)
        return cls(train_contexts(model), **options)

    @classmethod
    def load(cls, spark: SparkSession, path: str, **options) -> Scorer:
        return cls(train_contexts(load_model(spark, path)), **options)

    @property
    def provider(self) -> Provider:
        return TrainedModels(self.models) if isinstance(self.models, Contexts) else self.models

    @property
    def spark(self) -> SparkSession:
        return self.provider.spark

    @property
    def threshold(self) -> float:
        """The mode's shipped value, or one calibrated for these models."""
        return threshold_of(self.mode) if self.calibrated is None else self.calibrated

    def with_mode(self, mode: str) -> Scorer:
        return replace(self, mode=mode, calibrated=None)

    def with_window(self, max_tokens: int | None) -> Scorer:
        """Only the first tokens of a text are observed; ``None``: all."""
        return replace(self, max_tokens=max_tokens)

    def with_threshold(self, threshold: float) -> Scorer:
        return replace(self, calibrated=threshold)

    def score(self, texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
        """All rows of ``texts`` with ``score``, NaN where there is nothing to score."""
        return attach_scores(
            texts, score_texts(texts, keys, self.provider, text, self.max_tokens), keys
        )

    def predict(self, texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
        """``score`` and ``label`` for all rows."""
        return self.score(texts, keys, text).withColumn("label", label(F.col("score"), self.threshold))

    def _literals(self, text: str | list[str], column: str):
        texts = [text] if isinstance(text, str) else text
        table = self.spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
        rows = self.predict(table, ["row_id"]).orderBy("row_id").collect()
        values = [row[column] for row in rows]
        return values[0] if isinstance(text, str) else values

    def score_literal(self, text: str | list[str]) -> float | list[float]:
        """For texts in the program itself: one in, one out; a list in, a list out."""
        return self._literals(text, "score")

    def predict_literal(self, text: str | list[str]) -> str | list[str]:
        return self._literals(text, "label")

    def _file_values(self, texts: DataFrame, text: str) -> DataFrame:
        """``file, row_id, value`` of the texts that get a score, stored."""
        scores = score_texts(texts, FILE_KEYS, self.provider, text, self.max_tokens)
        return stored(scores.select(*FILE_KEYS, F.col("score").alias("value")).where(~is_missing("value")), "file_scores")

    def score_files(self, inputs: Sequence[str], output: str | None = None, text: str = "text", limit: int = 0,
                    suffix: str = DEFAULT_OUTPUT_SUFFIX, again: bool = False) -> Written:
        """Scores Parquet files, each into a file of its own name and ``suffix``.

        Outputs lie beside their inputs, or all in the folder ``output``. A run
        that was interrupted as it put them in place is finished first. A ledger
        there remembers which files were scored, by path, length and time, with
        which text column, limit and window: those are passed over unless ``again``,
        which a scorer with other models asks for.
        """
        home = output or _home(inputs)
        files.finish_interrupted(self.spark, home)
        listed = files.inputs_of(self.spark, inputs, suffix=suffix, output=output)
        if not listed:
            raise ValueError("The inputs hold no Parquet file to score.")
        options = f"text={text}, limit={limit}, max_tokens={self.max_tokens}"
        table = self._table_of(listed, options)
        if not again:
            known = files.scored_before(self.spark, home).select(*table.columns)
            fresh = {r.path for r in table.join(known, table.columns, "left_anti").select("path").toLocalIterator()}
            listed = [f for f in listed if f.path in fresh]
        counts = None
        if listed:
            with cleared(self.spark):
                counts = self._score_listed(listed, home, text, limit)
            files.enter_in_ledger(self._table_of(listed, options).join(counts[0], "path"), home)
        return Written(self.spark, [f.output for f in listed], self._summary(counts))

    def _table_of(self, listed: list[files.Input], options: str) -> DataFrame:
        table = self.spark.createDataFrame(listed, "path string, length long, modified timestamp, output string")
        return table.withColumn("options", F.lit(options))

    def _score_listed(self, listed: list[files.Input], home: str, text: str, limit: int) -> tuple[DataFrame, files.Staged]:
        paths = [f.path for f in listed]
        texts = files.read_texts(self.spark, paths, limit)
        require_columns(texts, text)
        values = self._file_values(texts, text)
        good = values.groupBy(F.col("file").alias("path")).agg(F.count("*").alias("n_good"))
        # A file without any score may lack the column that others have.
        scored = {r.path for r in good.select("path").toLocalIterator()}
        odd = files.files_without_column(self.spark, text, [p for p in paths if p not in scored])
        if odd:
            raise ValueError(f"There is no column {text!r} in {odd[0]}, nor in {len(odd) - 1} other files.")

        def scored_rows(rows: DataFrame) -> DataFrame:
            return rows.drop("score").withColumn("score", F.coalesce("_value", F.lit(float("nan")))).drop("_value")

        staged = files.stage(self.spark, home, listed, values, scored_rows, limit)
        files.put_in_place(self.spark, home, staged)
        rows = files.count_rows(self.spark, paths).withColumnRenamed("file", "path")
        rows = rows.withColumn("n_rows", F.least("n_rows", F.lit(limit)) if limit else F.col("n_rows"))
        known = self.spark.createDataFrame([(p,) for p in paths], "path string")
        counts = known.join(rows, "path", "left").join(good, "path", "left").na.fill(0, ["n_rows", "n_good"])
        counts = counts.withColumn("n_null", F.col("n_rows") - F.col("n_good"))
        return stored(counts, "counts", new_path(self.spark, "counts")), staged

    def _summary(self, counts: tuple[DataFrame, files.Staged] | None) -> DataFrame:
        shape = "path string, is_total int, n_files long, n_rows long, n_good long, n_null long"
        if counts is None:
            return self.spark.createDataFrame([(None, 1, 0, 0, 0, 0)], shape)
        table, staged = counts
        total = self.spark.createDataFrame(
            [(None, 1, len(staged.moves), staged.n_rows, staged.n_good, staged.n_rows - staged.n_good)], shape
        )
        return table.select(
            "path", F.lit(0).alias("is_total"), F.lit(1).cast("long").alias("n_files"), "n_rows", "n_good", "n_null"
        ).unionByName(total)

    def score_missing(self, folder: str, text: str = "text", dry_run: bool = False) -> DataFrame:
        """Fills the gaps of a folder of scored files in place; returns the report of gaps.

        Only texts that lack a score are scored, and only files that receive one
        are written again: complete copies first, then they are put in place, which
        the next start finishes if it is interrupted. A dry run changes nothing.
        """
        home = _home([folder])
        if not dry_run:
            files.finish_interrupted(self.spark, home)
        listed = files.inputs_of(self.spark, [folder], include_outputs=True)
        if not listed:
            raise ValueError("The folder holds no Parquet file.")
        scored = files.read_texts(self.spark, [f.path for f in listed])
        gaps = find_missing(scored, text)
        report = stored(missing_report(scored, text), "missing_report", new_path(self.spark, "missing_report"))
        if not dry_run and not report.where("n_scoreable > 0").isEmpty():
            with cleared(self.spark):
                self._fill(gaps, listed, home, text)
        return report

    def _fill(self, gaps: DataFrame, listed: list[files.Input], home: str, text: str) -> None:
        values = self._file_values(gaps.where("scoreable"), text)
        touched = {r.file for r in values.select("file").distinct().toLocalIterator()}

        def filled(rows: DataFrame) -> DataFrame:
            fill = is_missing("score") & F.col("_value").isNotNull()
            return rows.withColumn("score", F.when(fill, F.col("_value")).otherwise(F.col("score"))).drop("_value")

        again = [f._replace(output=f.path) for f in listed if f.path in touched]
        if again:
            files.put_in_place(self.spark, home, files.stage(self.spark, home, again, values, filled))


def _home(inputs: Sequence[str]) -> str:
    """The folder in which a job keeps its journal and ledger: the first given, or that of the first file."""
    first = inputs[0].rstrip("/")
    return posixpath.dirname(first) if first.endswith(".parquet") else first
