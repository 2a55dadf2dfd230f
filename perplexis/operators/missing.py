"""Scores and the texts they belong to: attaching, finding gaps, filling them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perplexis.functions.decision import is_missing
from perplexis.functions.text import is_scoreable
from perplexis.operators.running import ROWS_PER_RANGE

PREVIEW_ROWS = 20


def require_columns(df: DataFrame, *columns: str) -> None:
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"There is no column {column!r} among {df.columns}.")


def require_score_column(df: DataFrame, score: str = "score") -> None:
    if score not in df.columns:
        raise ValueError(f"There is no column {score!r} yet; scoring the texts adds it.")


def attach_scores(texts: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``texts`` with ``score``, NaN where there is none; an earlier score goes."""
    found = scores.select(*keys, "score")
    return texts.drop("score").join(found, list(keys), "left").withColumn(
        "score", F.coalesce("score", F.lit(float("nan")))
    )


def find_missing(scored: DataFrame, text: str = "text") -> DataFrame:
    """Rows without a score, with ``scoreable`` false for blank texts."""
    require_score_column(scored)
    require_columns(scored, text)
    return scored.where(is_missing("score")).withColumn("scoreable", is_scoreable(text))


def backfill_scores(scored: DataFrame, new_scores: DataFrame, keys: Sequence[str],
                    text: str = "text") -> DataFrame:
    """New scores on the rows that lack one and are scoreable, all else untouched."""
    fresh = new_scores.select(*keys, F.col("score").alias("_new"))
    fill = is_missing("score") & is_scoreable(text) & F.col("_new").isNotNull()
    return (
        scored.join(fresh, list(keys), "left")
        .withColumn("score", F.when(fill, F.col("_new")).otherwise(F.col("score")))
        .drop("_new")
    )


def limit_per_file(df: DataFrame, limit: int, order: Sequence[str], file: str = "file") -> DataFrame:
    """The first ``limit`` rows of each file in key order; 0 keeps all rows.

    Rows are ranked in pieces of a file first, by their keys alone, so that no
    task sees more of a file than a piece or the first rows of each. ``file`` and
    ``order`` together are unique and never null.
    """
    if limit == 0:
        return df
    keys = [file, *order]
    pieces = max(1, -(-df.count() // ROWS_PER_RANGE))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = df.select(*keys)
    if pieces > 1:
        dealt = first.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(pieces)))
        first = dealt.withColumn("_rank", rank(file, "_piece")).where(F.col("_rank") <= limit).select(*keys)
    first = first.withColumn("_rank", rank(file)).where(F.col("_rank") <= limit).select(*keys)
    return df.join(first, keys, "left_semi").select(*df.columns)


def score_counts(scored: DataFrame, file: str = "file") -> DataFrame:
    """``file, n_good, n_null`` per file."""
    return scored.groupBy(file).agg(
        F.count_if(~is_missing("score")).alias("n_good"),
        F.count_if(is_missing("score")).alias("n_null"),
    )


def _with_total(per_file: DataFrame, file: str, *counts: str) -> DataFrame:
    """A table of one row per file and, with ``is_total`` 1, their sums: the rows themselves are read once."""
    rows = per_file.select(file, F.lit(0).alias("is_total"), *counts)
    totals = per_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    nothing = F.lit(None).cast(per_file.schema[file].dataType).alias(file)
    return rows.unionByName(totals.select(nothing, F.lit(1).alias("is_total"), *counts))


def score_summary(scored: DataFrame, file: str = "file") -> DataFrame:
    """Counts per file and, with ``is_total`` 1, over all files."""
    per_file = scored.groupBy(file).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~is_missing("score")).alias("n_good"),
        F.count_if(is_missing("score")).alias("n_null"),
    ).withColumn("n_files", F.col(file).isNotNull().cast("long"))
    return _with_total(per_file, file, "n_files", "n_rows", "n_good", "n_null")


def missing_report(scored: DataFrame, text: str = "text", file: str = "file") -> DataFrame:
    """Missing scoreable and blank rows per file and in total; full files are left out."""
    per_file = find_missing(scored, text).groupBy(file).agg(
        F.count_if("scoreable").alias("n_scoreable"), F.count_if(~F.col("scoreable")).alias("n_blank")
    )
    return _with_total(per_file, file, "n_scoreable", "n_blank").where("n_scoreable + n_blank > 0")


def missing_preview(scored: DataFrame, row_id: str, text: str = "text", file: str = "file",
                    rows: int = PREVIEW_ROWS) -> DataFrame:
    """``file, scoreable, preview``: the first ids, and how many more there are."""
    gaps = find_missing(scored, text).select(file, "scoreable", row_id)
    counts = gaps.groupBy(file, "scoreable").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(file, "scoreable").orderBy(row_id))
    first = (
        gaps.withColumn("rank", rank).where(F.col("rank") <= rows)
        .groupBy(file, "scoreable")
        .agg(F.array_sort(F.collect_list(row_id)).alias("ids"))
    )
    # Fixed wording of the report.
    more = F.when(F.col("n") > rows, F.format_string(", ... (+%d more)", F.col("n") - rows)).otherwise("")
    return first.join(counts, [file, "scoreable"]).select(
        file, "scoreable", F.concat(F.array_join(F.col("ids").cast("array<string>"), ", "), more).alias("preview")
    )


def scoreable_status(texts: DataFrame, text: str = "text", file: str = "file") -> DataFrame:
    """``file, n_rows, n_skipped, status`` before anything is scored."""
    require_columns(texts, text)
    return texts.groupBy(file).agg(
        F.count("*").alias("n_rows"), F.count_if(~is_scoreable(text)).alias("n_skipped")
    ).withColumn("status", F.when(F.col("n_skipped") > 0, "skipping blank rows").otherwise("good"))
