"""Names of jobs, outputs and sample columns, and formatted metric text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name parts and the time format of run records.
SAMPLE_MARK = "generated_text"
SAMPLE_SUFFIX = "_generated_text_wo_prompt"
RECORD_TIME_FORMAT = "hh:mma 'on' MMMM dd, yyyy"
DEFAULT_OUTPUT_SUFFIX = "_scored"


def output_name(file_name: Column, suffix: str = DEFAULT_OUTPUT_SUFFIX) -> Column:
    """``essay.parquet`` -> ``essay_scored.parquet``."""
    return F.concat(F.regexp_replace(file_name, r"\.parquet$", ""), F.lit(suffix + ".parquet"))


def is_output_name(file_name: Column, suffix: str = DEFAULT_OUTPUT_SUFFIX) -> Column:
    return file_name.endswith(suffix + ".parquet")


def dataset_name(path: Column) -> Column:
    """Name of the folder that holds the file."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -2)


def sample_column(columns: Sequence[str], key: str | None = None) -> str:
    """The given key, else the last column that holds generated text."""
    if key:
        return key
    marked = [c for c in columns if SAMPLE_MARK in c]
    if not marked:
        raise IndexError(f"No column name contains '{SAMPLE_MARK}': {list(columns)}")
    return marked[-1]


def source_name(column_name: Column) -> Column:
    """Strips trailing characters out of the *set* of the suffix's characters.

    This takes more than the suffix when the name itself ends in such
    characters: ``gpt-neo_generated_text_wo_prompt`` -> ``gpt-``.
    """
    return F.rtrim(column_name, F.lit(SAMPLE_SUFFIX))


def source_name_exact(column_name: Column) -> Column:
    """Removes the suffix itself and nothing more."""
    return F.regexp_replace(column_name, f"{SAMPLE_SUFFIX}$", "")


def job_name(name: Column, source: Column, max_tokens: Column | int, given: Column | None = None) -> Column:
    tokens = F.lit(max_tokens) if isinstance(max_tokens, int) else max_tokens
    default = F.replace(
        F.trim(F.format_string("%s-%s-%d-tokens", name, source, tokens)), F.lit(" "), F.lit("-")
    )
    return default if given is None else F.coalesce(F.nullif(given, F.lit("")), default)


def metric_text(auc: Column, f1: Column, tpr: Column) -> Column:
    # Fixed wording of the figure's caption.
    return F.format_string(
        "ROC AUC: %.4f\nF1 Score: %.2f\nTPR at 0.01%% FPR:%.2f%%", auc, f1, tpr * 100
    )


def record_time(timestamp: Column) -> Column:
    return F.date_format(timestamp, RECORD_TIME_FORMAT)
