"""Column expressions that turn scores into labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perplexis.functions.text import MINIMUM_TOKENS, token_count

# Decision thresholds per mode, their display names, the labels.
THRESHOLDS = {"low-fpr": 0.8536432310785527, "accuracy": 0.9015310749276843}
DISPLAY_NAMES = {"low-fpr": "Low False Positive Rate", "accuracy": "High Accuracy"}
DEFAULT_MODE = "low-fpr"
MACHINE_LABEL = "Most likely AI-generated"
HUMAN_LABEL = "Most likely human-generated"


def threshold_of(mode: str) -> float:
    if mode not in THRESHOLDS:
        raise ValueError(f"There is no mode {mode!r}; known are {sorted(THRESHOLDS)}.")
    return THRESHOLDS[mode]


def _by_mode(mode: Column, values: dict) -> Column:
    chosen = F.lit(None)
    for name, value in values.items():
        chosen = F.when(mode == name, F.lit(value)).otherwise(chosen)
    return F.when(mode.isin(*values), chosen).otherwise(
        F.raise_error(F.concat(F.lit("There is no mode "), mode))
    )


def mode_threshold(mode: Column) -> Column:
    """Threshold of a column of mode names; an unknown name fails the query."""
    return _by_mode(mode, THRESHOLDS)


def mode_display_name(mode: Column) -> Column:
    return _by_mode(mode, DISPLAY_NAMES)


def mode_of_display_name(name: Column) -> Column:
    return _by_mode(name, {shown: mode for mode, shown in DISPLAY_NAMES.items()})


def is_missing(score: str | Column) -> Column:
    """A score is missing when it is null or NaN."""
    col = F.col(score) if isinstance(score, str) else score
    return col.isNull() | F.isnan(col)


def is_machine(score: Column, threshold: float | Column) -> Column:
    """Strictly below the threshold. Missing scores are not."""
    return F.coalesce(score < threshold, F.lit(False))


def label(score: Column, threshold: float | Column) -> Column:
    return F.when(is_machine(score, threshold), MACHINE_LABEL).otherwise(HUMAN_LABEL)


def binary_prediction(score: Column, threshold: float | Column) -> Column:
    return F.when(is_machine(score, threshold), 1).otherwise(0)


def is_too_short(text: str | Column, minimum: int = MINIMUM_TOKENS) -> Column:
    return token_count(text) < minimum


def gated_label(text: str | Column, score: Column, threshold: float | Column,
                minimum: int = MINIMUM_TOKENS) -> Column:
    """The label, or the empty string for a text with too few tokens."""
    return F.when(is_too_short(text, minimum), "").otherwise(label(score, threshold))
