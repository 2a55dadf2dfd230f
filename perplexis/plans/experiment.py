"""The evaluation job: paired samples in, metrics, curve and record out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.functions import naming
from perplexis.functions.decision import THRESHOLDS, binary_prediction
from perplexis.operators.evaluation import (
    calibrate_f1, calibrate_fpr, cumulative_counts, evaluation_metrics, roc_curve_thin,
)
from perplexis.plans.scoring import Scorer
from perplexis.sources.files import read_samples, write_evaluation, write_record
from perplexis.sources.workspace import cleared, stored

# Scores are compared at this many digits, so that equal texts tie.
DIGITS = 12
# Ways to take the threshold from the experiment's own scores.
CALIBRATIONS = {"f1": calibrate_f1, "fpr": calibrate_fpr}


def pair_rows(samples: DataFrame, human: str, machine: str) -> DataFrame:
    """``row_id, class, text``: both texts of every sample, out of one scan.

    The rows are stored at once, so that the numbers given to them stay.
    """
    texts = F.array(
        F.struct(F.lit(0).alias("class"), F.col(human).alias("text")),
        F.struct(F.lit(1).alias("class"), F.col(machine).alias("text")),
    )
    numbered = samples.select(F.monotonically_increasing_id().alias("row_id"), F.inline(texts))
    return stored(numbered, "samples")


def run_experiment(scorer: Scorer, dataset_path: str, human_key: str, machine_key: str | None = None,
                   dataset_name: str | None = None, machine_source: str | None = None,
                   job_name: str | None = None, results: str = "results",
                   threshold: float | None = None, calibrate: str | None = None) -> DataFrame:
    """Scores both texts of each sample and writes ``results/<job name>/``.

    Predictions use the given threshold, or one that ``calibrate`` ("f1" or
    "fpr") finds on these scores, or the scorer's calibrated one, or else the
    shipped one for accuracy. Returns the one-row record: arguments, times,
    threshold, metrics and metric text.
    """
    if calibrate is not None and (threshold is not None or calibrate not in CALIBRATIONS):
        raise ValueError(f"Give a threshold or one way to calibrate it: {sorted(CALIBRATIONS)}.")
    spark = scorer.spark
    start = datetime.now()
    samples = read_samples(spark, dataset_path)
    # The schema is inferred once.
    samples = read_samples(spark, dataset_path, samples.schema)
    machine_key = naming.sample_column(samples.columns, machine_key)
    path, key = F.lit(dataset_path), F.lit(machine_key)
    name = F.lit(dataset_name) if dataset_name else naming.dataset_name(path)
    source = F.lit(machine_source) if machine_source else naming.source_name(key)
    given = F.lit(job_name) if job_name else None
    tokens = scorer.max_tokens or 0
    names = spark.range(1).select(
        name.alias("dataset_name"), source.alias("machine_text_source"),
        naming.job_name(name, source, tokens, given).alias("job_name"),
    ).first()

    folder = f"{results}/{names.job_name}"
    with cleared(spark):
        scored = scorer.score(pair_rows(samples, human_key, machine_key), ["row_id", "class"])
        scores = stored(scored.select(F.round("score", DIGITS).alias("score"), "class"), "scores")
        cumulative = cumulative_counts(scores)
        if calibrate is not None:
            threshold = CALIBRATIONS[calibrate](cumulative).first().threshold
        if threshold is None:
            threshold = THRESHOLDS["accuracy"] if scorer.calibrated is None else scorer.calibrated
        table = scores.withColumn("pred", binary_prediction(F.col("score"), threshold))
        write_evaluation(table, f"{folder}/scores")
        roc_curve_thin(cumulative).write.parquet(f"{folder}/roc")
        record = evaluation_metrics(table, cumulative).select(
            F.lit(dataset_path).alias("dataset_path"),
            F.lit(names.dataset_name).alias("dataset_name"),
            F.lit(human_key).alias("human_sample_key"),
            F.lit(machine_key).alias("machine_sample_key"),
            F.lit(names.machine_text_source).alias("machine_text_source"),
            F.lit(tokens).alias("tokens_seen"),
            F.lit(threshold).cast("double").alias("threshold"),
            F.lit(calibrate).alias("calibrated_by"),
            F.lit(names.job_name).alias("job_name"),
            F.lit(folder).alias("experiment_path"),
            naming.record_time(F.lit(start)).alias("start_time"),
            naming.record_time(F.lit(datetime.now())).alias("end_time"),
            "n", "n_missing", "f1", "auc", "tpr_at_fpr",
            naming.metric_text(F.col("auc"), F.col("f1"), F.col("tpr_at_fpr")).alias("summary"),
        )
        write_record(record, f"{folder}/record")
    return spark.read.json(f"{folder}/record")
