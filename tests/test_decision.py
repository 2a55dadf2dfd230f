import math

import pytest
from pyspark.sql import functions as F

from perplexis.functions import decision as D
from perplexis.functions import naming as N


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_modes(spark):
    assert D.threshold_of("low-fpr") == 0.8536432310785527
    assert D.threshold_of("accuracy") == 0.9015310749276843
    with pytest.raises(ValueError, match="There is no mode 'other'"):
        D.threshold_of("other")
    modes = spark.createDataFrame([("low-fpr",), ("accuracy",)], "m string")
    got = [tuple(r) for r in modes.select(D.mode_threshold(F.col("m")), D.mode_display_name(F.col("m"))).collect()]
    assert got == [(0.8536432310785527, "Low False Positive Rate"), (0.9015310749276843, "High Accuracy")]
    assert one(spark, D.mode_of_display_name(F.lit("High Accuracy")).alias("m")).m == "accuracy"
    with pytest.raises(Exception, match="There is no mode x"):
        one(spark, D.mode_threshold(F.concat(F.lit("x"))).alias("m"))


def test_labels_are_strict_and_missing_is_human(spark):
    rows = spark.createDataFrame([(0.8,), (0.9,), (1.0,), (math.nan,), (None,)], "s double")
    got = rows.select(
        D.label(F.col("s"), 0.9).alias("l"), D.binary_prediction(F.col("s"), 0.9).alias("p"),
        D.is_missing("s").alias("m"),
    ).collect()
    assert [r.l for r in got] == [D.MACHINE_LABEL] + [D.HUMAN_LABEL] * 4
    assert [r.p for r in got] == [1, 0, 0, 0, 0]
    assert [r.m for r in got] == [False, False, False, True, True]


def test_gate(spark):
    rows = spark.createDataFrame([("a " * 63, 0.1), ("a " * 64, 0.1), ("", 0.1)], "t string, s double")
    got = [r.l for r in rows.select(D.gated_label("t", F.col("s"), 0.9).alias("l")).collect()]
    assert got == ["", D.MACHINE_LABEL, ""]


def test_names(spark):
    key = F.lit("gpt-neo_generated_text_wo_prompt")
    llama = F.lit("meta-llama-Llama-2-13b-hf_generated_text_wo_prompt")
    path = F.lit("sets/core/cnn/cnn-llama.jsonl")
    r = one(
        spark,
        N.output_name(F.lit("essay.parquet")).alias("out"),
        N.is_output_name(F.lit("essay_scored.parquet")).alias("is_out"),
        N.is_output_name(F.lit("essay.parquet")).alias("is_not"),
        N.dataset_name(path).alias("dataset"),
        N.dataset_name(F.lit("a/b/c//")).alias("slash"),
        N.source_name(key).alias("source"),
        N.source_name_exact(key).alias("exact"),
        N.source_name(llama).alias("llama"),
        N.job_name(F.lit(" CC News"), F.lit("A B"), 512).alias("job"),
        N.job_name(F.lit("x"), F.lit("y"), 512, F.lit("given one")).alias("given"),
        N.job_name(F.lit("x"), F.lit("y"), 512, F.lit("")).alias("empty"),
        N.metric_text(F.lit(0.98765), F.lit(0.5), F.lit(0.123456)).alias("text"),
        N.record_time(F.to_timestamp(F.lit("2024-03-05 15:07:09"))).alias("time"),
    )
    assert r.out == "essay_scored.parquet" and r.is_out and not r.is_not
    assert r.dataset == "cnn" and r.slash == "b"
    assert r.source == "gpt-" and r.exact == "gpt-neo"
    assert r.llama == "meta-llama-Llama-2-13b-hf".rstrip("_generated_text_wo_prompt")
    assert r.job == "CC-News-A-B-512-tokens" and r.given == "given one" and r.empty == "x-y-512-tokens"
    assert r.text == "ROC AUC: 0.9877\nF1 Score: 0.50\nTPR at 0.01% FPR:12.35%"
    assert r.time == "03:07PM on March 05, 2024"


def test_sample_column():
    columns = ["text", "a_generated_text", "b_generated_text_wo_prompt", "id"]
    assert N.sample_column(columns) == "b_generated_text_wo_prompt"
    assert N.sample_column(columns, "text") == "text"
    with pytest.raises(IndexError):
        N.sample_column(["text"])
