"""Times the headline queries; prints one JSON line.

The shared tables are built inside the first query that needs them, and the two
largest builds are listed on their own: ``tokenize`` (token table) and ``train``
(both models with the cross-entropy of every context). One untimed pass over
the smallest data warms the JVM up.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from perplexis.plans.registry import QUERIES, tables
from perplexis.session import configured

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")
HEADLINE = [
    "doc_scores", "doc_scores_window", "ppl_median", "x_ppl_median", "x_ppl_temperature",
    "self_entropy_scores", "x_ppl_sampled", "token_nll", "next_token_pairs", "lm_bigram",
    "vocab_diff", "pad_mask", "predict_label", "gated_predict", "backfill_scores",
    "backfill_write", "missing_report", "missing_preview", "score_summary", "roc_curve",
    "roc_curve_thin", "roc_log_grid", "eval_metrics", "calibrate_f1", "calibrate_fpr",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark: SparkSession, folder: str) -> dict[str, float]:
    seconds = {}

    def timed(name, step):
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)

    shared = tables(spark, folder)
    timed("tokenize", lambda: shared.toks)
    timed("train", lambda: shared.contexts)
    for name in HEADLINE:
        timed(name, lambda: consume(QUERIES[name](spark, folder)))
    return seconds


def main() -> None:
    spark = (
        configured(SparkSession.builder.master(f"local[{CPUS}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM_UP):
        run(spark, WARM_UP)
    seconds = run(spark, FOLDER)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
