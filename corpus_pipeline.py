"""A training corpus from raw documents, in stages of one operator each.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table: the columns of
``documents`` for all but the last. ``run`` writes every stage's result to the
shared workspace and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perplexis.llm import debruijn, jaccard, mixing, packing, quality
from perplexis.sources.workspace import cleared, new_path, stored


def as_rows(docs: DataFrame) -> DataFrame:
    """``row, id, text``: whole rows as one column, so that no name of theirs meets another."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), "text")


def as_given(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``as_rows`` with their own columns again."""
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the forests."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, "text", quality.learn(docs, "doc_id", "text", labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, of those with its least ``doc_id``.

    Rows of one ``doc_id`` whose texts don't link are groups of their own and
    all stay; of those without words one stays for each id. Rows without an id,
    which no group can be named after, all stay. Rows meet their groups by id and
    the hashes of their text, and so don't leave Spark.
    """
    found = jaccard.grouped(docs, "doc_id", "text").where(F.col("id") == F.col("component_id"))
    named = found.select("id", "tag", "mark", "group").distinct()
    # The text moves once, within its row.
    rows = as_rows(docs.where("doc_id IS NOT NULL")).select("row", "id", *jaccard.named_text("text"))
    met = rows.join(named, ["id", "tag", "mark"])
    place = F.row_number().over(Window.partitionBy("id", "group").orderBy("tag", F.col("row").getField("text")))
    kept = met.withColumn("place", place).where("place = 1")
    return as_given(kept, docs).unionByName(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in a document of smaller id."""
    return debruijn.remove(docs, "doc_id", "text")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the schedule takes its words, in whole times.

    Rows of one ``doc_id`` are repeated alike; documents without words stay once.
    """
    mixed = mixing.mix(docs, "doc_id", "text", "source")
    taken, size = F.sum("taken"), F.sum("size")
    times = mixed.groupBy(F.col("doc_id").alias("mixed_id")).agg(
        F.when(size == 0, 1).otherwise(F.round(taken / size)).cast("int").alias("times")
    ).where("times > 0")
    repeated = as_rows(docs).join(times, F.col("id").eqNullSafe(F.col("mixed_id")))
    return as_given(repeated.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of equal length."""
    return packing.pack(packing.pieces(docs, "doc_id", "text"), "length")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed),
]

# Forests, graph components and packing have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # What a stage stored on its way goes once its result is written.
        with cleared(spark):
            name = name.replace(" ", "-")
            docs = stored(stage(spark, docs, sf_dir), name, new_path(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
