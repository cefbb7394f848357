"""Corpus pipeline over documents: each stage works on all that the stage before it kept.

toxicity      rows that the grammar scores at its threshold or above go
line_dedup    later copies of repeated line runs are cut out of the texts; rows with no line left go
ngram_join    of rows linked by 5-word shingles at 80 %, the one with the least doc_id stays
decontaminate rows that hold a benchmark item go
mixing        copies of each row that bring every source to its target share
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from msgrisk.llm import decontamination, line_dedup, mixing, ngram_join, toxicity
from msgrisk.llm.queries import toxicity_model
from msgrisk.llm.tables import documents, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts stay."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(model, docs, score_col="toxicity_score").where(F.col("toxicity_score") < toxicity.THRESHOLD).drop("toxicity_score")


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the text where lines were cut. Rows without lines to begin with stay."""
    cut = line_dedup.dedup(docs)
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without words stay, and so do rows without a doc_id."""
    groups = ngram_join.join(docs, n=5, percent=80)
    gone = groups.where((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Repeated rows of the one that stays are copies as well.
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = decontamination.count_leaks(docs, table(spark, sf_dir, "benchmark"), count_col="benchmark_items")
    return counted.where("benchmark_items = 0").drop("benchmark_items")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document with the copies to take of it; rows of 0 copies are left out of the mix but listed."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_join", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table of documents. Each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
