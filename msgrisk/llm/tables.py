"""The given tables, and tables written to the shared folder between jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgrisk.session import materialised as stored

__all__ = ["documents", "fold", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds. A null key counts as the empty string."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds
