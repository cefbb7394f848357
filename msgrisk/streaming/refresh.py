"""Score a stream with models that may be replaced while it runs.

A published version is a folder of risk and rule tables, made visible by a row in the list of versions, which is
written last. Every micro-batch is scored as a table, with the newest version at its first attempt: the choice is
written down under the batch's id before any row is scored, so a batch that is run again, after a lost driver or
executor, uses the same tables and overwrites its own folder. Rules may be many, since a batch takes the join of
rule_hits instead of its row-by-row form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from msgrisk.plans.scoring import score_messages


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table that may not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_version(spark: SparkSession, models: str) -> int | None:
    return _rows(spark, f"{models}/versions", "version bigint").agg(F.max("version")).first()[0]


def publish(spark: SparkSession, models: str, risks: DataFrame, rules: DataFrame) -> int:
    """Store risks and rules as the next version and return its number. One publisher at a time.

    A version whose tables were written but not listed is overwritten by the next call.
    """
    version = (latest_version(spark, models) or 0) + 1
    risks.write.mode("overwrite").parquet(f"{models}/v{version}/risks")
    rules.write.mode("overwrite").parquet(f"{models}/v{version}/rules")
    listed = spark.createDataFrame([(version,)], "version bigint")
    listed.coalesce(1).write.mode("append").parquet(f"{models}/versions")
    return version


def version_of_batch(spark: SparkSession, models: str, path: str, batch: int) -> int:
    """The version noted for a batch, else the newest one, which is noted."""
    note = f"{path}/batches/batch={batch}"
    noted = _rows(spark, note, "version bigint").first()
    if noted:
        return noted.version
    version = latest_version(spark, models)
    if version is None:
        raise ValueError(f"no version published below {models}")
    spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("overwrite").parquet(note)
    return version


def score_batch(rows: DataFrame, models: str, path: str, batch: int, columns: Callable[[DataFrame], DataFrame] | None = None, key: str = "msg_id") -> None:
    """Write the scored rows of one batch and their model_version, over whatever an earlier attempt left."""
    spark = rows.sparkSession
    version = version_of_batch(spark, models, path, batch)
    risks, rules = (spark.read.parquet(f"{models}/v{version}/{part}") for part in ("risks", "rules"))
    scored = score_messages(rows, risks, rules, key)
    shown = (columns(scored) if columns else scored).withColumn("model_version", F.lit(version).cast("bigint"))
    shown.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")


def score_arrivals(
    stream: DataFrame, models: str, path: str, checkpoint: str, columns: Callable[[DataFrame], DataFrame] | None = None, key: str = "msg_id"
) -> StreamingQuery:
    """Score all that has arrived, a micro-batch at a time, and stop.

    stream has clean_text, fraud_probability and cluster_id; columns picks what is stored of the scored rows.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: score_batch(rows, models, path, batch, columns, key)).start()
    )


def scored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All batches, with the number of each."""
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
