"""Scoring and de-duplicating messages as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_messages(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the parquet files that match a folder or pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def dedupe_stream(messages: DataFrame, time: str, delay: str, text: str = "text") -> DataFrame:
    """Keep the first arrival of each text. State is a digest per text, dropped after the delay."""
    return (
        messages.withWatermark(time, delay)
        .withColumn("_digest", F.sha2(text, 256))
        .dropDuplicatesWithinWatermark(["_digest"])
        .drop("_digest")
    )


def write_available(stream: DataFrame, path: str, checkpoint: str, keyed_state: bool = False) -> StreamingQuery:
    """Process what has arrived and stop. The checkpoint makes a restart continue exactly.

    keyed_state starts the query on the RocksDB state store, which arbitrary state needs; the setting of the
    session stays as it was.
    """
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    if not keyed_state:
        return writer.start(path)
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKS_DB)
    try:
        return writer.start(path)
    finally:
        conf.set(STATE_STORE, before) if before else conf.unset(STATE_STORE)
