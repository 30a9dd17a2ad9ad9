"""Stream sources and sinks.

Production reads topics through Spark's Kafka source; the connector jar is an
optional deployment dependency, so the two Kafka functions are thin and
everything downstream only needs the decoded message columns
``topic, partition, offset, key, value``.  Tests and replays use a parquet
directory of message files, which yields the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.schemas import MESSAGE

MESSAGE_COLUMNS = ["topic", "partition", "offset", "key", "value"]


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest", min_partitions: int | None = None,
                 group_id: str | None = None) -> DataFrame:
    """Subscribe to ``topic``.  Progress lives in the query checkpoint;
    ``starting_offsets`` (``latest``, ``earliest`` or the per-partition JSON from
    ``offsets.kafka_starting_offsets``) applies only to a fresh checkpoint.
    ``group_id`` names the consumer group (S2)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))  # failOnDataLoss stays true: never skip lost offsets
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return r.load().select("topic", "partition", "offset",
                           F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"))


def kafka_sink(df: DataFrame, bootstrap: str, checkpoint: str, trigger: dict):
    """K4-K6: ``df`` has ``topic, key, value`` (key may be null); each row goes
    to the topic named in its own ``topic`` column."""
    return (df.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
              .writeStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("checkpointLocation", checkpoint)
              .trigger(**trigger).start())


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Messages from a directory of parquet files, oldest file first."""
    return (spark.readStream.schema(MESSAGE)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path).select(*MESSAGE_COLUMNS))


def console_sink(df: DataFrame, checkpoint: str, trigger: dict, num_rows: int = 1000):
    """Print up to ``num_rows`` rows of every micro-batch (debugging)."""
    return (df.writeStream.format("console").option("numRows", num_rows).option("truncate", "false")
              .option("checkpointLocation", checkpoint)
              .trigger(**trigger).start())


def kafka_batch_writer(bootstrap: str):
    """A ``foreachBatch``-side writer: ``write(df)`` sends rows with
    ``topic, key, value`` as one batch write (K4-K6 inside a batch body)."""
    def write(df: DataFrame) -> None:
        (df.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
           .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save())
    return write
