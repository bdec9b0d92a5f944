"""Stream sources (IO1, IO2, IO5, IO6) and sinks (IO11-IO13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.metrics import duration_ms

# Ingest cap and micro-batch intervals of the two jobs.
MAX_RECORDS_PER_PARTITION_PER_S = 10_000
PREPROCESS_TRIGGER = "3 seconds"
METRICS_TRIGGER = "5 seconds"


def kafka_lines(spark: SparkSession, servers: str, topic: str, *, starting_offsets: str = "latest",
                trigger: str = PREPROCESS_TRIGGER, partitions: int | None = None) -> DataFrame:
    """IO1/IO2/IO5: lines from Kafka (value only). Resume comes from the query's
    ``checkpointLocation``; ``startingOffsets`` applies to a fresh query.

    With the topic's number of ``partitions`` a batch takes at most the rate cap times the
    trigger's length; without it there is no cap, so a wide topic never falls behind."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if partitions:
        seconds = duration_ms(trigger) / 1000
        r = r.option("maxOffsetsPerTrigger", str(int(MAX_RECORDS_PER_PARTITION_PER_S * partitions * seconds)))
    return r.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw lines from text files (tests and replays)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def with_topic(df: DataFrame, behavior_col: str = "behavior_type") -> DataFrame:
    """IO11 routing: Query -> processedQuery, Book -> processedBook, Other nowhere."""
    topic = (F.when(F.col(behavior_col) == "Query", F.lit("processedQuery"))
              .when(F.col(behavior_col) == "Book", F.lit("processedBook")))
    return df.withColumn("topic", topic).filter(F.col("topic").isNotNull())


def write_kafka(df: DataFrame, servers: str, value_col: str = "value") -> None:
    """IO11 batch write to Kafka, one topic per row (``topic`` column)."""
    (df.select("topic", F.col(value_col).alias("value")).write.format("kafka")
       .option("kafka.bootstrap.servers", servers).save())
