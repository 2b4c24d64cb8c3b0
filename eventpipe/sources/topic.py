"""Topic records from a broker or from file dumps of a topic, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.schemas import TOPIC

# Defaults of the pipeline.
DEFAULT_TOPIC = "events"
DEFAULT_SERVERS = "kafka:9092"

# What one micro-batch takes at most, so that a backlog is no single batch. Every row is read, but window counts of a
# stream depend on it: the watermark moves between the batches of a longer backlog, so rows of later batches whose event
# time lies more than the lateness behind it are not counted. Backfill.closed_counts counts a backlog whole.
RECORDS_PER_BATCH = 50_000_000
FILES_PER_BATCH = 1_000


def _broker_records(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def stream_topic(
    spark: SparkSession,
    servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_TOPIC,
    max_records_per_batch: int | None = RECORDS_PER_BATCH,
    min_partitions: int | None = None,
) -> DataFrame:
    """The topic as a stream, from its earliest record on.

    A topic with few partitions is read by few tasks; ``min_partitions`` lets
    Spark split offset ranges so that a batch uses the whole cluster.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_records_per_batch)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return _broker_records(reader.load())


def read_topic(
    spark: SparkSession, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC
) -> DataFrame:
    """All that is in the topic now."""
    return _broker_records(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def stream_topic_files(
    spark: SparkSession, path: str, format: str = "parquet", max_files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """Files that drop into a folder, with the columns of a topic record."""
    reader = spark.readStream.schema(TOPIC).format(format)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def write_topic_files(records: DataFrame, path: str, format: str = "parquet") -> None:
    """Append records with the columns of a topic to a folder that the file source reads."""
    records.select(*TOPIC.names).write.mode("append").format(format).save(path)


def read_topic_files(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.schema(TOPIC).format(format).load(path)


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly over the session's shuffle partitions.

    Reading JSON is work for the processor, and one unsplittable file would give
    it all to one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def send(records: DataFrame, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC) -> None:
    """Send ``key``, ``value``. The id as key keeps one id's records in order."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def send_stream(
    records: DataFrame, checkpoint: str, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC
):
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def with_places(
    records: DataFrame, sequence: Column, partitions: int = 1, topic: str = DEFAULT_TOPIC
) -> DataFrame:
    """What a broker adds, for records that go to files: partition by key, and
    ``sequence`` (rising over the records of one key) as offset."""
    return records.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        sequence.cast("bigint").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )
