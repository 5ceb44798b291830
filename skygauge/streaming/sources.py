"""Unbounded inputs."""

from pyspark.sql import DataFrame, SparkSession


def topic_stream(spark: SparkSession, servers: str, topic: str, starting="earliest", max_per_trigger: int | None = None, min_per_trigger=None, max_delay="10s") -> DataFrame:
    """Topic rows (key, value, partition, offset, timestamp), from the first message on.

    ``max_per_trigger`` bounds a batch; nothing is skipped, the rest waits for the next.

    With ``min_per_trigger`` a batch also waits until that many rows or ``max_delay`` have come,
    i.e. batches by size or elapsed time. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    if min_per_trigger:
        reader = reader.option("minOffsetsPerTrigger", min_per_trigger).option("maxTriggerDelay", max_delay)
    return reader.load()


def topic_rows(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything in the topic now, as a bounded read. Prefer a stream with the ``once`` trigger,
    which remembers how far it got."""
    return (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    )


def file_stream(spark: SparkSession, schema, path: str, fmt="parquet", max_files: int | None = None) -> DataFrame:
    """Files as they appear in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
