"""Raw event streams: directories of files, or a broker where its connector is on the class path."""

from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.schema import struct

#: What every source gives: key, value, when the producer wrote it, and the order of arrival.
RAW = struct("key string, value string, produced_at timestamp, offset long")


def from_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A stream over JSON lines of RAW rows, oldest files first."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_batch).json(path)


def from_broker(spark: SparkSession, servers: str, topic: str, offsets_per_batch: int = 100_000, fetch_bytes: int = 1, fetch_millis: int = 500, wait: str | None = None, **options: str) -> DataFrame:
    """A stream from the first offset of a topic. Each query that reads it is a group of its own, with
    its own least size of a fetch and longest wait for one. With wait (such as "25ms") a batch is closed by
    offsets_per_batch rows or by that time, whichever comes first; batches.from_folder does so without a broker."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("kafka.fetch.min.bytes", fetch_bytes).option("kafka.fetch.max.wait.ms", fetch_millis)
    reader = reader.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", offsets_per_batch).options(**options)
    if wait:
        reader = reader.option("minOffsetsPerTrigger", offsets_per_batch).option("maxTriggerDelay", wait)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp AS produced_at", "offset")


def to_broker(messages: DataFrame, servers: str, topic: str, acks: str = "all") -> None:
    """Append key, value rows to a topic; rows of one key keep to one partition."""
    messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", acks).option("kafka.compression.type", "snappy").save()


def rate(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """A capped stream of numbers, to drive generators."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
