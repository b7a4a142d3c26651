"""Message encoding and message streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEO_TOPIC = "nasa_neo_raw"
SATCAT_TOPIC = "celestrak_satcat_raw"


def encode(df: DataFrame, key: Column, *columns: str) -> DataFrame:
    """Key and JSON value per row. NULL members are written, as the consumers expect all fields."""
    body = F.struct(*(columns or df.columns))
    return df.select(
        key.cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def encode_approaches(approaches: DataFrame) -> DataFrame:
    """Messages of the approach stream, keyed by object.

    The nested JSON texts of a row become nested objects of the message.
    """
    nested = {
        c: F.try_parse_json(c)
        for c in ("estimated_diameter", "relative_velocity", "miss_distance", "raw_neo")
        if c in approaches.columns
    }
    return encode(approaches.withColumns(nested), F.col("neo_id"))


def encode_catalog(records: DataFrame, snapshot_timestamp: Column) -> DataFrame:
    """Messages of the catalog stream, keyed by catalog number."""
    satcat = F.from_json("parsed_record", "MAP<STRING, STRING>")
    envelope = records.select(
        "snapshot_group",
        F.date_format(snapshot_timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(
            "snapshot_timestamp"
        ),
        satcat.alias("satcat"),
    )
    return encode(envelope, F.try_element_at(F.col("satcat"), F.lit("NORAD_CAT_ID")))


def kafka_stream(
    spark: SparkSession, brokers: str, topic: str, max_offsets: int | None = None, **options: str
) -> DataFrame:
    """Kafka topic from its earliest offset. Needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load()


def write_kafka(messages: DataFrame, brokers: str, topic: str, **options: str) -> None:
    """Send encoded messages; the key decides the topic partition."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message files, one JSON value per line, as a stream with a `value` column."""
    reader = spark.readStream.schema("value STRING")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path)
