"""Batch and stream sources with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstream import schemas


# A first start reads a whole backlog; stateful operators hold one key's rows of a batch.
RECORDS_PER_BATCH = 2_000_000
FILES_PER_BATCH = 200


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Historical trips with header; the schema is fixed, so no inference pass."""
    return spark.read.schema(schemas.TRIP_RAW).option("header", True).option("quote", '"') \
        .option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet table; partition columns are discovered from the folder names."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_event_archive(spark: SparkSession, path: str, schema: T.StructType | str,
                       topic: str | None = None) -> DataFrame:
    """JSON event archive below time folders, e.g. ``topic=/year=/month=/day=/hour=``."""
    reader = spark.read.schema(schema)
    if topic is None:
        return reader.option("recursiveFileLookup", True).json(path)
    # Giving the leaf folder as path with the archive as basePath prunes other topics.
    return reader.option("basePath", path).json(f"{path}/topic={topic}")


def read_event_text(spark: SparkSession, path: str) -> DataFrame:
    """Archived events as raw JSON lines (column ``value``) for the tolerant parsers."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def stream_events(spark: SparkSession, fmt: str, options: dict[str, str],
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Unbounded source that starts at the earliest record, in batches of limited size.

    ``kafka`` yields the record value as text in column ``value``; file formats
    yield their own columns (``text`` also yields ``value``). Timestamps without
    a zone become TIMESTAMP, as watermarks require.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": str(RECORDS_PER_BATCH), **options}
        return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    if schema is not None:
        reader = reader.schema(schema)
    options = {"maxFilesPerTrigger": str(FILES_PER_BATCH), **options}
    return with_zoned_times(reader.options(**options).load())


def with_zoned_times(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP_NTZ columns to TIMESTAMP."""
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
             if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(casts) if casts else df
