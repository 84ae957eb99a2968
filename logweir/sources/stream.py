"""The unbounded record source. Production reads a message topic; tests read files; the rest is the same."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.config import IngestConfig

FILE_FORMATS = ("parquet", "json", "csv", "text", "orc", "avro", "xml")


def start_options(starting_offsets: str | None) -> dict[str, str]:
    """``earliest`` / ``latest``, or else an epoch-milliseconds timestamp; None leaves it to the source."""
    if starting_offsets is None:
        return {}
    if starting_offsets in ("earliest", "latest"):
        return {"startingOffsets": starting_offsets}
    return {"startingTimestamp": starting_offsets}


def stream_options(config: IngestConfig) -> dict[str, str]:
    options = {}
    if config.stream_format == "kafka":
        options["kafka.bootstrap.servers"] = config.kafka_broker
        options["subscribe"] = config.topic
        options.update(start_options(config.starting_offsets))
        if config.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
        if config.consumer_group:
            options["kafka.consumer.commit.groupid"] = config.consumer_group
    elif config.stream_format in FILE_FORMATS and config.max_offsets_per_trigger is not None:
        options.update(row_budget(config))
    options.update(config.stream_options)
    return options


def row_budget(config: IngestConfig) -> dict[str, str]:
    """The cap of records per trigger for a source of files, which counts bytes: ``record_bytes`` is a record's size there."""
    if config.record_bytes is not None:
        return {"maxBytesPerTrigger": str(config.max_offsets_per_trigger * config.record_bytes)}
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(config.stream_options):
        warnings.warn("max_offsets_per_trigger has no effect on files without record_bytes", stacklevel=2)
    return {}


def admission(config: IngestConfig) -> Column | None:
    """Which records of a source without offsets lie behind the start position; None for all.

    A position is a time, which is compared with ``record_time``, an expression over the columns of the source, or, for files,
    with the time at which the file was changed last.
    """
    if config.stream_format == "kafka" or config.starting_offsets in (None, "earliest"):
        return None
    if config.starting_offsets == "latest":
        raise ValueError(f"a {config.stream_format!r} source has no latest offset; give a time in epoch milliseconds")
    time = config.record_time
    if time is None and config.stream_format in FILE_FORMATS:
        time = "_metadata.file_modification_time"
    if time is None:
        raise ValueError(f"a start position on a {config.stream_format!r} source needs record_time")
    return F.expr(time) >= F.timestamp_millis(F.lit(int(config.starting_offsets)))


def read_stream(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """The stream as one text column ``value``."""
    reader = spark.readStream.format(config.stream_format).options(**stream_options(config))
    if config.stream_schema:
        reader = reader.schema(config.stream_schema)
    stream = reader.load(config.stream_path) if config.stream_path else reader.load()
    admitted = admission(config)
    return decode(stream if admitted is None else stream.where(admitted))


def decode(df: DataFrame) -> DataFrame:
    """Binary or text payload → text; keys, offsets and the rest are dropped, so they are never fetched."""
    return df.selectExpr("CAST(value AS STRING) AS value")
