"""Streaming record frames over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.values import cents
from keyflow.session import ship_package
from keyflow.sources.records import to_records
from keyflow.sources.stream import read_table_stream


def event_record_stream(spark: SparkSession, sf_dir: str, key: str = "event_type",
                        value: Column | None = None, extra: dict[str, Column] | None = None,
                        max_files_per_trigger: int | None = None,
                        path: str | None = None) -> DataFrame:
    """``events`` as a record stream (TIMESTAMP ``ts`` usable for watermarks).

    ``path`` reads a folder of event files instead (e.g. a landing zone).
    """
    ship_package(spark)
    if path is None:
        raw = read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    else:
        schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        raw = reader.parquet(path)
    v = cents("value") if value is None else value
    return to_records(raw, key=F.col(key), value=v, time_col="ts", seq="event_id", extra=extra)
