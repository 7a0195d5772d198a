"""Streaming sources with an explicit schema (no inference).

``format`` is a parameter: ``parquet`` (files landing in a folder), ``kafka``
(decoded with ``keyflow.sources.codec``) or anything else Spark can read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import ship_package
from keyflow.sources.codec import KAFKA_DECODERS


def read_table_stream(spark: SparkSession, sf_dir: str, name: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table read as a file stream: one file, or a folder of part files.

    A file stream does not take a single file as its path; a glob that only
    the table's name matches covers both layouts. The schema comes from the
    batch reader.
    """
    ship_package(spark)  # stateful operators downstream run Python on executors
    table = f"{sf_dir.rstrip('/')}/{name}"
    reader = spark.readStream.schema(spark.read.parquet(f"{table}.parquet").schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(f"{table}.parque[t]")


def read_record_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                       schema=None, key_type: str = "string",
                       value_type: str = "string", path: str | None = None) -> DataFrame:
    """Generic typed stream source (topic or folder) as raw key/value/time.

    For ``kafka`` the binary key and value are decoded to ``key_type`` /
    ``value_type`` (8-byte big-endian long, 4-byte int, UTF-8 string) and the
    result is a record frame: the record timestamp becomes ``ms``/``ts``, the
    offset ``seq``, and the topic partition is kept as ``partition``. A topic
    is read from its earliest offset unless ``startingOffsets`` says otherwise
    (Spark's default, latest, would leave out the backlog).
    """
    ship_package(spark)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        raw = reader.load()
        return raw.select(
            KAFKA_DECODERS[key_type]("key").alias("key"),
            KAFKA_DECODERS[value_type]("value").alias("value"),
            F.unix_millis(raw["timestamp"]).alias("ms"),
            raw["timestamp"].alias("ts"),
            raw["offset"].alias("seq"),
            # stream time of the exact late-drop rule is per source partition
            raw["partition"].alias("partition"),
        )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
