"""Sinks: keyed record writers (topic folder or Kafka), fan-out of one
micro-batch to several tables, console dumps.

A "topic" written to files keeps the Kafka record layout (binary ``key`` and
``value`` in the wire form of their serdes, ``timestamp``, ``offset``), so the
same decoding reads it back whether it came from a folder or a broker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.sources.codec import KAFKA_ENCODERS


def to_wire(df: DataFrame, key_type: str = "string", value_type: str = "string") -> DataFrame:
    """Record frame → Kafka record columns (a null value stays a tombstone)."""
    cols = [KAFKA_ENCODERS[key_type]("key").alias("key"), KAFKA_ENCODERS[value_type]("value").alias("value")]
    if "ts" in df.columns:
        cols.append(F.col("ts").alias("timestamp"))
    if "seq" in df.columns:
        cols.append(F.col("seq").alias("offset"))
    return df.select(*cols)


def write_topic(df: DataFrame, target: str, key_type: str = "string", value_type: str = "string",
                fmt: str = "parquet", options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch keyed-record writer (producer). ``fmt='kafka'`` needs the Kafka
    connector on the classpath and ``kafka.bootstrap.servers`` in options;
    ``target`` is then the topic."""
    wire = to_wire(df, key_type, value_type)
    if fmt == "kafka":
        (wire.select("key", "value").write.format("kafka").options(**(options or {}))
         .option("topic", target).save())
    else:
        wire.write.mode(mode).format(fmt).options(**(options or {})).save(target)


def fan_out(writers: dict[str, Callable[[DataFrame], DataFrame]], base: str):
    """foreachBatch function writing one micro-batch to several tables.

    The batch is persisted once and each branch is derived from it, so the
    source is read once per epoch however many sinks hang off it. Each
    epoch lands in ``<base>/<name>/batch_id=<id>`` (overwrite): a retried
    epoch replaces its own output.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, derive in writers.items():
                derive(batch).write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def console_dump(df: DataFrame, n: int = 20) -> None:
    """Key/value dump of a topic from the beginning (console consumer)."""
    df.select("key", "value").show(n, truncate=False)
