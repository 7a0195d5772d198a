"""Record frames: the keyed-event data model on Spark.

A record is ``key, value, ms, ts, seq`` (+ optional extra columns):
  key   — grouping / partitioning key (any type, nullable)
  value — payload; ``null`` is a tombstone in a changelog table
  ms    — event time, BIGINT epoch milliseconds
  ts    — event time as TIMESTAMP (for window/session_window/watermarks)
  seq   — arrival order (offset); totally orders records of one source
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.time import epoch_ms, event_time
from keyflow.functions.values import cents

RECORD_COLUMNS = ["key", "value", "ms", "ts", "seq"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a parquet scan (pruning/pushdown stay with Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def to_records(df: DataFrame, key: Column | str, value: Column | str,
               seq: Column | str, time_col: str = "ts",
               extra: dict[str, Column] | None = None) -> DataFrame:
    """Project any DataFrame with a time column into a record frame.

    ``seq`` (arrival order) has no default: no column of a file says it.
    """
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    dtype = df.schema[time_col].dataType
    ms = epoch_ms(F.col(time_col), dtype)
    s = F.col(seq) if isinstance(seq, str) else seq
    cols = [k.alias("key"), v.alias("value"), ms.alias("ms")]
    cols += [c.alias(n) for n, c in (extra or {}).items()]
    out = df.select(*cols, s.alias("seq"))
    return out.withColumn("ts", event_time("ms")).select(
        "key", "value", "ms", "ts", "seq", *list((extra or {}).keys()))


def event_records(spark: SparkSession, sf_dir: str, key: str = "event_type",
                  value: Column | str | None = None,
                  extra: dict[str, Column] | None = None) -> DataFrame:
    """The ``events`` table as a record stream.

    Default value is the amount in exact cents; ``seq`` is ``event_id``
    (arrival order, increasing with time in the driver data).
    """
    e = load_table(spark, sf_dir, "events")
    v = cents("value") if value is None else value
    return to_records(e, key=key, value=v, time_col="ts", seq="event_id", extra=extra)
