"""Operators on a stream that follow stream time record by record.

Spark's watermark moves once per micro-batch. Here the stream time of each
source partition is carried from batch to batch (a row per partition) and enters
the next batch as a record that comes before all others, so the exact rules of
the batch operators hold across batches: the result does not depend on how
records fall into batches, as long as batches come in arrival order. Each batch
writes folders of its own and reads what the batch before left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.operators import punctuation, windows
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog, newest_by

TIMES = "partition long, ms long"
FIRST = -(1 << 62)


class StreamTimes:
    """The stream time of every source partition, as each batch left it."""

    def __init__(self, spark, path: str):
        self.path = path
        spark.createDataFrame([], TIMES).write.parquet(f"{path}/batch_id={NO_BATCH}")

    def before(self, spark, batch_id: int) -> DataFrame:
        return spark.read.schema(TIMES).parquet(f"{self.path}/batch_id={batch_id - 1}")

    def with_carry(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """``batch`` and a record per partition (``carried``) with the stream time of before, ahead of all others."""
        carry = self.before(batch.sparkSession, batch_id).select(
            "partition", "ms", F.lit(FIRST).alias("arrival"), F.lit(FIRST).alias("tiebreak"), F.lit(True).alias("carried"))
        return batch.withColumn("carried", F.lit(False)).unionByName(carry, allowMissingColumns=True)

    def leave(self, batch: DataFrame, batch_id: int) -> None:
        both = batch.select("partition", "ms").unionByName(self.before(batch.sparkSession, batch_id))
        (both.filter("ms is not null").groupBy("partition").agg(F.max("ms").alias("ms")).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}"))


def _arriving(df: DataFrame, arrival: Column, tiebreak: Column, partition: Column | None) -> DataFrame:
    src = F.lit(0) if partition is None else partition
    return df.select("key", "value", "ms", src.cast("bigint").alias("partition"), arrival.cast("bigint").alias("arrival"),
                     tiebreak.cast("bigint").alias("tiebreak"))


def run_late_exact(df: DataFrame, size_ms: int, grace_ms: int, arrival: Column, tiebreak: Column, name: str,
                   source_partition: Column | None = None, key_type: str = "string",
                   advance_ms: int | None = None) -> DataFrame:
    """Tumbling or hopping counts of a stream under the exact late rule: (key, window_start, window_end, cnt, batch_id),
    the number of records that a batch adds to a window."""
    spark = df.sparkSession
    base = shared_dir(spark, name)
    counts = f"key {key_type}, window_start long, window_end long, cnt long"
    spark.createDataFrame([], counts).write.parquet(f"{base}/counts/batch_id={NO_BATCH}")
    times = StreamTimes(spark, f"{base}/time")

    def write(batch: DataFrame, batch_id: int) -> None:
        timed = windows.running_stream_time(times.with_carry(batch, batch_id), F.col("arrival"), F.col("tiebreak"),
                                            F.col("partition"))
        (windows.count_in_time(timed.filter(~F.col("carried")), size_ms, grace_ms, advance_ms)
         .write.mode("overwrite").parquet(f"{base}/counts/batch_id={batch_id}"))
        times.leave(batch, batch_id)
    arriving = _arriving(df.filter(F.col("key").isNotNull()), arrival, tiebreak, source_partition)
    run_batches(arriving, base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    return spark.read.schema(f"{counts}, batch_id int").parquet(f"{base}/counts")


def current_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("key", "window_start", "window_end").agg(F.sum("cnt").alias("cnt"))


def run_flush_all(df: DataFrame, tick_ms: int, kind: str, arrival: Column, tiebreak: Column, name: str,
                  source_partition: Column | None = None, key_type: str = "string",
                  changes: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """What the flushes of a stream send: (partition, key, value, stream_time).

    The store is a table log by key; a batch reads the entries it changes, and the
    whole store only if it has a flush, which sends the whole store on.
    ``changes(records, keep)`` explodes records into rows (key, value and the columns ``keep``); without it
    a record is a change itself.
    """
    spark = df.sparkSession
    base = shared_dir(spark, name)
    sent = f"partition long, key {key_type}, value long, stream_time long"
    entry = f"partition long, key {key_type}, value long, batch long"
    spark.createDataFrame([], sent).write.parquet(f"{base}/sent/batch_id={NO_BATCH}")
    times = StreamTimes(spark, f"{base}/time")
    store = TableLog(spark, f"{base}/store", entry, ["partition", "key"], newest_by(["partition", "key"], "batch"))
    combine = {punctuation.MAX: F.max, punctuation.SUM: F.sum}[kind]
    keep = ["partition", "tick", "fires"]

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        timed = punctuation.punctuated(times.with_carry(batch, batch_id), tick_ms, F.col("arrival"), F.col("tiebreak"),
                                       F.col("partition")).filter(~F.col("carried"))
        flushes = punctuation.numbered_flushes(timed)
        each = timed.select("key", "value", *keep) if changes is None else changes(timed, keep)
        known = each.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
        out = f"{base}/sent/batch_id={batch_id}"
        if flushes.isEmpty():
            s.createDataFrame([], sent).write.mode("overwrite").parquet(out)
        else:
            (punctuation.flush_all(known, flushes, kind, store.read(s, batch_id)).write.mode("overwrite").parquet(out))
        new = known.groupBy("partition", "key").agg(combine("value").alias("value"))
        old = store.read(s, batch_id, known.select("partition", "key")).drop("batch")
        store.append(batch_id, new.unionByName(old).groupBy("partition", "key").agg(combine("value").alias("value"))
                     .withColumn("batch", F.lit(batch_id).cast("bigint")))
        times.leave(batch, batch_id)
    run_batches(_arriving(df, arrival, tiebreak, source_partition), base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    return spark.read.schema(sent).parquet(f"{base}/sent").drop("batch_id")
