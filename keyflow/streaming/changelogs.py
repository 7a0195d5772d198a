"""Whole changelogs of a stream: one row for every update, whatever the micro-batches.

A batch takes its running values on from what the batches before left, which it
reads from a table log (the buckets of its keys), and writes its updates to a
folder of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.operators import changelog
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog, newest_by


def run_count_updates(df: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """Every update of a count per ``keys`` (column -> type): (keys, cnt, seq). ``df`` has the keys and ``seq``."""
    spark, names = df.sparkSession, list(keys)
    base = shared_dir(spark, name)
    schema = ", ".join(f"{k} {t}" for k, t in keys.items())
    log = f"{schema}, cnt long, seq long"
    spark.createDataFrame([], log).write.parquet(f"{base}/log/batch_id={NO_BATCH}")
    totals = TableLog(spark, f"{base}/totals", f"{schema}, cnt long", names, newest_by(names, "cnt"))

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        at = f"{base}/log/batch_id={batch_id}"
        earlier = totals.read(s, batch_id, batch)
        changelog.running_counts(batch, names, earlier=earlier).select(*names, "cnt", "seq").write.mode("overwrite").parquet(at)
        totals.append(batch_id, s.read.schema(log).parquet(at).groupBy(*names).agg(F.max("cnt").alias("cnt")))
    run_batches(df.select(*names, "seq"), base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    return spark.read.schema(log).parquet(f"{base}/log").drop("batch_id")


def run_filter_changelog(df: DataFrame, predicate: Column, name: str, key_type: str = "string") -> DataFrame:
    """The changelog of the filtered table of ``df`` (key, value bigint, seq): (key, seq, change, old_value, new_value)."""
    spark = df.sparkSession
    base = shared_dir(spark, name)
    out, rows = (f"key {key_type}, seq long, change string, old_value long, new_value long",
                 f"key {key_type}, value long, seq long")
    spark.createDataFrame([], out).write.parquet(f"{base}/log/batch_id={NO_BATCH}")
    newest = newest_by(["key"], "seq")
    table = TableLog(spark, f"{base}/table", rows, ["key"], newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        updates = changelog.with_previous(batch, table.read(s, batch_id, batch))
        changelog.filter_changelog(updates, predicate).write.mode("overwrite").parquet(f"{base}/log/batch_id={batch_id}")
        table.append(batch_id, newest(batch), F.col("value").isNotNull())
    run_batches(df.filter(F.col("key").isNotNull()).select("key", "value", "seq"), base.rsplit("/", 1)[-1], write,
                f"{base}/checkpoint")
    return spark.read.schema(out).parquet(f"{base}/log").drop("batch_id")
