"""Table re-group and aggregate on a stream, with adder and subtractor.

Each micro-batch takes the keys that changed, finds their row of before in a
table log (the buckets of those keys), subtracts the old value from the group it
was in and adds the new one to its own. What it writes is the change of each
group; a group's total is the sum of its changes. A group that any record names
is there, if only with 0. Changes of a group are combined map-side, so a hot
group is a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog, newest_by


def run_table_aggregate(changelog: DataFrame, group: Column, name: str, key_type: str = "string",
                        group_type: str = "string") -> DataFrame:
    """Run to the end of ``changelog`` (key, value bigint, seq); returns (key, change, batch_id).

    ``group`` is an expression over ``key`` and ``value``. A record with a smaller ``seq`` than the row
    in the table changes nothing, but names its group.
    """
    spark = changelog.sparkSession
    base = shared_dir(spark, name)
    rows, changes = f"key {key_type}, value long, seq long", f"key {group_type}, change long"
    spark.createDataFrame([], changes).write.parquet(f"{base}/changes/batch_id={NO_BATCH}")
    newest = newest_by(["key"], "seq")
    table = TableLog(spark, f"{base}/rows", rows, ["key"], newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        batch = batch.filter(F.col("key").isNotNull()).select("key", "value", "seq")
        old = table.read(s, batch_id, batch)
        at = f"{base}/batch/batch_id={batch_id}"
        (newest(batch).join(old.select("key", F.col("value").alias("old_value"), F.col("seq").alias("old_seq")), "key", "left")
         .filter("old_seq is null or seq > old_seq").write.mode("overwrite").parquet(at))
        new = s.read.schema(f"{rows}, old_value long, old_seq long").parquet(at)
        table.append(batch_id, new)
        named = batch.filter(F.col("value").isNotNull()).select(group.alias("key"), F.lit(0).cast("bigint").alias("change"))
        adds = new.filter(F.col("value").isNotNull()).select(group.alias("key"), F.col("value").alias("change"))
        takes = (new.select("key", F.col("old_value").alias("value")).filter(F.col("value").isNotNull())
                 .select(group.alias("key"), (-F.col("value")).alias("change")))
        (named.union(adds).union(takes).filter("key is not null").groupBy("key").agg(F.sum("change").alias("change"))
         .write.mode("overwrite").parquet(f"{base}/changes/batch_id={batch_id}"))
    run_batches(changelog, base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    return spark.read.schema(f"{changes}, batch_id int").parquet(f"{base}/changes")


def current_totals(log: DataFrame) -> DataFrame:
    """(key, total) of every group."""
    return log.groupBy("key").agg(F.sum("change").cast("bigint").alias("total"))
