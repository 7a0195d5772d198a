"""Run a streaming DataFrame to completion into a table in the shared folder.

Queries use ``trigger(availableNow=True)``: everything available is processed
(in as many micro-batches as the source's rate limits give) and the no-data
batch that advances the watermark and emits closed windows runs too. Output
and checkpoint both live under ``spark.checkpoint.dir`` (a shared folder on a
cluster), so a lost executor or a restarted driver resumes from the
checkpoint.

Output modes:
  append   — file sink (exactly-once through the sink's commit log)
  update   — foreachBatch into ``batch_id=N`` partitions (a retried epoch
             overwrites its own partition: idempotent); the table is the
             changelog, ``newest_per_key`` is the current state
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from keyflow.session import ensure_streaming_state, ship_package, shared_dir, store_dir

NO_BATCH = -1


@dataclass
class StreamRun:
    name: str
    output: str
    checkpoint: str
    mode: str
    schema: StructType
    progress: list

    def read(self, spark: SparkSession) -> DataFrame:
        """What an append run emitted; an empty frame if nothing."""
        return spark.read.schema(self.schema).parquet(self.output)


def _epoch_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
    return write


def run_batches(df: DataFrame, name: str, write: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str = "append") -> list:
    """Run ``write(batch, batch_id)`` over all that is available; returns the progress reports."""
    ensure_streaming_state(df.sparkSession)
    ship_package(df.sparkSession)
    q = (df.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .outputMode(mode).foreachBatch(write).start())
    return _finish(q)


def _finish(q) -> list:
    # to the end, whatever it takes; a failure of the query is raised here
    q.awaitTermination()
    return list(q.recentProgress)


def run_stream(df: DataFrame, name: str, mode: str = "append",
               output: str | None = None, checkpoint: str | None = None, store: str | None = None) -> StreamRun:
    """Run to the end. With ``store`` the state is kept under that name (``state.open_store``)."""
    spark = df.sparkSession
    ensure_streaming_state(spark)
    ship_package(spark)
    base = shared_dir(spark, name)
    fresh = output is None
    output = output or f"{base}/out"
    checkpoint = checkpoint or (store_dir(spark, store) if store else f"{base}/checkpoint")
    query = f"{name}_{base.rsplit('-', 1)[-1]}"
    if fresh:  # so that a run that emits nothing can be read
        empty = spark.createDataFrame([], df.schema)
        empty.write.parquet(output if mode == "append" else f"{output}/batch_id={NO_BATCH}")
    if mode == "append":
        progress = _finish(df.writeStream.queryName(query).option("checkpointLocation", checkpoint)
                           .trigger(availableNow=True).outputMode("append").format("parquet")
                           .option("path", output).start())
    else:
        progress = run_batches(df, query, _epoch_writer(output), checkpoint, mode)
    return StreamRun(name, output, checkpoint, mode, df.schema, progress)


def read_changelog(spark: SparkSession, run: StreamRun) -> DataFrame:
    """All rows a foreachBatch run emitted, with their ``batch_id``."""
    return spark.read.schema(StructType([*run.schema.fields]).add("batch_id", IntegerType())).parquet(run.output)


def newest_per_key(changelog: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """Current state of an update-mode changelog: the newest row per key, combined map-side."""
    rest = [c for c in changelog.columns if c not in keys]
    newest = changelog.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest if c != "batch_id"])
