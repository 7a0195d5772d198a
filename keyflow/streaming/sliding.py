"""Sliding (record-defined) windows on a stream, final results.

Records of a micro-batch are combined to points (a key and time with its count
and sum) and appended to a table log; what a batch writes follows its new points,
not what is kept. The point that makes a window (``owner`` t: left window
``[t-d, t]``, right window ``[t+1, t+1+d]``) is ready when the watermark, the
newest time less the grace, has passed ``t + d + 1``. A batch takes the windows of
the points that its watermark makes ready from the live points by the plan of the
batch operator (``windows.sliding_points``: time buckets with halo, so a hot key is
spread). Points that no window to come needs are left out when the log is
compacted; what lives is what came within two widths and the grace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.operators import windows
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog

OUTPUT = "key {key_type}, window_start long, window_end long, cnt long, total long"
POINT = "key {key_type}, ms long, n long, v long"


def _combined(points: DataFrame) -> DataFrame:
    return points.groupBy("key", "ms").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


def run_sliding(df: DataFrame, diff_ms: int, grace_ms: int, name: str, key_type: str = "string",
                bucket_ms: int | None = None) -> DataFrame:
    """Run to the end of the record stream ``df``; returns its final windows (key, window_start, window_end, cnt, total).

    Records whose windows are all emitted are left out.
    """
    spark, d, grace = df.sparkSession, int(diff_ms), int(grace_ms)
    width = windows.sliding_width(d, bucket_ms)
    base = shared_dir(spark, name)
    out, times = OUTPUT.format(key_type=key_type), "ms long"
    spark.createDataFrame([], out).write.parquet(f"{base}/out/batch_id={NO_BATCH}")
    spark.createDataFrame([], times).write.parquet(f"{base}/time/batch_id={NO_BATCH}")
    live = TableLog(spark, f"{base}/points", POINT.format(key_type=key_type), ["key", "ms"], _combined)

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        before = s.read.schema(times).parquet(f"{base}/time/batch_id={batch_id - 1}")
        seen, newest = before.agg(F.max("ms")).first()[0], batch.agg(F.max("ms")).first()[0]
        newest = max((t for t in (seen, newest) if t is not None), default=None)
        s.createDataFrame([(newest,)], times).coalesce(1).write.mode("overwrite").parquet(f"{base}/time/batch_id={batch_id}")
        # owners from ``first`` on are still to come; those before ``ready`` come now
        first = None if seen is None else seen - grace - d - 1
        ready = 0 if newest is None else newest - grace - d - 1
        points = batch.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
        if first is not None:
            points = points.filter(F.col("ms") >= first)
        points = points.select("key", "ms", F.lit(1).cast("bigint").alias("n"), F.col("value").cast("bigint").alias("v"))
        # what this batch still needs stays; the next one needs less
        live.append(batch_id, _combined(points), None if first is None else F.col("ms") >= first - d)
        held = live.read(s, batch_id + 1)
        if first is not None:
            held = held.filter(F.col("ms") >= first - d)
        found = windows.sliding_points(held, d, width).filter(F.col("owner") < ready)
        if first is not None:
            found = found.filter(F.col("owner") >= first)
        found.drop("owner").write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")
    run_batches(df.select("key", "ms", "value"), base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    return spark.read.schema(out).parquet(f"{base}/out").drop("batch_id")
