"""Session windows on a stream with early (update) results.

Spark rejects update mode for ``session_window``, and complete mode re-emits the
whole state every trigger. Here each micro-batch is reduced to partial sessions
by the batch plan (``windows.session``: combined map-side and bucketed, so a hot
key's records are spread) and these are merged with the open sessions of their
keys, as a DataFrame. Only what changed is written:

* an upsert ``(key, start, end, cnt, total)`` for every session that got new
  records (possibly merging older sessions), and
* a retraction (``deleted = true``) for every older session absorbed into a
  session with an earlier start,

each tagged with the ``batch_id``; the current sessions are the newest row per
``(key, window_start)`` that is not a retraction. Merge rule: records (and
sessions) closer than or exactly ``gap`` apart belong to one session.

A record is late if the session it would be in ended more than ``gap + grace``
before the stream time of the batches before; closed sessions are not looked at
again. The sessions lie in a table log, of which a batch reads the buckets of its
keys and which loses closed sessions when a bucket is compacted, so a batch's work
does not grow with the batches before. A retried batch overwrites its own
partition and reads those before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.operators import windows
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog, newest_by

LOG = "key {key_type}, window_start long, window_end long, cnt long, total long, deleted boolean"


def merge_sessions(parts: DataFrame, gap_ms: int) -> DataFrame:
    """``parts`` (key, window_start, window_end, …) with ``first`` and ``last``, the bounds of the
    session that each part is in once parts at most ``gap`` apart are merged."""
    order = Window.partitionBy("key").orderBy("window_start", "window_end")
    reach = F.max("window_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("window_start") - reach <= F.lit(int(gap_ms)), 0).otherwise(1)
    numbered = parts.withColumn("_new", new).withColumn(
        "_sid", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("key", "_sid")
    return (numbered.withColumn("first", F.min("window_start").over(whole))
            .withColumn("last", F.max("window_end").over(whole)).drop("_new", "_sid"))


def _run_sessions(df: DataFrame, gap_ms: int, grace_ms: int, name: str, key_type: str, final: bool) -> DataFrame:
    spark, gap = df.sparkSession, int(gap_ms)
    base = shared_dir(spark, name)
    log, times = LOG.format(key_type=key_type), "ms long"
    columns = ["key", "window_start", "window_end", "cnt", "total"]
    spark.createDataFrame([], log).write.parquet(f"{base}/log/batch_id={NO_BATCH}")
    spark.createDataFrame([], times).write.parquet(f"{base}/time/batch_id={NO_BATCH}")
    spark.createDataFrame([], log).select(columns).write.parquet(f"{base}/final/batch_id={NO_BATCH}")
    sessions = TableLog(spark, f"{base}/open", f"{log}, batch long", ["key"], newest_by(["key", "window_start"], "batch"))

    def still(end: str, closed: int):
        # a final result has gone out once its end is ``closed``; an early one may then still change
        return F.col(end) > closed if final else F.col(end) >= closed

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        before = s.read.schema(times).parquet(f"{base}/time/batch_id={batch_id - 1}")
        seen = before.agg(F.max("ms")).first()[0]
        closed = None if seen is None else seen - int(grace_ms) - gap  # sessions that ended before are closed
        new = windows.partial_sessions(batch, gap)
        old = sessions.read(s, batch_id, batch.select("key")).filter(~F.col("deleted"))
        if closed is not None:
            old = old.filter(still("window_end", closed))
        both = merge_sessions(new.select(*columns, F.lit(True).alias("fresh"))
                              .unionByName(old.select(*columns, F.lit(False).alias("fresh"))), gap)
        if closed is not None:
            both = both.filter(still("last", closed))  # late records
        session = both.groupBy("key", "first").agg(
            F.max("last").alias("window_end"), F.sum("cnt").alias("cnt"), F.sum("total").alias("total"),
            F.max("fresh").alias("changed"),
            F.collect_list(F.when(~F.col("fresh") & (F.col("window_start") != F.col("first")),
                                  F.struct("window_start", "window_end"))).alias("gone"))
        changed = session.filter("changed")
        nothing = F.lit(None).cast("bigint")
        up = changed.select("key", F.col("first").alias("window_start"), "window_end", "cnt", "total",
                            F.lit(False).alias("deleted"))
        down = changed.select("key", F.inline("gone")).select(
            "key", "window_start", "window_end", nothing.alias("cnt"), nothing.alias("total"), F.lit(True).alias("deleted"))
        at = f"{base}/log/batch_id={batch_id}"
        up.unionByName(down).write.mode("overwrite").parquet(at)
        live = ~F.col("deleted") if closed is None else ~F.col("deleted") & still("window_end", closed)
        sessions.append(batch_id, s.read.schema(log).parquet(at).withColumn("batch", F.lit(batch_id).cast("long")), live)
        (batch.select("ms").unionByName(before).agg(F.max("ms").alias("ms")).coalesce(1)
         .write.mode("overwrite").parquet(f"{base}/time/batch_id={batch_id}"))
        if final:
            now = s.read.schema(times).parquet(f"{base}/time/batch_id={batch_id}").first()[0]
            whole = sessions.read(s, batch_id + 1).filter(~F.col("deleted")).select(columns)
            whole = whole.filter(F.col("window_end") <= now - int(grace_ms) - gap) if now is not None else whole.limit(0)
            if closed is not None:
                whole = whole.filter(still("window_end", closed))  # not sent before
            whole.write.mode("overwrite").parquet(f"{base}/final/batch_id={batch_id}")
    run_batches(df.filter(F.col("key").isNotNull()), base.rsplit("/", 1)[-1], merge, f"{base}/checkpoint")
    if final:
        return spark.read.parquet(f"{base}/final").drop("batch_id")
    return spark.read.schema(f"{log}, batch_id int").parquet(f"{base}/log")


def run_session_updates(df: DataFrame, gap_ms: int, grace_ms: int, name: str, key_type: str = "string") -> DataFrame:
    """Run to the end of the record stream ``df``; returns the changelog with ``batch_id``."""
    return _run_sessions(df, gap_ms, grace_ms, name, key_type, final=False)


def run_session_final(df: DataFrame, gap_ms: int, grace_ms: int, name: str, key_type: str = "string") -> DataFrame:
    """Run to the end of ``df``; returns each session (key, window_start, window_end, cnt, total) once, when the
    newest time is gap and grace past its end. Closed sessions take no more records.

    A hot key's records are reduced in time buckets before its sessions meet in one task, which Spark's own
    ``session_window`` on a stream does not do.
    """
    return _run_sessions(df, gap_ms, grace_ms, name, key_type, final=True)


def current_sessions(changelog: DataFrame) -> DataFrame:
    """Newest row per (key, window_start) that is not a retraction."""
    newest = changelog.groupBy("key", "window_start").agg(
        F.max_by(F.struct("window_end", "cnt", "total", "deleted"), "batch_id").alias("r"))
    return newest.select("key", "window_start", "r.*").filter(~F.col("deleted")).drop("deleted")
