"""Stream–stream interval joins on Structured Streaming.

Both sides carry a watermark (``grace`` = allowed lateness, 0 = no grace);
the time-range condition lets Spark evict join state once the watermark has
passed ``ts + bound``, and is what makes the outer forms possible: an
unmatched row is emitted when it can no longer match. ``interval_join_stream`` is
Spark's operator, for plans that go on with its rows; ``run_join`` runs a join of
any kind to its end with the records in a table log, under the same watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import joiner_text
from keyflow.functions.time import floor_div
from keyflow.operators.joins import FULL, INNER, LEFT, PAIR, interval_join, joined_text
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog

HOW = {"inner": "inner", "left": "leftOuter"}
TIMES = "l_ms long, r_ms long, before long, now long"  # newest times, and the watermark before and after the batch


def _prepare(df: DataFrame, p: str) -> DataFrame:
    return df.filter(F.col("key").isNotNull()).select(
        F.col("key").alias(f"{p}key"), F.col("seq").alias(f"{p}seq"), F.col("ms").alias(f"{p}ms"),
        F.col("ts").alias(f"{p}ts"), F.col("value").alias(f"{p}value"))


def _near(own: DataFrame, near: DataFrame, bound: int, wm: str, how: str) -> DataFrame:
    """Left rows in the bucket of their time, right rows copied to every bucket
    they can match; equi-join on (key, bucket) plus the time range."""
    width = max(bound, 1)
    own = own.withColumn("l_bucket", floor_div("l_ms", width)).withWatermark("l_ts", wm)
    near = near.withColumn("r_bucket", F.explode(F.sequence(
        floor_div(F.col("r_ms") - F.lit(bound), width), floor_div(F.col("r_ms") + F.lit(bound), width)))
    ).withWatermark("r_ts", wm)
    span = F.expr(f"INTERVAL {bound} MILLISECONDS")
    cond = ((F.col("l_key") == F.col("r_key")) & (F.col("l_bucket") == F.col("r_bucket"))
            & (F.col("r_ts") >= F.col("l_ts") - span) & (F.col("r_ts") <= F.col("l_ts") + span))
    return own.join(near, cond, how)


def interval_join_stream(left: DataFrame, right: DataFrame, bound_ms: int, how: str = "inner",
                         grace_ms: int = 0, joiner=joiner_text) -> DataFrame:
    """Inner or left join keyed by ``(key, time bucket)`` as in the batch form, so the join state of a hot
    key is spread over its buckets: left rows in their own bucket, right rows copied to the buckets they can
    match. A left row meets all its candidates once, so the left outer join is exact in one operator."""
    if how == "full":
        raise ValueError("a full join on a stream keeps a table log: run_join")
    j = _near(_prepare(left, "l_"), _prepare(right, "r_"), int(bound_ms), f"{int(grace_ms)} milliseconds", HOW[how])
    return joined_text(j.select(F.col("l_key").alias("key"), *PAIR[1:]), joiner)


def _held(df: DataFrame, p: str) -> DataFrame:
    return df.filter(F.col("key").isNotNull()).select(
        "key", "ms", F.lit(p == "l_").alias("is_left"), F.col("seq").alias(f"{p}seq"), F.col("value").alias(f"{p}value"))


def _side(rows: DataFrame, p: str) -> DataFrame:
    own = F.col("is_left") if p == "l_" else ~F.col("is_left")
    return rows.filter(own).select("key", "ms", F.col(f"{p}seq").alias("seq"), F.col(f"{p}value").alias("value"))


def _pairs(left: DataFrame, right: DataFrame, bound: int, joiner) -> DataFrame:
    # copies are not broadcast: Spark's estimate of a side does not count them
    return interval_join(_side(left, "l_"), _side(right, "r_").hint("merge"), bound, INNER, joiner)


def _alone(rows: DataFrame, others: DataFrame, bound: int, width: int, joiner) -> DataFrame:
    """``rows`` of either side that no record of the other side among ``others`` is near to."""
    near = others.select(
        F.col("key").alias("n_key"), (~F.col("is_left")).alias("n_is_left"), F.col("ms").alias("n_ms"),
        F.explode(F.sequence(floor_div(F.col("ms") - F.lit(bound), width),
                             floor_div(F.col("ms") + F.lit(bound), width))).alias("n_tile")).hint("merge")
    cond = ((F.col("key") == F.col("n_key")) & (F.col("tile") == F.col("n_tile"))
            & (F.col("is_left") == F.col("n_is_left")) & (F.abs(F.col("ms") - F.col("n_ms")) <= F.lit(bound)))
    alone = rows.join(near, cond, "left_anti").withColumns(
        {"l_ms": F.when(F.col("is_left"), F.col("ms")), "r_ms": F.when(~F.col("is_left"), F.col("ms"))})
    return joined_text(alone.select(*PAIR), joiner)


def run_full_join(left: DataFrame, right: DataFrame, bound_ms: int, name: str, grace_ms: int = 0,
                  joiner=joiner_text) -> DataFrame:
    """:func:`run_join`, full outer."""
    return run_join(left, right, bound_ms, name, FULL, grace_ms, joiner)


def run_join(left: DataFrame, right: DataFrame, bound_ms: int, name: str, how: str = INNER, grace_ms: int = 0,
             joiner=joiner_text) -> DataFrame:
    """Inner, left or full outer join, run to the end of both streams.

    A micro-batch appends its records to a table log by (key, tile of time), joins them with each other and with
    the records that the log holds in their own and the neighbouring tiles, by the plan of the batch operator, and
    gives, in an outer join, the records without a partner that the watermark lets go: an anti-join of those with
    what is live. So nothing is kept or looked up record by record, as in a state store. The log loses records that
    no record to come and none still waiting can be near to.

    The watermark is Spark's: the smaller of both sides' newest times less the grace, as the batch before left it;
    a batch leaves out records that are not past the one before that. After the last batch, what the last
    watermark lets go comes.
    """
    spark, bound, grace = left.sparkSession, int(bound_ms), int(grace_ms)
    width = max(bound, 1)
    base = shared_dir(spark, name)
    both = _held(left, "l_").unionByName(_held(right, "r_"), allowMissingColumns=True).withColumn(
        "tile", floor_div("ms", width))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema)
    live = TableLog(spark, f"{base}/rows", columns, ["key", "tile"], lambda rows: rows)
    none = spark.createDataFrame([], both.schema)
    schema = _pairs(none, none, bound, joiner).schema
    spark.createDataFrame([], schema).write.parquet(f"{base}/out/batch_id={NO_BATCH}")
    spark.createDataFrame([(None, None, 0, 0)], TIMES).coalesce(1).write.parquet(f"{base}/time/batch_id={NO_BATCH}")

    def let_go(held: DataFrame, before: int, now: int) -> DataFrame:
        """Records without a partner whose last possible one lies in [before, now)."""
        near = held.filter((F.col("ms") >= before - 2 * bound) & (F.col("ms") < now))
        rows = near.filter((F.col("ms") >= before - bound) & (F.col("ms") < now - bound))
        if how == LEFT:
            rows, near = rows.filter("is_left"), near.filter(~F.col("is_left"))
        return _alone(rows, near, bound, width, joiner)

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        t = s.read.schema(TIMES).parquet(f"{base}/time/batch_id={batch_id - 1}").first()
        # what this batch still needs stays; the next one needs less
        live.append(batch_id, batch.filter(F.col("ms") > t.before), F.col("ms") >= t.before - 2 * bound)
        new = live.added(s, batch_id)
        if batch_id > 0:
            old = live.read(s, batch_id, new.select("key", F.explode(F.sequence(
                F.col("tile") - 1, F.col("tile") + 1)).alias("tile")))
            out = _pairs(new, new.unionByName(old), bound, joiner).unionByName(_pairs(old, new, bound, joiner))
        else:
            out = _pairs(new, new, bound, joiner)
        if how != INNER and t.now > t.before:
            out = out.unionByName(let_go(live.read(s, batch_id + 1), t.before, t.now))
        out.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")
        newest = {r[0]: r[1] for r in new.groupBy("is_left").agg(F.max("ms")).collect()}
        ends = [max((m for m in (seen, newest.get(side)) if m is not None), default=None)
                for side, seen in ((True, t.l_ms), (False, t.r_ms))]
        now = max(t.now, min(0 if m is None else m - grace for m in ends))
        s.createDataFrame([(*ends, t.now, now)], TIMES).coalesce(1).write.mode("overwrite").parquet(
            f"{base}/time/batch_id={batch_id}")
    run_batches(both, base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    last = spark.read.schema(f"{TIMES}, batch_id int").parquet(f"{base}/time").orderBy(F.desc("batch_id")).first()
    if how != INNER and last.now > last.before:
        let_go(live.read(spark, last.batch_id + 1), last.before, last.now).write.parquet(
            f"{base}/out/batch_id={last.batch_id + 1}")
    return spark.read.schema(schema).parquet(f"{base}/out").drop("batch_id")
