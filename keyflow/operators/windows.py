"""Event-time windows over record frames.

Window bounds are reported as BIGINT epoch ms (``window_start``,
``window_end``). Tumbling and hopping use Spark's ``window`` (epoch aligned,
``[start, end)``) and work unchanged on streams; session windows use
``session_window`` with the end moved back to the last record; sliding
windows and the exact per-record late-drop rule have no built-in and are
compositions of window functions over time buckets (no group larger than a
bucket, no global ordering).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.functions.time import floor_div

COUNT = "count"
SUM = "sum"


def _aggs(kind: str) -> list[Column]:
    if kind == COUNT:
        return [F.count(F.lit(1)).alias("cnt")]
    if kind == SUM:
        return [F.sum("value").cast("bigint").alias("total")]
    raise ValueError(f"unknown window aggregate {kind!r}")


def _ms_interval(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def _keyed(df: DataFrame, kind: str, skip_null_values: bool) -> DataFrame:
    df = df.filter(F.col("key").isNotNull())
    if kind == SUM or skip_null_values:
        df = df.filter(F.col("value").isNotNull())
    return df


def with_grace(df: DataFrame, grace_ms: int | None) -> DataFrame:
    """Watermark = max event time − grace (streams only; a no-op in batch)."""
    if grace_ms is None or not df.isStreaming:
        return df
    return df.withWatermark("ts", _ms_interval(grace_ms))


def tumbling(df: DataFrame, size_ms: int, kind: str = COUNT, grace_ms: int | None = None) -> DataFrame:
    """Tumbling windows ``[k·size, (k+1)·size)`` per key."""
    return hopping(df, size_ms, size_ms, kind, grace_ms)


def hopping(df: DataFrame, size_ms: int, advance_ms: int, kind: str = COUNT,
            grace_ms: int | None = None) -> DataFrame:
    """Hopping windows: starts at multiples of ``advance``; a record at t is in
    every window with ``start <= t < start + size`` (size need not be a
    multiple of advance)."""
    df = with_grace(_keyed(df, kind, skip_null_values=False), grace_ms)
    if size_ms == advance_ms:
        w = F.window("ts", _ms_interval(size_ms))
    else:
        w = F.window("ts", _ms_interval(size_ms), _ms_interval(advance_ms))
    out = df.groupBy("key", w.alias("w")).agg(*_aggs(kind))
    return out.select("key", F.unix_millis(F.col("w.start")).alias("window_start"),
                      F.unix_millis(F.col("w.end")).alias("window_end"),
                      *[c for c in out.columns if c not in ("key", "w")])


def session(df: DataFrame, gap_ms: int, kind: str = COUNT, grace_ms: int | None = None,
            bucket_ms: int | None = None) -> DataFrame:
    """Session windows: records of a key within ``gap`` (inclusive) merge.

    Bounds are the first and the last record of the session (Spark's
    ``session_window`` reports ``last + gap`` as the end).

    Streams use ``session_window`` (state holds the open sessions per key).
    Batch uses a two-level plan, because the built-in batch plan ships every
    record of a key to one task: (1) hash-partition by ``(key, time bucket)``
    and cut each bucket into partial sessions where ``ms - previous > gap``;
    (2) merge the partial sessions that lie within ``gap`` of a bucket border,
    in start order with the same rule (they are disjoint and sorted, so the
    previous end is the running end); all others are whole already. Records of
    one key and time are combined before, map-side too, so a bucket holds at
    most one row for each of its milliseconds, and at most two partial sessions
    of a bucket reach the per-key step.
    """
    df = _keyed(df, kind, skip_null_values=False)
    if df.isStreaming:
        df = with_grace(df, grace_ms)
        # Bounds come from aggregates, not from the grouping column: a filter on
        # a grouping column would be pushed below the aggregate by Catalyst,
        # where it cuts per-record session windows before they merge.
        out = df.groupBy("key", F.session_window("ts", _ms_interval(gap_ms)).alias("w")).agg(
            F.min("ms").alias("window_start"), F.max("ms").alias("window_end"), *_aggs(kind))
        return out.drop("w")
    name = "cnt" if kind == COUNT else "total"
    return partial_sessions(df, gap_ms, bucket_ms).select("key", "window_start", "window_end", name)


def partial_sessions(df: DataFrame, gap_ms: int, bucket_ms: int | None = None) -> DataFrame:
    """Sessions of a batch with both aggregates: key, window_start, window_end, cnt, total (of non-null values)."""
    gap = int(gap_ms)
    width = int(bucket_ms) if bucket_ms else max(4 * gap, 1)
    x = (df.groupBy("key", "ms").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("v"))
         .withColumn("bucket", floor_div("ms", width)))
    in_bucket = Window.partitionBy("key", "bucket").orderBy("ms")
    x = x.withColumn("_brk", F.when(F.col("ms") - F.lag("ms").over(in_bucket) <= F.lit(gap), 0).otherwise(1))
    x = x.withColumn("_local", F.sum("_brk").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    partial = x.groupBy("key", "bucket", "_local").agg(
        F.min("ms").alias("p_start"), F.max("ms").alias("p_end"), F.sum("n").alias("n"), F.sum("v").alias("v"))
    # a partial session further than the gap from both borders is whole: a group of its own in the last step
    low = F.col("bucket") * F.lit(width)
    border = (F.col("p_start") - F.lit(gap) < low) | (F.col("p_end") + F.lit(gap) >= low + F.lit(width))
    partial = partial.withColumn("_whole", F.when(~border, F.col("p_start")))
    per_key = Window.partitionBy("key", "_whole").orderBy("p_start")
    merged = partial.withColumn(
        "_brk", F.when(F.col("p_start") - F.lag("p_end").over(per_key) <= F.lit(gap), 0).otherwise(1))
    merged = merged.withColumn("_sid", F.sum("_brk").over(per_key.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.groupBy("key", "_whole", "_sid").agg(F.min("p_start").alias("p_start"), F.max("p_end").alias("p_end"),
                                                         F.sum("n").alias("n"), F.sum("v").alias("v"))
    return merged.select("key", F.col("p_start").alias("window_start"), F.col("p_end").alias("window_end"),
                         F.col("n").cast("bigint").alias("cnt"), F.col("v").cast("bigint").alias("total"))


def with_halo(points: DataFrame, diff_ms: int, width: int) -> DataFrame:
    """``points`` (with ``ms``) in the time bucket of their own (``own``), and copied to the neighbouring one
    where they lie within ``diff + 1`` of its border."""
    b = floor_div("ms", width)
    lo = b * F.lit(width)

    def copy(bucket, own):
        return F.struct(bucket.alias("bucket"), F.lit(own).alias("own"))
    none = F.array().cast("array<struct<bucket:bigint,own:boolean>>")
    copies = F.concat(
        F.array(copy(b, True)),
        F.when(F.col("ms") >= lo + F.lit(width - diff_ms), F.array(copy(b + 1, False))).otherwise(none),
        F.when(F.col("ms") <= lo + F.lit(diff_ms), F.array(copy(b - 1, False))).otherwise(none),
    )
    return points.withColumn("_c", F.explode(copies)).select(*points.columns, "_c.bucket", "_c.own")


def sliding_width(diff_ms: int, bucket_ms: int | None = None) -> int:
    """Width of the time buckets; a bucket's halo is one neighbour wide."""
    width = int(bucket_ms) if bucket_ms else max(8 * (int(diff_ms) + 1), 3_600_000)
    if width < int(diff_ms) + 1:
        raise ValueError("bucket width must be at least diff + 1 ms")
    return width


def sliding(df: DataFrame, diff_ms: int, kind: str = COUNT, bucket_ms: int | None = None) -> DataFrame:
    """Record-defined sliding windows of width ``diff`` (inclusive both ends).

    For a record at t: the left window ``[t-d, t]`` always exists; the right
    window ``[t+1, t+1+d]`` exists iff a later record falls in it. Windows
    with the same start are the same window.

    Plan: records of one key and time are combined first (map-side too). Points
    are hash-partitioned by ``(key, time bucket)``, so a hot key is spread over
    its buckets, and a point near a border is copied into the neighbouring
    bucket (halo), so every bucket sees all it needs. A point adds its value at
    ``t`` and takes it away at ``t+d+1``: one running sum over these rows, linear
    in their number however dense the key, is the left window at the first row
    and the right window at the second. A right window is emitted only when no
    point sits exactly at its end (else it is that point's left window), so
    every window has exactly one owner.
    """
    d = int(diff_ms)
    width = sliding_width(d, bucket_ms)
    value = F.lit(None).cast("bigint") if kind == COUNT else F.col("value")
    pts = (_keyed(df, kind, skip_null_values=True).groupBy("key", "ms")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("bigint").alias("v")))
    name = "cnt" if kind == COUNT else "total"
    return sliding_points(pts, d, width).select("key", "window_start", "window_end", name)


def sliding_points(points: DataFrame, diff_ms: int, width: int) -> DataFrame:
    """Windows of combined points (key, ms, n, v): key, owner (the time of the point that makes it), window_start,
    window_end, cnt, total."""
    d = int(diff_ms)
    x = with_halo(points, d, width)
    comes = F.struct(F.col("ms").alias("at"), F.lit(True).alias("comes"), F.col("n"), F.col("v"))
    goes = F.struct((F.col("ms") + F.lit(d + 1)).alias("at"), F.lit(False).alias("comes"), (-F.col("n")).alias("n"),
                    (-F.col("v")).alias("v"))
    steps = x.select("key", "bucket", "own", F.explode(F.array(comes, goes)).alias("s")).select(
        "key", "bucket", "own", "s.*")
    part = Window.partitionBy("key", "bucket").orderBy("at")
    so_far = part.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # equal times included
    here = part.rangeBetween(Window.currentRow, Window.currentRow)            # two rows at most
    y = (steps.withColumn("cnt", F.sum("n").over(so_far)).withColumn("total", F.sum("v").over(so_far))
         .withColumn("point", F.max("comes").over(here)))
    owner = F.col("own") & (F.col("comes") | ((F.col("cnt") > 0) & ~F.col("point")))
    made = F.when(F.col("comes"), F.col("at")).otherwise(F.col("at") - F.lit(d + 1))
    return y.filter(owner).select("key", made.alias("owner"), (F.col("at") - F.lit(d)).alias("window_start"),
                                  F.col("at").alias("window_end"), "cnt", "total")


def running_stream_time(df: DataFrame, arrival: Column, tiebreak: Column,
                        source_partition: Column | None = None,
                        chunk_rows: int = 1 << 20, before: str | None = None) -> DataFrame:
    """``stream_time`` = max event ms seen so far in arrival order, per source
    partition, the record itself included; a column named ``before`` has the one
    that the record met (null for a partition's first record).

    A parallel prefix-max: arrival positions are cut into chunks; each chunk
    computes its local running max; a small per-chunk table carries the max of
    all earlier chunks, joined back on (partition, chunk). No task ever holds
    more than one chunk of one source partition.
    """
    src = F.lit(0) if source_partition is None else source_partition
    x = (df.withColumn("_arr", arrival).withColumn("_tb", tiebreak).withColumn("_src", src)
         .withColumn("_chunk", floor_div(F.col("_arr"), chunk_rows)))
    local = Window.partitionBy("_src", "_chunk").orderBy("_arr", "_tb")
    x = x.withColumn("_local", F.max("ms").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if before:
        met = local.rowsBetween(Window.unboundedPreceding, -1)
        x = x.withColumn("_lmet", F.max("ms").over(met))
    per_chunk = x.groupBy("_src", "_chunk").agg(F.max("ms").alias("_cmax"))
    earlier = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select("_src", "_chunk", F.max("_cmax").over(earlier).alias("_prev"))
    x = x.join(carry, ["_src", "_chunk"], "left")
    st = F.greatest(F.col("_local"), F.coalesce(F.col("_prev"), F.col("_local")))
    x = x.withColumn("stream_time", st)
    if before:  # greatest() leaves nulls out
        x = x.withColumn(before, F.greatest("_lmet", "_prev")).drop("_lmet")
    return x.drop("_arr", "_tb", "_src", "_chunk", "_local", "_prev")


def late_drop_exact(df: DataFrame, size_ms: int, grace_ms: int, arrival: Column,
                    tiebreak: Column, source_partition: Column | None = None,
                    chunk_rows: int = 1 << 20, advance_ms: int | None = None) -> DataFrame:
    """Tumbling (or, with ``advance_ms``, hopping) count with the reference's
    per-record late rule: a record is left out of a window when
    ``window_end + grace <= stream_time`` (stream time advanced per record, per
    source partition, in arrival order)."""
    x = running_stream_time(_keyed(df, COUNT, False), arrival, tiebreak, source_partition, chunk_rows)
    return count_in_time(x, size_ms, grace_ms, advance_ms)


def count_in_time(timed: DataFrame, size_ms: int, grace_ms: int, advance_ms: int | None = None) -> DataFrame:
    """Window counts of records with a ``stream_time``, each left out of the windows it is too late for."""
    advance = int(advance_ms or size_ms)
    newest = floor_div("ms", advance) * F.lit(advance)
    starts = F.array(*[newest - F.lit(k * advance) for k in range(-(-int(size_ms) // advance))])
    kept = timed.withColumn("window_start", F.explode(starts)).filter(
        (F.col("window_start") + F.lit(size_ms) > F.col("ms"))
        & (F.col("window_start") + F.lit(size_ms + grace_ms) > F.col("stream_time")))
    return (kept.groupBy("key", "window_start").agg(F.count(F.lit(1)).alias("cnt"))
            .select("key", "window_start", (F.col("window_start") + F.lit(size_ms)).alias("window_end"), "cnt"))
