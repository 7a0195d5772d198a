"""Session and sliding windows under the exact per-record late rule, batch form.

Stream time is per source partition and moves with every record, in arrival
order (``windows.running_stream_time``, a parallel prefix maximum).

Sessions. A record finds the sessions of its key within the gap that are not
closed, that is, whose end is at least ``close = stream_time - grace - gap``; it
merges with them, and is left out if there is none and its own time is before
``close``. A session that has closed is not opened again.

The rule is about arrival order, but most of it does not depend on it. A record
at most ``grace`` behind stream time (punctual) is never left out and finds all
its neighbours open, so punctual records form ordinary sessions (bucketed, so a
hot key is spread). All punctual records before ``stream_time - grace`` have
arrived when a later one comes; so a late record inside such a session joins it
if the session reaches the record's ``close``. What is left are late records
between sessions, which can lengthen or join them, and late ones inside sessions
that only such lengthening keeps open. These are replayed in arrival order with
the sessions around them, per key and stretch of event time without a longer
pause than the gap: stretches do not meet, so a hot key is cut at its pauses and
a task gets sessions and few records, not the key's records.

Sliding windows. A record is left out of a window that ended ``grace`` or more
before its stream time, so it counts in the windows that end from
``max(ms, stream_time - grace + 1)`` to ``ms + diff``: an interval of window ends,
swept by the same running sum as ``windows.sliding``. Its left window exists if it
counts there; its right window if that was open when it came and holds a record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.functions.time import floor_div
from keyflow.operators import windows
from keyflow.operators.windows import COUNT
from keyflow.session import materialised, ship_package

_NAMES = {windows.COUNT: "cnt", windows.SUM: "total"}


def _timed(df: DataFrame, arrival: Column, tiebreak: Column, source_partition: Column | None, chunk_rows: int) -> DataFrame:
    df = df.withColumn("_a", arrival.cast("bigint")).withColumn("_t", tiebreak.cast("bigint"))
    return windows.running_stream_time(df, F.col("_a"), F.col("_t"), source_partition, chunk_rows)


def _spread(sessions: DataFrame, low: str, high: str, width: int) -> DataFrame:
    """Stretches copied to the time buckets they cover; a record meets those of its own bucket."""
    return sessions.withColumn("_bucket", F.explode(F.sequence(floor_div(low, width), floor_div(high, width))))


def _covering(points: DataFrame, sessions: DataFrame, at: str, low: str, high: str, width: int, how: str) -> DataFrame:
    """``points`` with the stretch of their key (columns ``low``, ``high``) that holds their time."""
    s = _spread(sessions.select(F.col("key").alias("_key"), low, high), low, high, width)
    p = points.withColumn("_b", floor_div(at, width))
    return p.join(s, (p["key"] == s["_key"]) & (p["_b"] == s["_bucket"]) & (p[at] >= s[low]) & (p[at] <= s[high]),
                  how).drop("_key", "_bucket", "_b")


def replay_stretch(start: np.ndarray, end: np.ndarray, v: np.ndarray, close: np.ndarray, n: int, gap: int) -> tuple:
    """(start, end, v) of a stretch's sessions, which the first ``n`` entries are, after its late records, the
    entries from ``n`` on in arrival order."""
    there = np.arange(len(start)) < n
    for k in range(n, len(start)):
        ms, value, until = int(start[k]), int(v[k]), int(close[k])
        near = there & (start <= ms + gap) & (end >= max(ms - gap, until))
        if near.any():
            at = int(np.flatnonzero(near)[0])
            low, high, whole = min(ms, int(start[near].min())), max(ms, int(end[near].max())), value + int(v[near].sum())
            there &= ~near
            start[at], end[at], v[at], there[at] = low, high, whole, True
        elif ms >= until:
            there[k] = True  # a session of its own
    return start[there], end[there], v[there]


def _replayed(rows: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Whole stretches, one after the other."""
    key, low = rows["key"].to_numpy(), rows["low"].to_numpy(np.int64)
    start, end, v, close = (rows[c].to_numpy(np.int64, copy=True) for c in ("window_start", "window_end", "v", "close"))
    late = rows["late"].to_numpy(bool)
    cuts = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1])) + 1
    keys, out = [], []
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
        n = int((~late[a:b]).sum())
        out.append(replay_stretch(start[a:b], end[a:b], v[a:b], close[a:b], n, gap))
        keys += [key[a]] * len(out[-1][0])
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pd.DataFrame({"key": pd.Series(keys, dtype=object), **dict(zip(("window_start", "window_end", "v"), columns, strict=True))})


def replay_in_order(batches: Iterator[pd.DataFrame], gap: int) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by stretch; the last stretch of a batch waits for the next one."""
    held = None
    for rows in batches:
        rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
        if rows.empty:
            continue
        last = (rows["key"] == rows["key"].iloc[-1]) & (rows["low"] == rows["low"].iloc[-1])
        held = rows[last]
        if not last.all():
            yield _replayed(rows[~last], gap)
    if held is not None:
        yield _replayed(held, gap)


def late_drop_session(df: DataFrame, gap_ms: int, grace_ms: int, arrival: Column, tiebreak: Column,
                      source_partition: Column | None = None, kind: str = COUNT,
                      chunk_rows: int = 1 << 20) -> DataFrame:
    """Sessions (key, window_start, window_end, cnt or total) without the records that came too late."""
    ship_package(df.sparkSession)
    gap, grace, name = int(gap_ms), int(grace_ms), _NAMES[kind]
    width = max(4 * gap, 1)
    keyed = windows._keyed(df, kind, skip_null_values=False)
    # three branches read the records with their stream time, several what comes of them
    x = materialised(_timed(keyed, arrival, tiebreak, source_partition, chunk_rows).select(
        "key", "value", "ms", "stream_time", "_a", "_t"), "late-timed")
    on_time = F.col("ms") >= F.col("stream_time") - F.lit(grace)
    bounds = ["key", "window_start", "window_end"]
    given = materialised(windows.partial_sessions(x.filter(on_time), gap).select(*bounds, F.col(name).alias("v")), "late-given")
    value = F.lit(1).cast("bigint") if kind == COUNT else F.col("value").cast("bigint")
    late = x.filter(~on_time).select("key", "ms", value.alias("v"), (F.col("stream_time") - F.lit(grace + gap)).alias("close"),
                                     F.col("_a").alias("arrived"), F.col("_t").alias("tie"))

    stretches = windows.partial_sessions(x, gap).select("key", F.col("window_start").alias("low"),
                                                        F.col("window_end").alias("high"))
    late = _covering(late, stretches, "ms", "low", "high", width, "inner")
    late = materialised(_covering(late, given, "ms", "window_start", "window_end", width, "left"), "late-records")
    between = late.filter("window_start is null")
    inside = late.filter("window_start is not null")
    joined = (inside.filter("window_end >= close").groupBy("key", "window_start").agg(F.sum("v").alias("_more")))
    undecided = inside.filter("window_end < close and high >= close")
    replayed = between.select("key", "low", "high").distinct()

    given = given.join(joined, ["key", "window_start"], "left").select(
        *bounds, (F.col("v") + F.coalesce("_more", F.lit(0))).alias("v"))
    given = _covering(given, replayed, "window_start", "low", "high", width, "left")
    rows = ["key", "low", "window_start", "window_end", "v", "close", "arrived", "tie", "late"]
    nothing = F.lit(0).cast("bigint")
    sessions = given.filter("low is not null").select(
        "key", "low", "window_start", "window_end", "v", nothing.alias("close"), nothing.alias("arrived"),
        nothing.alias("tie"), F.lit(False).alias("late"))
    come = between.unionByName(undecided.join(replayed.select("key", "low"), ["key", "low"], "left_semi").select(between.columns))
    come = come.select("key", "low", F.col("ms").alias("window_start"), F.col("ms").alias("window_end"), "v", "close",
                       "arrived", "tie", F.lit(True).alias("late"))

    schema = f"key {df.schema['key'].dataType.simpleString()}, window_start long, window_end long, v long"
    # a stretch's sessions, then its late records in arrival order; a task goes through its stretches one by one
    after = (sessions.select(rows).unionByName(come.select(rows)).repartition("key", "low")
             .sortWithinPartitions("key", "low", "late", "arrived", "tie")
             .mapInPandas(lambda batches: replay_in_order(batches, gap), schema))
    return (given.filter("low is null").select(*bounds, "v").unionByName(after)
            .select(*bounds, F.col("v").cast("bigint").alias(name)))


def late_drop_sliding(df: DataFrame, diff_ms: int, grace_ms: int, arrival: Column, tiebreak: Column,
                      source_partition: Column | None = None, kind: str = COUNT, bucket_ms: int | None = None,
                      chunk_rows: int = 1 << 20) -> DataFrame:
    """Sliding windows (key, window_start, window_end, cnt or total), each without the records too late for it."""
    d = int(diff_ms)
    width = windows.sliding_width(d, bucket_ms)
    keyed = windows._keyed(df, kind, skip_null_values=True)
    x = _timed(keyed, arrival, tiebreak, source_partition, chunk_rows)
    since = F.greatest(F.col("ms"), F.col("stream_time") - F.lit(int(grace_ms)) + 1)
    value = F.lit(None).cast("bigint") if kind == COUNT else F.col("value")
    gone = F.col("ms") + F.lit(d + 1)
    # with ``since = ms + d + 1`` a record counts in no window, but its right window was still open
    pts = (x.withColumn("since", since).filter(F.col("since") <= gone).groupBy("key", "ms", "since")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("bigint").alias("v")))
    leaves = pts.groupBy("key", "ms").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    steps = pts.select("key", "ms", F.col("since").alias("at"), (F.col("since") == F.col("ms")).alias("left"),
                       F.lit(False).alias("right"), "n", "v").unionByName(
        leaves.select("key", "ms", gone.alias("at"), F.lit(False).alias("left"), F.lit(True).alias("right"),
                      (-F.col("n")).alias("n"), (-F.col("v")).alias("v")))
    steps = windows.with_halo(steps, d, width)
    part = Window.partitionBy("key", "bucket").orderBy("at")
    so_far = part.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = part.rangeBetween(Window.currentRow, Window.currentRow)
    name = _NAMES[kind]
    y = (steps.withColumn("held", F.sum("n").over(so_far)).withColumn("point", F.max("left").over(here)))
    y = y.withColumn(name, F.col("held") if kind == COUNT else F.sum("v").over(so_far))
    owner = F.col("own") & (F.col("left") | (F.col("right") & (F.col("held") > 0) & ~F.col("point")))
    return y.filter(owner).select("key", (F.col("at") - F.lit(d)).alias("window_start"), F.col("at").alias("window_end"),
                                  F.col(name).cast("bigint").alias(name))
