"""Stream-time punctuation over a whole store, batch form.

A processor keeps a store (a value per key) for each source partition and asks
to be called when stream time passes a tick. The record that takes the
partition's stream time into a new tick, whatever its key, makes the store send
every entry on. Ticks are multiples of ``tick`` since the epoch; a record that
crosses several makes one flush, and so does a partition's first record. A
record is in the store before the flush it causes.

Plan, without a range join: stream time is a parallel prefix maximum, so flushes
are the records whose tick differs from the one they met. They are numbered per
partition, in chunks of ticks. What a key changes between two flushes is combined
(map-side) into one row with the number of the first flush that shows it. Running
values are taken per key and chunk of flush numbers, with a carry row where a
chunk starts; each value covers the flushes up to the key's next change, and one
explode over that stretch gives the rows. No task holds more than a chunk of a
key's flushes, and records themselves are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.functions.time import floor_div
from keyflow.operators.windows import running_stream_time

# how changes of a key combine into its value
MAX = "max"
SUM = "sum"
CHUNK = 1 << 12

_COMBINE = {MAX: F.max, SUM: F.sum}


def punctuated(df: DataFrame, tick_ms: int, arrival: Column, tiebreak: Column,
               source_partition: Column | None = None, chunk_rows: int = 1 << 20) -> DataFrame:
    """Records with ``partition``, ``stream_time``, its ``tick``, and whether the record ``fires`` a flush.

    Records without a key move stream time like any other; those without a time do not count.
    """
    src = F.lit(0) if source_partition is None else source_partition
    timed = running_stream_time(df.filter(F.col("ms").isNotNull()).withColumn("partition", src), arrival, tiebreak,
                                F.col("partition"), chunk_rows, before="_met")
    timed = timed.withColumn("tick", floor_div("stream_time", tick_ms))
    return timed.withColumn("fires", F.col("_met").isNull() | (floor_div("_met", tick_ms) < F.col("tick"))).drop("_met")


def numbered_flushes(timed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(partition, tick, stream_time, flush): the flushes of ``punctuated`` records, numbered from 0."""
    fired = timed.filter("fires").select("partition", "tick", "stream_time", floor_div("tick", chunk).alias("_chunk"))
    many = fired.groupBy("partition", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("partition").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    many = many.select("partition", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("partition", "_chunk").orderBy("tick")
    return (fired.withColumn("_at", F.row_number().over(inside) - 1).join(many, ["partition", "_chunk"])
            .select("partition", "tick", "stream_time", (F.col("_before") + F.col("_at")).alias("flush")))


def flush_all(changes: DataFrame, flushes: DataFrame, kind: str = MAX, store: DataFrame | None = None,
              chunk: int = CHUNK) -> DataFrame:
    """What the flushes send: (partition, key, value, stream_time), one row for each flush and live key.

    ``changes`` are rows (partition, key, value, tick, fires) of punctuated records, one or more (or none)
    for a record; rows without key or value change nothing. ``store`` (partition, key, value) is there
    before the first record.
    """
    combine = _COMBINE[kind]
    known = F.col("key").isNotNull() & F.col("value").isNotNull()
    first = F.col("fires").cast("bigint")
    merged = (changes.filter(known).groupBy("partition", "key", "tick", "fires").agg(combine("value").alias("value"))
              .join(flushes.select("partition", "tick", "flush"), ["partition", "tick"], "left")
              # a record that causes a flush is shown by it, all others of its tick by the next; a tick without a
              # flush began before the first record
              .select("partition", "key", F.coalesce(F.col("flush") + 1 - first, F.lit(0)).alias("flush"), "value"))
    if store is not None:
        merged = merged.unionByName(store.filter(known).select("partition", "key", F.lit(0).cast("bigint").alias("flush"), "value"))
    merged = merged.withColumn("_chunk", floor_div("flush", chunk))
    last = flushes.groupBy("partition").agg(F.max("flush").alias("_last"))

    by_chunk = merged.groupBy("partition", "key", "_chunk").agg(combine("value").alias("value")).join(last, "partition")
    order = Window.partitionBy("partition", "key").orderBy("_chunk")
    until = F.coalesce(F.lead("_chunk").over(order), floor_div("_last", chunk))
    so_far = combine("value").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (by_chunk.select("partition", "key", so_far.alias("value"), (F.col("_chunk") + 1).alias("_from"),
                             until.alias("_until"))
             .filter("_from <= _until")
             .select("partition", "key", "value", F.explode(F.sequence("_from", "_until")).alias("_chunk"))
             .withColumn("flush", F.col("_chunk") * F.lit(chunk)))

    rows = merged.unionByName(carry).join(last, "partition")
    inside = Window.partitionBy("partition", "key", "_chunk").orderBy("flush")
    # rows of one flush see each other's values; of them the last one covers what follows
    value = combine("value").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.coalesce(F.lead("flush").over(inside), (F.col("_chunk") + 1) * F.lit(chunk))
    shown = (rows.select("partition", "key", value.alias("value"), F.col("flush").alias("_from"),
                         F.least(following - 1, F.col("_last")).alias("_until"))
             .filter("_from <= _until")
             .select("partition", "key", "value", F.explode(F.sequence("_from", "_until")).alias("flush")))
    return (shown.join(flushes.select("partition", "flush", "stream_time"), ["partition", "flush"])
            .select("partition", "key", F.col("value").cast("bigint").alias("value"), "stream_time"))


def max_flush_all(df: DataFrame, tick_ms: int, arrival: Column, tiebreak: Column,
                  source_partition: Column | None = None, store: DataFrame | None = None,
                  chunk_rows: int = 1 << 20, chunk: int = CHUNK) -> DataFrame:
    """The running maximum of every key, sent on at every flush: (partition, key, value, stream_time)."""
    timed = punctuated(df, tick_ms, arrival, tiebreak, source_partition, chunk_rows)
    return flush_all(timed, numbered_flushes(timed, chunk), MAX, store, chunk)


def word_count_flush_all(df: DataFrame, tick_ms: int, words, arrival: Column, tiebreak: Column,
                         source_partition: Column | None = None, store: DataFrame | None = None,
                         chunk_rows: int = 1 << 20, chunk: int = CHUNK) -> DataFrame:
    """The count of every word, sent on at every flush: (partition, word, count (text), stream_time).

    ``words(frame, keep)`` explodes records into rows with a column ``key`` (the word) and those named in ``keep``.
    """
    timed = punctuated(df, tick_ms, arrival, tiebreak, source_partition, chunk_rows)
    each = words(timed, ["partition", "tick", "fires"]).withColumn("value", F.lit(1).cast("bigint"))
    out = flush_all(each, numbered_flushes(timed, chunk), SUM, store, chunk)
    return out.select("partition", F.col("key").alias("word"), F.col("value").cast("string").alias("count"), "stream_time")
