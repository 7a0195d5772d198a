"""Whole changelogs: one row for every update of a table, not only the newest.

Running values and rows of before are taken per key in arrival order, in chunks
of arrival positions: what the chunks before leave behind is a row per key and
chunk (combined map-side), carried into the next chunk of the key as a row that
comes first. A task never holds more than a chunk of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.functions.time import floor_div

CHUNK = 1 << 16
FIRST = -(1 << 62)     # before every arrival position

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def running_counts(df: DataFrame, keys: list[str], arrival: str = "seq", earlier: DataFrame | None = None,
                   chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``cnt``, the number of records of its key (``keys``) so far, itself included.

    ``arrival`` orders the records; ``earlier`` (keys, cnt) counts those that came before all of them.
    """
    x = df.withColumn("_chunk", floor_div(arrival, chunk)).withColumn("_one", F.lit(1).cast("bigint"))
    many = x.groupBy(*keys, "_chunk").agg(F.sum("_one").alias("_one"))
    if earlier is not None:
        many = many.unionByName(earlier.select(*keys, F.lit(FIRST).alias("_chunk"), F.col("cnt").alias("_one")))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = many.select(*keys, "_chunk", F.coalesce(F.sum("_one").over(before), F.lit(0)).alias("_one"))
    carry = carry.filter(F.col("_chunk") != F.lit(FIRST)).withColumn(arrival, F.lit(FIRST))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(arrival).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = x.unionByName(carry, allowMissingColumns=True).withColumn("cnt", F.sum("_one").over(inside))
    return both.filter(F.col(arrival) != F.lit(FIRST)).drop("_chunk", "_one")


def with_previous(changelog: DataFrame, earlier: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Table updates (key, value, seq) with ``old_value``, the key's value before (null if there was none)."""
    x = changelog.filter(F.col("key").isNotNull()).select("key", "value", "seq")
    x = x.withColumn("_chunk", floor_div("seq", chunk))
    last = x.groupBy("key", "_chunk").agg(F.max_by("value", "seq").alias("value"))
    if earlier is not None:
        last = last.unionByName(earlier.select("key", F.lit(FIRST).alias("_chunk"), "value"))
    carry = last.select("key", "_chunk", F.lag("value").over(Window.partitionBy("key").orderBy("_chunk")).alias("value"))
    carry = carry.filter(F.col("_chunk") != F.lit(FIRST)).withColumn("seq", F.lit(FIRST))
    inside = Window.partitionBy("key", "_chunk").orderBy("seq")
    both = x.unionByName(carry).withColumn("old_value", F.lag("value").over(inside))
    return both.filter(F.col("seq") != F.lit(FIRST)).select("key", "value", "old_value", "seq")


def filter_changelog(updates: DataFrame, predicate: Column) -> DataFrame:
    """The changelog of a filtered table: (key, seq, change, old_value, new_value).

    ``updates`` have both images of a row (``with_previous``); ``predicate`` is over ``key`` and ``value``.
    A row that starts to match is an insert, one that stops (or is deleted) a delete; rows that match
    neither before nor after send nothing.
    """
    def matching(image: str) -> DataFrame:
        return F.col(image).isNotNull() & F.coalesce(F.col(f"_{image}"), F.lit(False))
    # the predicate names ``value``: it is taken over each image in turn
    x = updates.withColumn("_value", predicate)
    x = (x.withColumnsRenamed({"value": "_new", "old_value": "value"}).withColumn("_old_value", predicate)
         .withColumnsRenamed({"value": "old_value", "_new": "value"}))
    new, old = (F.when(matching(c), F.col(c)) for c in ("value", "old_value"))
    x = x.select("key", "seq", old.alias("old_value"), new.alias("new_value"))
    change = (F.when(F.col("old_value").isNull(), F.lit(INSERT)).when(F.col("new_value").isNull(), F.lit(DELETE))
              .otherwise(F.lit(UPDATE)))
    return x.filter("old_value is not null or new_value is not null").select("key", "seq", change.alias("change"),
                                                                             "old_value", "new_value")
