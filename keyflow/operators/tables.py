"""Changelog tables: latest value per key, deletes, add/subtract aggregation,
replicated-table lookups and foreign-key joins.

A changelog is a record frame whose newest ``value`` per ``key`` (by ``seq``)
is the current row; a ``null`` value deletes the key. Batch form: one
partial-aggregatable ``max_by`` per key. Stream form: ``keyflow.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import joiner_text

def tombstone(df: DataFrame, when: Column) -> DataFrame:
    """Turn matching records into deletes (value → null)."""
    return df.withColumn("value", F.when(when, F.lit(None)).otherwise(F.col("value")))


def table_latest(changelog: DataFrame, keep_deleted: bool = False) -> DataFrame:
    """Current table state: newest value per key; deleted keys dropped.

    ``max_by(value, seq)`` keeps a null value at the largest seq (a delete),
    and is a declarative aggregate, so a hot key is combined map-side.
    """
    latest = (changelog.filter(F.col("key").isNotNull())
              .groupBy("key")
              .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")))
    return latest if keep_deleted else latest.filter(F.col("value").isNotNull())


def table_agg_add_subtract(changelog: DataFrame, group_key: Column | None = None) -> DataFrame:
    """Table re-group + ``aggregate(() -> 0, adder, subtractor)``.

    Each key contributes its current value to its group: adder on insert,
    subtractor of the old value on update/delete, from the group it was in.
    ``group_key`` (over ``key`` and ``value``) may follow the value, so a key
    can move. Recomputed from state: a group is the sum of the live values of
    its present members; a group that had a member once and has none now stays
    with 0; a key that never had a non-null value makes no group.
    """
    g = F.col("key") if group_key is None else group_key
    seen = (changelog.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
            .select(g.alias("group")).filter(F.col("group").isNotNull()).distinct())
    live = table_latest(changelog).select(g.alias("group"), "value").groupBy("group").agg(
        F.sum("value").cast("bigint").alias("total"))
    return (seen.join(live, "group", "left")
            .select(F.col("group").alias("key"), F.coalesce("total", F.lit(0)).cast("bigint").alias("total")))


def global_table_lookup(stream: DataFrame, table: DataFrame, lookup_key: Column, how: str = "left") -> DataFrame:
    """Stream-to-replicated-table lookup (GlobalKTable join).

    ``table`` is the current state of a changelog (``key, value``). A plain
    equi-join: Spark replicates the table below its byte threshold
    (``spark.sql.autoBroadcastJoinThreshold``, or at run time from the real
    size) and shuffles above it.
    """
    right = table.select(F.col("key").alias("_tkey"), F.col("value").alias("table_value"))
    joined = stream.withColumn("_lk", lookup_key).join(
        right, F.col("_lk") == F.col("_tkey"), how)
    return joined.drop("_tkey").withColumnRenamed("_lk", "lookup_key")


def fk_join(left: DataFrame, right: DataFrame, fk=lambda v: v.cast("string"), joiner=joiner_text,
            left_is_snapshot: bool = False, right_is_snapshot: bool = False) -> DataFrame:
    """Table–table foreign-key inner join, result keyed by the left key.

    ``fk`` maps the left value column to the foreign key (default
    ``String.valueOf``); it must equal the right key. Both sides are reduced to their current rows first unless
    declared snapshots (one row per key already, e.g. a dimension table).
    The join is a plain equi-join: Catalyst/AQE choose broadcast or
    sort-merge from sizes.
    """
    lt = left if left_is_snapshot else table_latest(left)
    rt = right if right_is_snapshot else table_latest(right)
    lt = lt.select(F.col("key").alias("lkey"), F.col("value").alias("lvalue"))
    lt = lt.withColumn("fk", fk(F.col("lvalue")))
    rt = rt.select(F.col("key").alias("rkey"), F.col("value").alias("rvalue"))
    j = lt.join(rt, lt["fk"] == rt["rkey"], "inner")
    return j.select(F.col("lkey").alias("key"), joiner(F.col("lvalue"), F.col("rvalue")).alias("value"))
