"""Stateless record operators: re-key, map, flat-map, filter, branch, tap.

All are narrow transformations (no shuffle) except ``repartition_by_key``.
Predicates and mappers are ``Column`` expressions, so Catalyst can push
filters to the scan and fuse everything into one codegen stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keyflow.functions.text import key_chars_upper

# Fixed values of the reference's branch operator: predicates in order,
# first match wins, default branch last; 25 and 50 units, values are in cents.
BRANCHES = (("lt-25", 2500), ("lt-50", 5000))
DEFAULT_BRANCH = "unfiltered"
# Fixed value: flatMapValues multiplies by 10^i for i = 1..3.
SCALE_EXPONENTS = (1, 3)


def select_key(df: DataFrame, key_expr: Column) -> DataFrame:
    """Re-key every record (``selectKey``); value and time unchanged."""
    return df.withColumn("key", key_expr)


def map_values(df: DataFrame, value_expr: Column) -> DataFrame:
    """``mapValues``: replace the value, key untouched (no repartition needed)."""
    return df.withColumn("value", value_expr)


def filter_records(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def flat_map_key_chars(df: DataFrame) -> DataFrame:
    """One record per character of the key, upper-cased; value kept.

    The key changes, so a downstream keyed operator shuffles on the new key.
    """
    return (df.withColumn("key", F.explode(key_chars_upper("key")))
            .filter(F.col("key") != ""))


def flat_map_values_scale(df: DataFrame) -> DataFrame:
    """Each value v becomes 10·v, 100·v, 1000·v (double product → long).

    Key unchanged, so the frame keeps its partitioning for a following
    ``groupBy(key)``.
    """
    lo, hi = SCALE_EXPONENTS
    scaled = F.transform(
        F.sequence(F.lit(lo), F.lit(hi)),
        lambda i: (F.pow(F.lit(10.0), i) * F.col("value")).cast("bigint"))
    return df.withColumn("value", F.explode(scaled))


def branch_label(df: DataFrame, branches: Sequence[tuple[str, int]] = BRANCHES,
                 default: str = DEFAULT_BRANCH) -> DataFrame:
    """Label each record with the first branch whose ``value < bound`` holds.

    A null value matches no predicate and falls to the default branch.
    """
    label = None
    for name, bound in branches:
        cond = F.col("value") < F.lit(bound)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return df.withColumn("branch", label.otherwise(F.lit(default)))


def split_branches(df: DataFrame, branches: Sequence[tuple[str, int]] = BRANCHES,
                   default: str = DEFAULT_BRANCH, prefix: str = "Branch-") -> dict[str, DataFrame]:
    """``split().branch().defaultBranch()``: one filtered frame per branch.

    The label is computed once; each branch is a filter over it. Several
    sinks over the branches re-read the source unless the caller caches
    (batch) or writes them in one ``foreachBatch`` (stream).
    """
    labelled = branch_label(df, branches, default)
    names = [n for n, _ in branches] + [default]
    return {f"{prefix}{n}": labelled.filter(F.col("branch") == n).drop("branch") for n in names}


def repartition_by_key(df: DataFrame, num_partitions: int) -> DataFrame:
    """Explicit re-partition into a fixed number of hash partitions by key."""
    return df.repartition(num_partitions, "key")


TAP_SCHEMA = "records bigint, max_value bigint, max_ms bigint"


def observe_tap(df: DataFrame, name: str = "tap") -> tuple[DataFrame, Observation]:
    """Side-effect tap (``peek``/logging processor) as metrics, not prints.

    Rows pass through unchanged; count, max value and max event time are
    gathered by the same job that consumes the rows (batch: ``Observation``;
    stream: ``query.lastProgress['observedMetrics']``).
    """
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("records"),
                     F.max("value").alias("max_value"), F.max("ms").alias("max_ms"))
    return out, obs


def observe_stream(df: DataFrame, name: str = "tap") -> DataFrame:
    """Streaming form of the tap: metrics land in the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("records"),
                      F.max("value").alias("max_value"), F.max("ms").alias("max_ms"))
