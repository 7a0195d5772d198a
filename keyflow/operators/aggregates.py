"""Keyed aggregations of record streams.

Sums and counts are declarative aggregates: Catalyst plans a map-side partial
aggregate before the shuffle, so a hot key costs one row per map task, not
one row per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import jvm_tokens
from keyflow.functions.time import floor_div

# Fixed values of the cogroup fold: initial aggregate and per-stream prefixes.
COGROUP_INITIAL = " "
COGROUP_FIRST = " first "
COGROUP_SECOND = " second "


def _no_null_keys(df: DataFrame) -> DataFrame:
    # Keyed aggregations skip records with a null key.
    return df.filter(F.col("key").isNotNull())


def sum_by_key(df: DataFrame, key: Column | None = None) -> DataFrame:
    """``groupBy(..).aggregate(() -> 0, (k, v, agg) -> agg + v)``."""
    df = _no_null_keys(df if key is None else df.withColumn("key", key))
    return (df.filter(F.col("value").isNotNull())
            .groupBy("key").agg(F.sum("value").cast("bigint").alias("total")))


def count_by_key(df: DataFrame, key: Column | None = None) -> DataFrame:
    """``groupByKey().count()`` — null keys and null values are skipped."""
    df = _no_null_keys(df if key is None else df.withColumn("key", key))
    return df.groupBy("key").agg(F.count("value").alias("cnt"))


def filter_counts(counts: DataFrame, predicate: Column) -> DataFrame:
    """Filter over a materialised count table.

    A predicate on the grouping key is pushed below the aggregation (and into
    the parquet scan) by Catalyst.
    """
    return counts.filter(predicate)


def ordered_concat(order_col: str, text_col: str) -> Column:
    items = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t"))))
    return F.array_join(F.transform(items, lambda x: x["t"]), "")


def cogroup_fold_parts(first: DataFrame, second: DataFrame, first_piece: Column, second_piece: Column,
                       chunk_rows: int = 1 << 16) -> DataFrame:
    """The co-grouped fold as ordered parts ``(key, chunk, part)``.

    A part folds the pieces of ``chunk_rows`` arrival positions, so a hot key is
    split over tasks that sort at most so many pieces each; the fold of a key is
    its initial value and its parts in chunk order. The form for keys whose
    whole fold would not fit a row.
    """
    return fold_parts(first.select("key", "seq", first_piece.alias("piece"))
                      .unionByName(second.select("key", "seq", second_piece.alias("piece"))), chunk_rows)


def fold_parts(pieces: DataFrame, chunk_rows: int = 1 << 16) -> DataFrame:
    """Pieces (key, seq, piece) folded per key and chunk of arrival positions."""
    pieces = _no_null_keys(pieces).filter(F.col("piece").isNotNull())
    return (pieces.withColumn("chunk", floor_div("seq", chunk_rows))
            .groupBy("key", "chunk").agg(ordered_concat("seq", "piece").alias("part")))


def cogroup_fold(first: DataFrame, second: DataFrame, first_piece: Column,
                 second_piece: Column, initial: str = COGROUP_INITIAL,
                 chunk_rows: int = 1 << 16) -> DataFrame:
    """Co-grouped string fold of two streams, applied in arrival (``seq``) order.

    ``agg = initial; for each record of either stream in seq order:
    agg = agg + piece``: the parts of ``cogroup_fold_parts``, joined per key. A
    key's result is one string by definition.
    """
    parts = cogroup_fold_parts(first, second, first_piece, second_piece, chunk_rows)
    folded = parts.groupBy("key").agg(ordered_concat("chunk", "part").alias("folded"))
    return folded.select("key", F.concat(F.lit(initial), F.col("folded")).alias("value"))


def word_count(docs: DataFrame, text_col: str = "text", lower: bool = True) -> DataFrame:
    """Lower-case, split on ``\\W+`` with the JVM's token rules, +1 per word.

    ``explode`` keeps the whole text; the per-word count is partially
    aggregated map-side, so frequent words do not skew the shuffle.
    """
    text = F.lower(F.col(text_col)) if lower else F.col(text_col)
    words = jvm_tokens(docs, text, name="word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def tokens(docs: DataFrame, key_col: str, text_col: str = "text") -> DataFrame:
    """(key, token) records of every text, JVM split rule, no case change."""
    keyed = docs.withColumnRenamed(key_col, "key")
    return jvm_tokens(keyed, F.col(text_col), keep=["key"], name="value")
