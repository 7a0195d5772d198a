"""Stream–stream interval joins (inner, left, full outer), batch form.

``|left.ms - right.ms| <= bound`` on equal keys, both ends inclusive; null
keys never join (and are not emitted as unmatched either). Every matching
pair is emitted (duplicates kept).

Plan: an equi-join on ``(key, time bucket)`` of width ``bound``. Each left
record sits once, in the bucket of its own time; each right record is copied
into every bucket whose left records it can match (two or three). A hot key
is thereby split across its buckets and only near pairs are ever compared.
Because a left record appears once together with all its candidates, a
LEFT OUTER join on that layout is exactly the left interval join (pairs plus
left-only rows) in one pass. A FULL OUTER join on it also gives the copies of
right records that met no left record in their bucket; a right record is alone
if all its copies are, which a count of the unmatched copies tells. Both sides
are read and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import joiner_text
from keyflow.functions.time import floor_div

INNER, LEFT, FULL = "inner", "left", "full"


def _side(df: DataFrame, p: str) -> DataFrame:
    return df.filter(F.col("key").isNotNull()).select(
        F.col("key").alias(f"{p}key"), F.col("seq").alias(f"{p}seq"),
        F.col("ms").alias(f"{p}ms"), F.col("value").alias(f"{p}value"))


def _own_bucket(df: DataFrame, ms: str, width: int) -> DataFrame:
    return df.withColumn("bucket", floor_div(ms, width))


def _near_buckets(df: DataFrame, ms: str, bound: int, width: int) -> DataFrame:
    return df.withColumn("bucket", F.explode(F.sequence(
        floor_div(F.col(ms) - F.lit(bound), width), floor_div(F.col(ms) + F.lit(bound), width))))


PAIR = ["key", "l_seq", "r_seq", "l_ms", "r_ms", "l_value", "r_value"]


def alone_right(copies: DataFrame, bound: int, width: int) -> DataFrame:
    """Right records (``PAIR`` columns) all of whose copies are among the unmatched ``copies`` (PAIR and bucket).

    Equal records are told apart by number only: each has one copy in its first bucket.
    """
    first, last = (floor_div(F.col("r_ms") + F.lit(side), width) for side in (-bound, bound))
    rest = [F.first(c).alias(c) for c in ("l_seq", "l_ms", "l_value")]  # nulls, so that both branches read the same columns
    many = copies.groupBy("key", "r_seq", "r_ms", "r_value").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("bucket") == first).alias("_equal"), *rest)
    whole = many.filter((F.col("_equal") > 0) & (F.col("_n") == F.col("_equal") * (last - first + 1)))
    return whole.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_equal")))).select(*PAIR)


def joined_text(pairs: DataFrame, joiner) -> DataFrame:
    return pairs.select("key", F.col("l_seq").alias("left_seq"), F.col("r_seq").alias("right_seq"),
                        F.col("l_ms").alias("left_ms"), F.col("r_ms").alias("right_ms"),
                        joiner(F.col("l_value"), F.col("r_value")).alias("value"))


def interval_join(left: DataFrame, right: DataFrame, bound_ms: int, how: str = INNER,
                  joiner=joiner_text, bucket_ms: int | None = None) -> DataFrame:
    bound = int(bound_ms)
    width = int(bucket_ms) if bucket_ms else max(bound, 1)
    lo = _own_bucket(_side(left, "l_"), "l_ms", width)
    rn = _near_buckets(_side(right, "r_"), "r_ms", bound, width)
    cond = ((lo["l_key"] == rn["r_key"]) & (lo["bucket"] == rn["bucket"])
            & (F.abs(lo["l_ms"] - rn["r_ms"]) <= F.lit(bound)))
    joined = lo.join(rn, cond, how).select(
        F.coalesce("l_key", "r_key").alias("key"), *PAIR[1:], rn["bucket"].alias("bucket"), F.col("l_key").isNull().alias("_copy"))
    out = joined.filter(~F.col("_copy")).select(*PAIR)
    if how == FULL:
        out = out.unionByName(alone_right(joined.filter("_copy"), bound, width))
    return joined_text(out, joiner)
