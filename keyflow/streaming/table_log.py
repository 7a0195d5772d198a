"""A keyed table that micro-batches keep in the shared folder: snapshots and deltas by bucket of keys.

A batch appends the rows it changes as a delta, parted into buckets by the hash
of the key, and reads only the buckets of the keys it asks for: a bucket's last
snapshot and the deltas since. Where those hold as many rows as the snapshot, or
are many, the bucket is compacted: its newest live rows become the snapshot. So
what a batch reads is bounded by twice the table's live rows in the buckets it
touches, however many batches came before.

Which parts a bucket consists of is a small table (a row per part) that each
batch writes anew. A batch reads what the batch before it left and writes to
folders of its own, so a retried batch overwrites its own work only. Parts that
no later batch lists are of no use any more and may be deleted by age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.streaming.runner import NO_BATCH

PARTS = "bucket int, batch_id int, kind string, n long"
DELTA, SNAPSHOT = "delta", "snapshot"
BUCKETS = 32
MOST_DELTAS = 8


def newest_by(keys: list[str], order: str) -> Callable[[DataFrame], DataFrame]:
    """The row with the largest ``order`` per key, combined map-side."""
    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        top = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
        return top.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)
    return newest


class TableLog:
    """Rows of ``schema``; ``keys`` part them into buckets, ``newest`` reduces the parts of a bucket to its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str],
                 newest: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS):
        self.path, self.schema, self.keys, self.newest = path, schema, keys, newest
        self.buckets, self.most_deltas = int(buckets), int(most_deltas)
        self.rows_read = 0  # of the last read, from the list of parts
        spark.createDataFrame([], PARTS).write.mode("overwrite").parquet(f"{path}/parts/batch_id={NO_BATCH}")

    def bucket(self, keys: list[str] | None = None) -> Column:
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.buckets)).cast("int")

    def _parts(self, spark: SparkSession, batch_id: int) -> list:
        """The list that the batch before ``batch_id`` left: a few rows for each bucket."""
        return spark.read.schema(PARTS).parquet(f"{self.path}/parts/batch_id={batch_id - 1}").collect()

    def _load(self, spark: SparkSession, parts: list) -> DataFrame:
        paths = [f"{self.path}/{p.kind}/batch_id={p.batch_id}/bucket={p.bucket}" for p in parts]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def read(self, spark: SparkSession, batch_id: int, asked: DataFrame | None = None) -> DataFrame:
        """The table as the batches before ``batch_id`` left it; with ``asked`` (the key columns), the
        rows of those keys only, from their buckets only."""
        parts = self._parts(spark, batch_id)
        if asked is not None:
            asked = asked.select(*self.keys).distinct()
            # at most as many rows as there are buckets
            touched = {r[0] for r in asked.select(self.bucket()).distinct().collect()}
            parts = [p for p in parts if p.bucket in touched]
        self.rows_read = sum(p.n for p in parts)
        rows = self._load(spark, parts)
        if asked is not None:
            rows = rows.join(asked, self.keys, "left_semi")
        return self.newest(rows)

    def added(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that ``append`` added in this batch."""
        return spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.path}/{DELTA}/batch_id={batch_id}").drop("bucket")

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> list:
        path = f"{self.path}/{kind}/batch_id={batch_id}"
        names = self._load(rows.sparkSession, []).columns
        # about a file for each bucket; a large one is split
        (rows.select(*names, self.bucket().alias("bucket")).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))
        many = rows.sparkSession.read.schema(f"{self.schema}, bucket int").parquet(path).groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"))
        return [(r.bucket, batch_id, kind, r.n) for r in many.collect()]

    def append(self, batch_id: int, rows: DataFrame, live: Column | None = None) -> None:
        """Add what the batch changes, and compact buckets with many deltas; of these only ``live`` rows stay."""
        spark = rows.sparkSession
        parts = [tuple(p) for p in self._parts(spark, batch_id)] + self._write(rows, DELTA, batch_id)
        sizes: dict[int, dict[str, list[int]]] = {}
        for bucket, _, kind, n in parts:
            sizes.setdefault(bucket, {DELTA: [], SNAPSHOT: []})[kind].append(n)
        full = {b for b, s in sizes.items()
                if len(s[DELTA]) > self.most_deltas or len(s[DELTA]) > 1 and sum(s[DELTA]) > sum(s[SNAPSHOT])}
        if full:
            old = [p for p in parts if p[0] in full]
            listed = spark.createDataFrame(old, PARTS).collect()
            merged = self.newest(self._load(spark, listed))
            parts = [p for p in parts if p[0] not in full] + self._write(
                merged if live is None else merged.filter(live), SNAPSHOT, batch_id)
        spark.createDataFrame(parts, PARTS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/parts/batch_id={batch_id}")
