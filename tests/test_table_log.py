"""The table log against a dictionary, and what its batches read."""

import random
import tempfile

from pyspark.sql import functions as F

from conftest import records  # noqa: F401 - the session fixture's module
from keyflow.streaming.table_log import TableLog, newest_by


def test_against_a_dictionary_and_bounded_reads(spark):
    rng = random.Random(11)
    log = TableLog(spark, tempfile.mkdtemp(prefix="kf-log-", dir="/tmp"), "key string, value long, seq long", ["key"],
                   newest_by(["key"], "seq"), buckets=4, most_deltas=4)
    want, read = {}, []
    for batch in range(14):
        rows = {f"k{rng.randrange(24)}": (rng.choice([None, rng.randrange(99)]), batch) for _ in range(12)}
        df = spark.createDataFrame([(k, v, s) for k, (v, s) in rows.items()], "key string, value long, seq long")
        asked = log.read(spark, batch, df)
        read.append(log.rows_read)
        got = {r.key: (r.value, r.seq) for r in asked.collect() if r.value is not None}
        assert got == {k: v for k, v in want.items() if k in rows and v[0] is not None}
        log.append(batch, df, F.col("value").isNotNull())
        want.update(rows)
    whole = {r.key: (r.value, r.seq) for r in log.read(spark, 14).collect() if r.value is not None}
    assert whole == {k: v for k, v in want.items() if v[0] is not None}
    # live rows twice, and the newest delta of each bucket
    assert max(read[4:]) <= 2 * 24 + 12
    # the view of an earlier batch stays as it was, for a retry
    assert log.read(spark, 3).count() <= 24


def test_a_batch_reads_the_buckets_it_touches(spark):
    log = TableLog(spark, tempfile.mkdtemp(prefix="kf-log-", dir="/tmp"), "key bigint, seq bigint", ["key"],
                   newest_by(["key"], "seq"), buckets=16)
    log.append(0, spark.range(1600).select(F.col("id").alias("key"), F.lit(0).cast("bigint").alias("seq")))
    one = spark.createDataFrame([(7,)], "key bigint")
    assert [tuple(r) for r in log.read(spark, 1, one).collect()] == [(7, 0)]
    assert 50 < log.rows_read < 160
    assert log.read(spark, 1, one.limit(0)).collect() == [] and log.rows_read == 0


def test_a_retried_batch_overwrites_its_own_work(spark):
    log = TableLog(spark, tempfile.mkdtemp(prefix="kf-log-", dir="/tmp"), "key string, seq long", ["key"],
                   newest_by(["key"], "seq"), buckets=2)
    rows = lambda *r: spark.createDataFrame(list(r), "key string, seq long")
    log.append(0, rows(("a", 1), ("b", 1)))
    log.append(1, rows(("a", 5), ("c", 5)))  # a first attempt that did not commit
    log.append(1, rows(("b", 2)))
    assert sorted(tuple(r) for r in log.read(spark, 2).collect()) == [("a", 1), ("b", 2)]
