"""Sessions and sliding windows under the exact late rule, and store-wide flushes, against a replay."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import records
from keyflow.operators import late, punctuation, windows


def found(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def disorder(seed, n=260, keys="abc", span=6000, spread=900):
    rnd = random.Random(seed)
    rows, at = [], 0
    for _ in range(n):
        at += rnd.choice([0, 1, 5, 30, 30, 200])
        rows.append((rnd.choice(keys), max(0, at - rnd.choice([0, 0, 0, 10, 150, spread, 3 * spread])), rnd.randrange(1, 9)))
    return rows


def sessions_replay(rows, gap, grace):
    open_, st = {}, None
    for key, ms, v in rows:
        st = ms if st is None else max(st, ms)
        close = st - grace - gap
        every = open_.setdefault(key, [])
        near = [s for s in every if s[0] <= ms + gap and s[1] >= ms - gap and s[1] >= close]
        if not near and ms < close:
            continue
        open_[key] = [s for s in every if s not in near] + [
            (min([ms, *(s[0] for s in near)]), max([ms, *(s[1] for s in near)]), v + sum(s[2] for s in near))]
    return sorted((k, *s) for k, ss in open_.items() for s in ss)


@pytest.mark.parametrize("seed,gap,grace", [(1, 40, 100), (2, 100, 0), (3, 20, 300), (4, 300, 50), (5, 1, 1)])
def test_late_sessions_against_a_replay(spark, seed, gap, grace):
    rows = disorder(seed)
    df = records(spark, rows)
    got = late.late_drop_session(df, gap, grace, F.col("seq"), F.col("seq"), kind=windows.SUM, chunk_rows=32)
    want = sessions_replay(rows, gap, grace)
    assert found(got, "key", "window_start", "window_end", "total") == want
    assert sum(w[3] for w in want) < sum(r[2] for r in rows)
    count = late.late_drop_session(df, gap, grace, F.col("seq"), F.col("seq"))
    assert found(count, "key", "window_start", "window_end", "cnt") == sessions_replay(
        [(k, m, 1) for k, m, _ in rows], gap, grace)


def test_late_sessions_across_batches_of_rows(spark):
    rows = disorder(9, n=400, keys="ab")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = late.late_drop_session(records(spark, rows), 60, 60, F.col("seq"), F.col("seq"))
        assert found(got, "key", "window_start", "window_end", "cnt") == sessions_replay(
            [(k, m, 1) for k, m, _ in rows], 60, 60)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_late_record_gives_ordinary_sessions(spark):
    rows = disorder(6)
    df = records(spark, [(k, m, None if i % 7 == 0 else v) for i, (k, m, v) in enumerate(rows)] + [(None, 5, 1)])
    got = late.late_drop_session(df, 50, 10 ** 9, F.col("seq"), F.col("seq"))
    assert found(got, "key", "window_start", "cnt") == found(windows.session(df, 50), "key", "window_start", "cnt")


@pytest.mark.parametrize("seed,d,grace,bucket", [(1, 100, 0, None), (2, 60, 200, 61), (3, 300, 50, 5000)])
def test_late_sliding_windows_by_definition(spark, seed, d, grace, bucket):
    rows = disorder(seed, n=200)
    st, timed = None, []
    for key, ms, v in rows:
        st = ms if st is None else max(st, ms)
        timed.append((key, ms, v, st))
    want = {}
    starts = {(k, m - d) for k, m, _, s in timed if m + grace > s} | {(k, m + 1) for k, m, _, s in timed if m + 1 + d + grace > s}
    for k, a in starts:
        held = [v for kk, m, v, s in timed if kk == k and a <= m <= a + d and a + d + grace > s]
        if held:
            want[k, a, a + d] = (len(held), sum(held))
    df = records(spark, rows)
    for kind, name, i in ((windows.COUNT, "cnt", 0), (windows.SUM, "total", 1)):
        got = late.late_drop_sliding(df, d, grace, F.col("seq"), F.col("seq"), kind=kind, bucket_ms=bucket, chunk_rows=32)
        assert found(got, "key", "window_start", "window_end", name) == sorted((*k, v[i]) for k, v in want.items())


def flush_replay(rows, tick, kind, store=()):
    """(partition, key, value, ms) in arrival order -> rows of every flush."""
    state, st, out = {}, {}, []
    for part, key, value in store:
        state[part, key] = value
    for part, key, value, ms in rows:
        before = st.get(part)
        st[part] = ms if before is None else max(before, ms)
        if key is not None and value is not None:
            old = state.get((part, key))
            state[part, key] = value if old is None else max(old, value) if kind == "max" else old + value
        if before is None or st[part] // tick > before // tick:
            out += [(p, k, v, st[part]) for (p, k), v in state.items() if p == part]
    return sorted(out)


@pytest.mark.parametrize("chunk", [1, 2, 7, 4096])
def test_flushes_send_the_whole_store(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.randrange(2), rnd.choice(["a", "b", "c", None]), rnd.choice([None, 1, 4, 9, 20]), m)
            for _, m, _ in disorder(chunk + 20, n=220)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "src int, key string, value bigint, ms bigint, seq bigint")
    store = [(0, "a", 12), (0, "z", 3), (1, "y", 100)]
    seeds = spark.createDataFrame(store, "partition int, key string, value bigint")
    got = punctuation.max_flush_all(df, 500, F.col("seq"), F.col("seq"), F.col("src"), seeds, chunk_rows=16, chunk=chunk)
    assert found(got, "partition", "key", "value", "stream_time") == flush_replay(rows, 500, "max", store)


def test_flush_reference_cases(spark):
    """One partition, max: smaller value keeps the seed; ticks at the 1st, 2nd and 4th record; equal times once."""
    def run(times, value=1, seed=21):
        df = records(spark, [("a", t, value) for t in times])
        seeds = spark.createDataFrame([(0, "a", seed)], "partition int, key string, value bigint")
        return found(punctuation.max_flush_all(df, 10_000, F.col("seq"), F.col("seq"), store=seeds), "key", "value", "stream_time")
    t = 1_700_000_000_000
    assert run([t]) == [("a", 21, t)]
    assert run([t], 42) == [("a", 42, t)]
    assert run([t, t + 15_000, t, t + 30_000]) == [("a", 21, t), ("a", 21, t + 15_000), ("a", 21, t + 30_000)]
    assert run([t] * 4) == [("a", 21, t)]
