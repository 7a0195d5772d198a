import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, records
from keyflow.operators import windows
from keyflow.operators.joins import FULL, INNER, LEFT, interval_join
from keyflow.sources.records import event_records


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_none_first)


def _none_first(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def test_session_inclusive_gap_ends_at_last_record(spark):
    df = records(spark, [("a", 1000, 1), ("a", 1300, 1), ("a", 1601, 1)])
    out = windows.session(df, 300)
    assert rows(out, "window_start", "window_end", "cnt") == [(1000, 1300, 2), (1601, 1601, 1)]


def test_hopping_size_not_multiple_of_advance(spark):
    out = windows.hopping(records(spark, [("a", 1250, 1)]), 300, 200)
    assert rows(out, "window_start", "window_end") == [(1000, 1300), (1200, 1500)]
    out = windows.hopping(records(spark, [("a", 1350, 1)]), 300, 200)
    assert rows(out, "window_start", "window_end") == [(1200, 1500)]


SLIDING_IN = [("a", 1000, 1), ("a", 1100, 2), ("a", 1301, 4), ("a", 2000, 8)]
SLIDING_OUT = [(700, 1000, 1, 1), (800, 1100, 2, 3), (1001, 1301, 2, 6), (1101, 1401, 1, 4), (1700, 2000, 1, 8)]


@pytest.mark.parametrize("bucket", [None, 301, 700, 1000])
def test_sliding_windows(spark, bucket):
    df = records(spark, SLIDING_IN)
    c = windows.sliding(df, 300, windows.COUNT, bucket_ms=bucket)
    s = windows.sliding(df, 300, windows.SUM, bucket_ms=bucket)
    got = sorted((a.window_start, a.window_end, a.cnt, b.total)
                 for a, b in zip(c.orderBy("window_start").collect(), s.orderBy("window_start").collect()))
    assert got == SLIDING_OUT


def test_sliding_bucket_width_is_invisible(spark):
    recs = event_records(spark, SF_SMALL, key="event_type")
    base = rows(windows.sliding(recs, 3 * 3_600_000, windows.SUM), "key", "window_start", "total")
    narrow = rows(windows.sliding(recs, 3 * 3_600_000, windows.SUM, bucket_ms=3 * 3_600_000 + 1),
                  "key", "window_start", "total")
    assert base == narrow and len(base) > 100


def test_tumbling_count(spark):
    df = records(spark, [("a", 1000, 1), ("a", 1100, 1), ("a", 1250, 1), ("b", 0, 1)])
    out = windows.tumbling(df, 600)
    assert rows(out, "key", "window_start", "window_end", "cnt") == [
        ("a", 600, 1200, 2), ("a", 1200, 1800, 1), ("b", 0, 600, 1)]


def test_late_drop_exact_five_file_case(spark):
    arrivals = [1000, 1100, 2000, 1150, 1700, 5000, 1700, 9000]
    df = records(spark, [("a", ms, 1, i) for i, ms in enumerate(arrivals)])
    out = windows.late_drop_exact(df, 600, 350, F.col("seq"), F.col("seq"))
    assert rows(out, "window_start", "cnt") == [(600, 2), (1200, 1), (1800, 1), (4800, 1), (9000, 1)]


def test_late_drop_chunking_is_invisible(spark):
    recs = event_records(spark, SF_SMALL)
    arrival = F.col("seq") + (F.col("seq") * F.lit(7919)) % F.lit(151)
    a = rows(windows.late_drop_exact(recs, 6 * 3_600_000, 3_600_000, arrival, F.col("seq"), chunk_rows=37),
             "key", "window_start", "cnt")
    b = rows(windows.late_drop_exact(recs, 6 * 3_600_000, 3_600_000, arrival, F.col("seq")),
             "key", "window_start", "cnt")
    assert a == b


def test_interval_join_inner_and_full(spark):
    left = records(spark, [("a", 1000, "u", 1)], value_type="string")
    right = records(spark, [("a", 2500, "d1", 2), ("a", 2501, "d2", 3)], value_type="string")
    inner = interval_join(left, right, 1500, INNER)
    assert rows(inner, "left_ms", "right_ms") == [(1000, 2500)]
    full = interval_join(left, right, 1500, FULL)
    assert sorted(full.select("left_ms", "right_ms", "value").collect(), key=str) == sorted([
        (1000, 2500, "user: u details: d1"), (None, 2501, "user: null details: d2")], key=str)


def test_interval_join_left_unmatched_once(spark):
    left = records(spark, [("a", 0, "x", 1), ("a", 10_000, "y", 2), (None, 5, "z", 3)], value_type="string")
    right = records(spark, [("a", 1, "r", 4)], value_type="string")
    out = interval_join(left, right, 100, LEFT)
    assert rows(out, "left_seq", "right_seq") == [(1, 4), (2, None)]


@pytest.mark.parametrize("bucket", [None, 7, 1000])
def test_interval_join_bucket_width_is_invisible(spark, bucket):
    import random
    rnd = random.Random(7)
    l = records(spark, [(rnd.choice("ab"), rnd.randrange(0, 2000), "l", i) for i in range(60)], value_type="string")
    r = records(spark, [(rnd.choice("ab"), rnd.randrange(0, 2000), "r", 100 + i) for i in range(60)],
                value_type="string")
    got = rows(interval_join(l, r, 50, FULL, bucket_ms=bucket), "left_seq", "right_seq")
    lp = [(x.key, x.ms, x.seq) for x in l.collect()]
    rp = [(x.key, x.ms, x.seq) for x in r.collect()]
    pairs = [(a[2], b[2]) for a in lp for b in rp if a[0] == b[0] and abs(a[1] - b[1]) <= 50]
    lm = {p[0] for p in pairs}
    rm = {p[1] for p in pairs}
    want = sorted(pairs + [(a[2], None) for a in lp if a[2] not in lm]
                  + [(None, b[2]) for b in rp if b[2] not in rm], key=_none_first)
    assert got == want


@pytest.mark.parametrize("bucket", [None, 1, 301, 5000])
def test_session_bucket_width_is_invisible(spark, bucket):
    import random
    rnd = random.Random(3)
    pts = [(rnd.choice("abc"), rnd.randrange(0, 20_000), rnd.randrange(1, 9)) for _ in range(300)]
    df = records(spark, pts)
    got = rows(windows.session(df, 300, windows.SUM, bucket_ms=bucket), "key", "window_start", "window_end", "total")
    want = []
    for k in "abc":
        ev = sorted((ms, v) for kk, ms, v in pts if kk == k)
        cur = None
        for ms, v in ev:
            if cur and ms - cur[1] <= 300:
                cur = [cur[0], ms, cur[2] + v]
            else:
                if cur:
                    want.append((k, *cur))
                cur = [ms, ms, v]
        if cur:
            want.append((k, *cur))
    assert got == sorted(want, key=_none_first)


def test_null_rules(spark):
    from keyflow.operators import aggregates as agg
    df = records(spark, [("a", 1000, 5), ("a", 1100, None), (None, 1200, 7), ("b", 1300, None)])
    assert {r.key: r.cnt for r in agg.count_by_key(df).collect()} == {"a": 1, "b": 0}
    assert {r.key: r.total for r in agg.sum_by_key(df).collect()} == {"a": 5}
    # windowed count skips only null keys; the sliding count also skips null values
    assert rows(windows.tumbling(df, 600), "key", "cnt") == [("a", 2), ("b", 1)]
    assert rows(windows.sliding(df, 300), "key", "window_start", "cnt") == [("a", 700, 1)]
    assert rows(windows.session(df, 300), "key", "cnt") == [("a", 2), ("b", 1)]


def test_late_drop_per_source_partition(spark):
    import random
    rnd = random.Random(11)
    rows_in = [(rnd.choice("xy"), rnd.randrange(0, 5000), 1, i) for i in range(200)]
    df = records(spark, rows_in).withColumn("src", F.when(F.col("key") == "x", 0).otherwise(1))
    out = windows.late_drop_exact(df, 600, 100, F.col("seq"), F.col("seq"), F.col("src"), chunk_rows=16)
    got = rows(out, "key", "window_start", "cnt")
    want = {}
    for src_key in "xy":  # stream time advances per source partition, in arrival order
        st = None
        for k, ms, _v, _seq in rows_in:
            if k != src_key:
                continue
            st = ms if st is None else max(st, ms)
            start = ms // 600 * 600
            if start + 600 + 100 > st:
                want[(k, start)] = want.get((k, start), 0) + 1
    assert got == sorted(((k, s, c) for (k, s), c in want.items()), key=_none_first)
