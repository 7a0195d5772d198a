"""Streaming forms: one file per micro-batch (maxFilesPerTrigger=1)."""

import os
import tempfile
import time

import pandas as pd
import pytest
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from keyflow.operators import aggregates as agg
from keyflow.operators import windows
from keyflow.sources.records import event_records
from keyflow.streaming.processors import MaxProcessor, WALL_CLOCK, max_output_schema, pre_aggregate_max
from keyflow.streaming.runner import newest_per_key, read_changelog, run_stream
from keyflow.streaming.state import read_state

SCHEMA = "key string, value bigint, ms bigint, seq bigint"


def landing_zone(batches):
    """Write each batch as its own parquet file with increasing mtimes."""
    d = tempfile.mkdtemp(prefix="kf-land-", dir="/tmp")
    t0 = time.time() - 1000
    for i, rows in enumerate(batches):
        df = pd.DataFrame(rows, columns=["key", "value", "ms", "seq"]).astype(
            {"value": "Int64", "ms": "int64", "seq": "int64"})
        p = os.path.join(d, f"part-{i:04d}.parquet")
        pq.write_table(pa.Table.from_pandas(df, preserve_index=False), p)
        os.utime(p, (t0 + i, t0 + i))
    return d


def stream_of(spark, path):
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    return s.withColumn("ts", F.timestamp_millis("ms"))


def seeds(spark, pairs):
    return spark.createDataFrame(pairs, "key string, value bigint").groupBy("key")


def run_max(spark, batches, seed_pairs=None, tick=10_000):
    s = stream_of(spark, landing_zone(batches)).select("key", "value", "ms", "seq")
    g = s.groupBy("key")
    proc = MaxProcessor(tick)
    if seed_pairs:
        out = g.transformWithStateInPandas(proc, max_output_schema(), "Append", "None",
                                           initialState=seeds(spark, seed_pairs))
    else:
        out = g.transformWithStateInPandas(proc, max_output_schema(), "Append", "None")
    run = run_stream(out, "test_max")
    return run, run.read(spark).orderBy("stream_time").collect()


T = 1_700_000_000_000


def test_flushes_store_for_first_input(spark):
    _, out = run_max(spark, [[("a", 1, T, 0)]], [("a", 21)])
    assert [(r.key, r.value) for r in out] == [("a", 21)]


def test_larger_value_updates_store(spark):
    run, out = run_max(spark, [[("a", 42, T, 0)]], [("a", 21)])
    assert [(r.key, r.value) for r in out] == [("a", 42)]
    st = read_state(spark, run.checkpoint, state_var="max").collect()
    assert [(r.key, r["max"]) for r in st] == [("a", 42)]


def test_punctuates_when_event_time_advances(spark):
    batches = [[("a", 1, T, 0)], [("a", 1, T + 15_000, 1)], [("a", 1, T, 2)], [("a", 1, T + 30_000, 3)]]
    run, out = run_max(spark, batches, [("a", 21)])
    assert [(r.value, r.stream_time) for r in out] == [(21, T), (21, T + 15_000), (21, T + 30_000)]
    assert len([p for p in run.progress if p["numInputRows"]]) == 4


def test_equal_timestamps_punctuate_once(spark):
    batches = [[("a", 1, T, i)] for i in range(4)]
    _, out = run_max(spark, batches, [("a", 21)])
    assert [(r.key, r.value) for r in out] == [("a", 21)]


RECORDS = [("a", 1, T, 0), ("a", 1, T + 15_000, 1), ("a", 1, T, 2), ("a", 30, T + 30_000, 3)]


@pytest.mark.parametrize("size", [1, 2, 4])
def test_ticks_do_not_depend_on_batches(spark, size):
    _, out = run_max(spark, [RECORDS[i:i + size] for i in range(0, 4, size)], [("a", 21)])
    assert [(r.value, r.stream_time) for r in out] == [(21, T), (21, T + 15_000), (30, T + 30_000)]


def test_idle_key_is_flushed_by_event_time(spark):
    batches = [[("a", 5, T, 0)], [("b", 1, T + 25_000, 1)], [("b", 2, T + 26_000, 2)], [("b", 2, T + 27_000, 3)]]
    s = stream_of(spark, landing_zone(batches)).withWatermark("ts", "0 milliseconds").select("key", "value", "ms", "seq")
    out = s.groupBy("key").transformWithStateInPandas(
        MaxProcessor(10_000, idle_flush=True), max_output_schema(), "Append", "EventTime")
    rows = run_stream(out, "idle").read(spark).collect()
    assert [(r.value, r.kind) for r in rows if r.key == "a"][0] == (5, "stream-time")
    idle = sorted((r.value, r.stream_time) for r in rows if r.key == "a" and r.kind == "idle")
    assert idle and idle[0] == (5, T + 10_000)


def test_wall_clock_timer_flushes_every_key(spark):
    path = landing_zone([[("z", 1, T, 0)]])
    s = stream_of(spark, path).select("key", "value", "ms", "seq")
    out = s.groupBy("key").transformWithStateInPandas(
        MaxProcessor(10_000, wall_clock_ms=500), max_output_schema(), "Append", "ProcessingTime",
        initialState=seeds(spark, [("a", 21), ("b", 22)]))
    d = tempfile.mkdtemp(prefix="kf-wall-", dir="/tmp")
    q = (out.writeStream.format("parquet").option("path", d + "/out")
         .option("checkpointLocation", d + "/ck").trigger(processingTime="300 milliseconds").start())
    try:
        deadline = time.time() + 60
        got = set()
        while time.time() < deadline and not {("a", 21), ("b", 22)} <= got:
            time.sleep(1)
            try:
                rows = spark.read.parquet(d + "/out").filter(F.col("kind") == WALL_CLOCK).collect()
                got = {(r.key, r.value) for r in rows}
            except Exception:  # noqa: BLE001 - nothing committed yet
                pass
    finally:
        q.stop()
    assert {("a", 21), ("b", 22)} <= got


FIVE_FILES = [[1000, 1100], [2000], [1150, 1700], [5000], [1700, 9000]]


def test_late_data_native_watermark_is_more_lenient(spark):
    seq = iter(range(100))
    batches = [[("a", 1, ms, next(seq)) for ms in f] for f in FIVE_FILES]
    s = stream_of(spark, landing_zone(batches))
    run = run_stream(windows.tumbling(s, 600, windows.COUNT, 350), "late_native")
    native = {r.window_start: r.cnt for r in run.read(spark).collect()}
    assert native == {600: 3, 1200: 2, 1800: 1, 4800: 1}  # 9000 still open
    flat = spark.createDataFrame([r for b in batches for r in b], SCHEMA).withColumn(
        "ts", F.timestamp_millis("ms"))
    exact = {r.window_start: r.cnt for r in
             windows.late_drop_exact(flat, 600, 350, F.col("seq"), F.col("seq")).collect()}
    assert exact == {600: 2, 1200: 1, 1800: 1, 4800: 1, 9000: 1}


def _event_batches(spark, n):
    recs = event_records(spark, SF_SMALL).select("key", "value", "ms", "seq").orderBy("seq").toPandas()
    size = -(-len(recs) // n)
    return [list(recs.iloc[i:i + size].itertuples(index=False, name=None)) for i in range(0, len(recs), size)]


def test_stream_equals_batch_for_windowed_counts(spark):
    batches = _event_batches(spark, 4)
    s = stream_of(spark, landing_zone(batches))
    run = run_stream(windows.tumbling(s, 6 * 3_600_000, windows.COUNT, 10**12), "tumble_update", mode="update")
    got = newest_per_key(read_changelog(spark, run), ["key", "window_start"])
    want = windows.tumbling(event_records(spark, SF_SMALL), 6 * 3_600_000, windows.COUNT)
    cols = ["key", "window_start", "window_end", "cnt"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert len([p for p in run.progress if p["numInputRows"]]) == 4


def test_restart_from_checkpoint_resumes(spark):
    batches = _event_batches(spark, 4)
    path = landing_zone(batches[:2])
    s = stream_of(spark, path)
    first = run_stream(agg.count_by_key(s), "restart", mode="update")
    # two more files land, the query restarts from its checkpoint
    t0 = time.time()
    for i, rows in enumerate(batches[2:], start=2):
        df = pd.DataFrame(rows, columns=["key", "value", "ms", "seq"])
        p = os.path.join(path, f"part-{i:04d}.parquet")
        pq.write_table(pa.Table.from_pandas(df, preserve_index=False), p)
        os.utime(p, (t0 + i, t0 + i))
    second = run_stream(agg.count_by_key(stream_of(spark, path)), "restart", mode="update",
                        output=first.output, checkpoint=first.checkpoint)
    got = {r.key: r.cnt for r in newest_per_key(read_changelog(spark, second), ["key"]).collect()}
    want = {r.key: r.cnt for r in agg.count_by_key(event_records(spark, SF_SMALL)).collect()}
    assert got == want


def _updates(spark, files):
    """Stream of (side, key, value, seq) updates, a file per micro-batch; a left row's value is its foreign key."""
    d = tempfile.mkdtemp(prefix="kf-fk-", dir="/tmp")
    t0 = time.time() - 1000
    schema = pa.schema([("side", pa.string()), ("key", pa.string()), ("value", pa.string()), ("seq", pa.int64()),
                        ("fk", pa.string())])
    for i, rows in enumerate(files):
        df = pd.DataFrame(rows, columns=["side", "key", "value", "seq"])
        df["fk"] = [v if s == "L" else k for s, k, v, _ in rows]
        p = os.path.join(d, f"part-{i:04d}.parquet")
        pq.write_table(pa.Table.from_pandas(df, schema=schema, preserve_index=False), p)
        os.utime(p, (t0 + i, t0 + i))
    return (spark.readStream.schema("side string, key string, value string, seq bigint, fk string")
            .option("maxFilesPerTrigger", "1").parquet(d))


def test_fk_join_changelog_fixture(spark):
    from keyflow.streaming.fk_changelog import current_join, run_fk_join
    log = run_fk_join(_updates(spark, [
        [("L", "john", "1", 1), ("L", "alex", "2", 2)],
        [("R", "1", "xx", 3)],
        [("R", "2", "yy", 4), ("L", "john", "2", 5)],
        [("R", "2", "zz", 6), ("L", "alex", None, 7)],
    ]), "fk_fixture")

    def state_after(batch):
        return {r.pk: r.value for r in current_join(log.filter(F.col("batch_id") <= batch)).collect()}

    assert state_after(0) == {}
    assert state_after(1) == {"john": "user: 1 details: xx"}
    assert state_after(2) == {"john": "user: 2 details: yy", "alex": "user: 2 details: yy"}
    assert state_after(3) == {"john": "user: 2 details: zz"}


def test_fk_join_offsets_of_the_two_topics_do_not_compare(spark):
    from keyflow.streaming.fk_changelog import current_join, run_fk_join
    log = run_fk_join(_updates(spark, [[("L", "john", "1", 100)], [("R", "1", "a", 5)], [("R", "1", "old", 4)]]),
                      "fk_offsets")
    assert {r.pk: r.value for r in current_join(log).collect()} == {"john": "user: 1 details: a"}


def test_sliding_windows_on_a_stream(spark):
    from keyflow.streaming.sliding import run_sliding
    want = sorted([(700, 1000, 1, 1), (800, 1100, 2, 3), (1001, 1301, 2, 6), (1101, 1401, 1, 4),
                   (1700, 2000, 1, 8)])
    for bucket in (None, 301):
        batches = [[("a", 1, 1000, 0), ("a", 2, 1100, 1)], [("a", 4, 1301, 2), ("a", 8, 2000, 3)],
                   [("a", 0, 1_000_000, 4)]]  # far-future record: advances the watermark
        s = stream_of(spark, landing_zone(batches))
        run = run_sliding(s, 300, 0, "sliding_stream", bucket_ms=bucket)
        got = sorted((r.window_start, r.window_end, r.cnt, r.total) for r in run.collect())
        assert got == want, bucket


def test_session_updates_merge_and_retract(spark):
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    batches = [[("a", 1, 1000, 0)], [("a", 2, 1500, 1)], [("a", 4, 1250, 2)]]  # 1250 bridges both
    log = run_session_updates(stream_of(spark, landing_zone(batches)), 300, 10_000, "session_updates")
    rows = sorted((r.batch_id, r.window_start, r.window_end, r.cnt, r.deleted) for r in log.collect())
    assert rows == [(0, 1000, 1000, 1, False), (1, 1500, 1500, 1, False),
                    (2, 1000, 1500, 3, False), (2, 1500, 1500, None, True)]
    cur = [(r.window_start, r.window_end, r.cnt, r.total) for r in current_sessions(log).collect()]
    assert cur == [(1000, 1500, 3, 7)]


def test_stream_equals_batch_hopping_and_sessions(spark):
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    H = 3_600_000
    batches = _event_batches(spark, 4)
    path = landing_zone(batches)
    batch_recs = event_records(spark, SF_SMALL)
    hop = run_stream(windows.hopping(stream_of(spark, path), 3 * H, 2 * H, windows.COUNT, 10**12),
                     "hop_update", mode="update")
    got = newest_per_key(read_changelog(spark, hop), ["key", "window_start"])
    want = windows.hopping(batch_recs, 3 * H, 2 * H, windows.COUNT)
    cols = ["key", "window_start", "window_end", "cnt"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    # sessions: native session_window (complete) and the update processor agree with batch
    want_s = sorted(map(tuple, windows.session(batch_recs, 3 * H, windows.SUM)
                        .select("key", "window_start", "window_end", "total").collect()))
    upd = run_session_updates(stream_of(spark, path), 3 * H, 10**12, "sess_upd")
    got_u = sorted(map(tuple, current_sessions(upd)
                       .select("key", "window_start", "window_end", "total").collect()))
    assert got_u == want_s
    native = run_stream(windows.session(stream_of(spark, path), 3 * H, windows.SUM, 10**12),
                        "sess_native", mode="complete")
    log = read_changelog(spark, native)
    last = log.agg(F.max("batch_id")).first()[0]  # complete mode: the newest batch is the result
    got_n = sorted(map(tuple, log.filter(F.col("batch_id") == last)
                       .select("key", "window_start", "window_end", "total").collect()))
    assert got_n == want_s


def test_table_state_stream_with_delete(spark):
    batches = [[("a", 5, 1, 0)], [("a", None, 2, 1)], [("b", 7, 3, 2)]]
    s = stream_of(spark, landing_zone(batches))
    agg_df = s.groupBy("key").agg(F.max_by("value", "seq").alias("value"), F.count("value").alias("n_values"))
    run = run_stream(agg_df, "table_state", mode="update")
    cur = {r.key: (r.value, r.n_values) for r in newest_per_key(read_changelog(spark, run), ["key"]).collect()}
    assert cur == {"a": (None, 1), "b": (7, 1)}  # latest {b: 7}; add/subtract {a: 0, b: 7}


def test_interval_join_stream_fixture(spark):
    from keyflow.streaming.joins import interval_join_stream, run_full_join
    left = [[("a", 1, 1000, 0)], [], [("z", 0, 100_000, 10)]]
    right = [[], [("a", 2, 2500, 1), ("a", 3, 2501, 2)], [("z", 0, 100_000, 11)]]

    l = stream_of(spark, landing_zone([b for b in left if b])).withColumn("value", F.col("value").cast("string"))
    r = stream_of(spark, landing_zone([b for b in right if b])).withColumn("value", F.col("value").cast("string"))
    inner = run_stream(interval_join_stream(l, r, 1500, "inner"), "ij_inner").read(spark)
    assert sorted((x.left_ms, x.right_ms) for x in inner.collect()) == [(1000, 2500), (100_000, 100_000)]
    l = stream_of(spark, landing_zone([b for b in left if b])).withColumn("value", F.col("value").cast("string"))
    r = stream_of(spark, landing_zone([b for b in right if b])).withColumn("value", F.col("value").cast("string"))
    full = run_full_join(l, r, 1500, "ij_full")
    got = sorted(((x.left_ms, x.right_ms, x.value) for x in full.collect()), key=repr)
    assert (None, 2501, "user: null details: 3") in got
    assert (1000, 2500, "user: 1 details: 2") in got
    assert len(got) == 3


@pytest.mark.parametrize("bucket", [None, 3 * 3_600_000 + 1])
def test_stream_equals_batch_sliding(spark, bucket):
    from keyflow.streaming.sliding import run_sliding
    d = 3 * 3_600_000
    batches = _event_batches(spark, 4)
    far = 4_102_444_800_000  # 2100-01-01: advances the watermark past every window
    flush = [(k, 0, far, 10**9 + i) for i, k in enumerate(sorted({r[0] for b in batches for r in b}))]
    s = stream_of(spark, landing_zone(batches + [flush]))
    run = run_sliding(s, d, 0, "sliding_multi", bucket_ms=bucket)
    got = sorted(map(tuple, run.select("key", "window_start", "window_end", "cnt", "total").collect()))
    recs = event_records(spark, SF_SMALL)
    c = windows.sliding(recs, d, windows.COUNT)
    t = windows.sliding(recs, d, windows.SUM)
    want = sorted(map(tuple, c.join(t, ["key", "window_start", "window_end"])
                      .select("key", "window_start", "window_end", "cnt", "total").collect()))
    assert got == want


def test_cogroup_fold_writes_new_pieces_only(spark):
    from keyflow.operators.aggregates import fold_parts
    from keyflow.session import shared_dir
    from keyflow.streaming.runner import run_batches
    s = stream_of(spark, landing_zone([[("a", 5, 1, 0)], [("a", None, 2, 1), ("a", 7, 2, 2)]]))
    piece = F.when(F.col("value").isNotNull(), F.concat(F.lit(" first "), F.col("value").cast("string"))) \
        .otherwise(F.lit(" second x"))
    base = shared_dir(spark, "fold_test")
    run_batches(s.select("key", "seq", piece.alias("piece")), "fold_test",
                lambda b, i: fold_parts(b).write.parquet(f"{base}/parts/batch_id={i}"), f"{base}/checkpoint")
    rows = sorted((r.batch_id, r.part) for r in spark.read.parquet(f"{base}/parts").collect())
    assert rows == [(0, " first 5"), (1, " second x first 7")]


def test_fk_join_changelog_random_against_replay(spark):
    import random
    from keyflow.streaming.fk_changelog import current_join, run_fk_join
    rnd = random.Random(5)
    seq = {"L": 500, "R": 0}  # a counter per topic
    files = []
    for _ in range(4):
        rows = []
        for _ in range(40):
            side = "L" if rnd.random() < 0.6 else "R"
            seq[side] += 1
            if side == "L":
                fk = rnd.choice(["1", "1", "1", "2", "3"]) if rnd.random() > 0.15 else None  # "1" is hot
                rows.append((side, f"u{rnd.randrange(12)}", fk, seq[side]))
            else:
                rows.append((side, rnd.choice(["1", "2", "3"]),
                             None if rnd.random() < 0.15 else f"r{seq[side]}", seq[side]))
        files.append(rows)
    log = run_fk_join(_updates(spark, files), "fk_random")
    left, right = {}, {}
    for batch, rows in enumerate(files):
        for side, k, v, _ in rows:
            (left if side == "L" else right)[k] = v
        want = {pk: f"user: {fk} details: {right[fk]}" for pk, fk in left.items()
                if fk is not None and right.get(fk) is not None}
        got = {r.pk: r.value for r in current_join(log.filter(F.col("batch_id") <= batch)).collect()}
        assert got == want


def _shuffled_batches(seed, n, keys, span, disorder, per_batch):
    """Records in time order, then locally shuffled (by at most ``disorder`` ms)."""
    import random
    rnd = random.Random(seed)
    pts = sorted((rnd.randrange(0, span), rnd.choice(keys), rnd.randrange(1, 9)) for _ in range(n))
    arrival = sorted(range(n), key=lambda i: pts[i][0] + rnd.randrange(0, disorder))
    rows = [(pts[i][1], pts[i][2], pts[i][0], j) for j, i in enumerate(arrival)]
    return [rows[i:i + per_batch] for i in range(0, n, per_batch)], rows


def _session_replay(batches, gap):
    """Changelog of sessions by brute force: per batch the changed sessions and those they absorbed."""
    seen, before, log = [], {}, []
    for number, rows in enumerate(batches):
        seen += [(k, ms, v) for k, v, ms, _ in rows]
        now = {}
        for key in {k for k, _, _ in seen}:
            own = sorted((ms, v) for k, ms, v in seen if k == key)
            start = None
            for ms, v in own:
                if start is None or ms - now[key, start][0] > gap:
                    start = ms
                    now[key, start] = (ms, 0, 0)
                end, n, total = now[key, start]
                now[key, start] = (ms, n + 1, total + v)
        log += [(number, *at, *x, False) for at, x in now.items() if before.get(at) != x]
        log += [(number, *at, before[at][0], None, None, True) for at in before.keys() - now.keys()]
        before = now
    return sorted(log, key=repr)


def test_session_changelog_against_replay(spark):
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    batches, rows = _shuffled_batches(1, 300, "ab", 60_000, 2_000, 37)
    log = run_session_updates(stream_of(spark, landing_zone(batches)), 500, 5_000, "sess_ooo")
    got = [(r.batch_id, r.key, r.window_start, r.window_end, r.cnt, r.total, r.deleted) for r in log.collect()]
    assert sorted(got, key=repr) == _session_replay(batches, 500)
    ref = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))
    want = windows.partial_sessions(ref, 500)
    assert sorted(map(tuple, current_sessions(log).select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_session_late_rule_looks_at_the_session(spark):
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    batches = [[("a", 1, 1000, 0)], [("b", 1, 1500, 1)], [("a", 2, 1200, 2), ("a", 4, 600, 3), ("b", 8, 900, 4)]]
    log = run_session_updates(stream_of(spark, landing_zone(batches)), 300, 200, "sess_late")
    got = sorted((r.key, r.window_start, r.window_end, r.total) for r in current_sessions(log).collect())
    # closed: sessions that ended before 1500 - 200 - 300; 600 is too far from a's session, b's 900 is late alone
    assert got == [("a", 1000, 1200, 3), ("b", 1500, 1500, 1)]


def test_sliding_stream_out_of_order_within_grace(spark):
    from keyflow.streaming.sliding import run_sliding
    batches, rows = _shuffled_batches(2, 300, "ab", 60_000, 2_000, 41)
    far = [("a", 0, 4_102_444_800_000, 10**6), ("b", 0, 4_102_444_800_000, 10**6 + 1)]
    s = stream_of(spark, landing_zone(batches + [far]))
    run = run_sliding(s, 700, 5_000, "slide_ooo", bucket_ms=5_000)
    got = sorted(map(tuple, run.select("key", "window_start", "window_end", "cnt", "total")
                     .filter(F.col("window_end") < 10**12).collect()))
    ref = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))
    c = windows.sliding(ref, 700, windows.COUNT)
    t = windows.sliding(ref, 700, windows.SUM)
    want = sorted(map(tuple, c.join(t, ["key", "window_start", "window_end"])
                      .select("key", "window_start", "window_end", "cnt", "total").collect()))
    assert got == want


def test_sliding_record_that_ties_the_newest_time_is_kept(spark):
    from keyflow.streaming.sliding import run_sliding
    batches = [[("a", 1, 1000, 0)], [("a", 1, 1000, 1), ("a", 1, 1200, 2)], [("a", 1, 100_000, 3)], [("a", 1, 200_000, 4)]]
    run = run_sliding(stream_of(spark, landing_zone(batches)), 300, 0, "sliding_tie")
    got = {r.window_start: r.cnt for r in run.collect()}
    assert got[700] == 2 and got[900] == 3


def test_sums_above_2_to_the_53_are_exact(spark):
    from keyflow.functions.time import floor_div
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    from keyflow.streaming.sliding import run_sliding
    big = 2**53
    zone = landing_zone([[("a", big, 1000, 0), ("a", 1, 1000, 1)], [("a", None, 1001, 2)], [("b", 1, 10**6, 3)]])
    log = run_session_updates(stream_of(spark, zone), 300, 1000, "sess_big")
    assert {r.key: r.total for r in current_sessions(log).collect()} == {"a": big + 1, "b": 1}
    run = run_sliding(stream_of(spark, zone), 300, 0, "slide_big")
    assert {r.window_start: r.total for r in run.collect()}[700] == big + 1
    df = spark.createDataFrame([(2**60 + 5,), (-(2**60) - 5,), (-7,), (0,)], "x bigint")
    assert [r.q for r in df.select(floor_div("x", 10).alias("q")).collect()] == [
        (2**60 + 5) // 10, (-(2**60) - 5) // 10, -1, 0]


def test_run_that_emits_nothing_is_read_as_empty(spark):
    s = stream_of(spark, landing_zone([[("a", 1, 1000, 0)]])).filter(F.col("key") == "none")
    assert run_stream(s, "nothing").read(spark).count() == 0
    run = run_stream(agg.count_by_key(s), "nothing_update", mode="update")
    assert newest_per_key(read_changelog(spark, run), ["key"]).count() == 0


def test_named_store_is_found_by_its_name(spark):
    import uuid
    from keyflow.streaming.state import open_store
    name = f"test-{uuid.uuid4().hex[:8]}"
    s = stream_of(spark, landing_zone([[("a", 1, 1000, 0), ("b", 1, 1000, 1), ("a", 2, 1001, 2)]]))
    run_stream(s.groupBy("key").agg(F.count(F.lit(1)).alias("cnt")), "named", mode="update", store=name)
    st = open_store(spark, name)
    assert {r[0]: r[1] for r in st.collect()} == {"a": 2, "b": 1}


def test_tap_counts_over_a_hundred_batches(spark):
    from keyflow.operators.stateless import TAP_SCHEMA, observe_tap
    from keyflow.session import shared_dir
    from keyflow.streaming.runner import run_batches
    n = 105
    s = stream_of(spark, landing_zone([[("a", i, 1000 + i, i)] for i in range(n)])).select("key", "value", "ms", "seq")
    base = shared_dir(spark, "tap_test")

    def write(batch, batch_id):
        out, seen = observe_tap(batch, f"t{batch_id}")
        out.write.format("noop").mode("overwrite").save()
        row = tuple(seen.get[k] for k in ("records", "max_value", "max_ms"))
        spark.createDataFrame([row], TAP_SCHEMA).write.parquet(f"{base}/tap/batch_id={batch_id}")
    run_batches(s, "tap_test", write, f"{base}/checkpoint")
    got = spark.read.schema(TAP_SCHEMA).parquet(f"{base}/tap").agg(F.sum("records"), F.max("max_ms")).first()
    assert tuple(got) == (n, 1000 + n - 1)


def test_thinning_keeps_maxima_next_to_nulls(spark):
    rows = [("a", 3, T, 0), ("a", None, T + 5_000, 1), ("a", 5, T + 5_000, 2),      # equal times
            ("b", 3, T, 3), ("b", None, T + 9_000, 4), ("b", 5, T + 4_000, 5), ("b", 4, T + 25_000, 6),  # out of order
            ("c", None, T, 7), ("c", 5, T, 8), ("d", None, T, 9), ("d", 7, None, 10), ("d", 6, T, 11), ("d", 6, T, 12)]
    path = tempfile.mkdtemp(prefix="kf-null-", dir="/tmp")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    stream = stream_of(spark, path).select("key", "value", "ms", "seq")
    got = []
    for recs in (pre_aggregate_max(stream), stream):
        out = recs.groupBy("key").transformWithStateInPandas(MaxProcessor(10_000), max_output_schema(), "Append", "None")
        run = run_stream(out, "thinned_nulls")
        got.append((sorted(map(tuple, run.read(spark).collect()), key=repr),
                    sorted(map(tuple, read_state(spark, run.checkpoint, state_var="max").collect()), key=repr)))
    assert got[0] == got[1]
    thinned = pre_aggregate_max(spark.read.parquet(path).coalesce(1)).collect()
    assert sorted(r.seq for r in thinned) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11]
