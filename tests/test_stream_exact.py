"""Streams that follow stream time record by record, and whole changelogs: the same rows in any micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import records
from keyflow.operators import changelog, joins, punctuation, windows
from keyflow.streaming import changelogs, sessions, stream_time
from keyflow.streaming import joins as stream_joins
from keyflow.streaming.joins import run_full_join
from test_late import disorder, flush_replay
from test_streaming import landing_zone, stream_of


def found(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def in_files(rows, n):
    """(key, value, ms, seq) in arrival order, cut into ``n`` files."""
    rows = [(k, v, ms, i) for i, (k, ms, v) in enumerate(rows)]
    size = -(-len(rows) // n)
    return landing_zone([rows[i:i + size] for i in range(0, len(rows), size)])


@pytest.mark.parametrize("files", [1, 3, 10])
def test_exact_late_rule_across_batches(spark, files):
    rows = disorder(31, n=120)
    seq = F.col("seq")
    part = F.when(F.col("key") == "a", 1).otherwise(0)
    log = stream_time.run_late_exact(stream_of(spark, in_files(rows, files)), 200, 50, seq, seq, "late_exact", part)
    want = windows.late_drop_exact(records(spark, rows), 200, 50, seq, seq, part)
    cols = ["key", "window_start", "window_end", "cnt"]
    assert found(stream_time.current_counts(log), *cols) == found(want, *cols)
    assert log.select("batch_id").distinct().count() == files


@pytest.mark.parametrize("files", [1, 2, 4])
def test_flushes_across_batches(spark, files):
    rows = disorder(32, n=90)
    seq = F.col("seq")
    out = stream_time.run_flush_all(stream_of(spark, in_files(rows, files)), 700, punctuation.SUM, seq, seq, "flush_all",
                                    F.when(F.col("key") == "a", 1).otherwise(0))
    want = flush_replay([(int(k == "a"), k, v, ms) for k, ms, v in rows], 700, "sum")
    assert found(out, "partition", "key", "value", "stream_time") == sorted(want, key=repr)


def test_a_batch_without_a_flush_sends_nothing(spark):
    rows = [("a", 100, 1), ("b", 150, 2), ("a", 120, 3), ("a", 1100, 4)]
    out = stream_time.run_flush_all(stream_of(spark, in_files(rows, 4)), 1000, punctuation.MAX, F.col("seq"), F.col("seq"),
                                    "flush_few")
    assert found(out, "key", "value", "stream_time") == [("a", 1, 100), ("a", 4, 1100), ("b", 2, 1100)]


@pytest.mark.parametrize("chunk", [1, 7])
def test_running_counts_and_rows_of_before(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.choice("ab"), i, rnd.choice([None, rnd.randrange(100)])) for i in range(80)]
    df = records(spark, rows)
    many, last, want, pairs = {"a": 5}, {"a": 77}, [], []
    for i, (k, _, v) in enumerate(rows):
        many[k] = many.get(k, 0) + 1
        want.append((k, i, many[k]))
        pairs.append((k, i, v, last.get(k)))
        last[k] = v
    earlier = spark.createDataFrame([("a", 5)], "key string, cnt bigint")
    assert found(changelog.running_counts(df, ["key"], earlier=earlier, chunk=chunk), "key", "seq", "cnt") == sorted(want, key=repr)
    old = spark.createDataFrame([("a", 77)], "key string, value bigint")
    assert found(changelog.with_previous(df, old, chunk=chunk), "key", "seq", "value", "old_value") == sorted(pairs, key=repr)


def test_filter_changelog_by_hand(spark):
    rows = [("a", 0, 10), ("a", 1, 60), ("a", 2, 70), ("a", 3, 20), ("a", 4, None), ("a", 5, 90), ("a", 6, None), ("b", 7, 50)]
    for files in (1, 4):
        out = changelogs.run_filter_changelog(stream_of(spark, in_files(rows, files)), F.col("value") >= 50, "filtered")
        assert sorted((r.key, r.seq, r.change, r.old_value, r.new_value) for r in out.collect()) == [
            ("a", 1, "insert", None, 60), ("a", 2, "update", 60, 70), ("a", 3, "delete", 70, None),
            ("a", 5, "insert", None, 90), ("a", 6, "delete", 90, None), ("b", 7, "insert", None, 50)]


def test_count_updates_across_batches(spark):
    rows = [(random.Random(i).choice("abc"), i, 1) for i in range(40)]
    many, want = {}, []
    for i, (k, _, _) in enumerate(rows):
        many[k] = many.get(k, 0) + 1
        want.append((k, many[k], i))
    out = changelogs.run_count_updates(stream_of(spark, in_files(rows, 5)), {"key": "string"}, "count_updates")
    assert found(out, "key", "cnt", "seq") == sorted(want, key=repr)


@pytest.mark.parametrize("files", [1, 4])
def test_final_sessions_come_once(spark, files):
    rows = [(k, ms, v) for k, ms, v in sorted(disorder(33, n=120), key=lambda r: r[1])]
    top = max(r[1] for r in rows)
    out = sessions.run_session_final(stream_of(spark, in_files(rows, files)), 30, 100, "final")
    want = [r for r in windows.partial_sessions(records(spark, rows), 30).collect() if r.window_end + 30 <= top - 100]
    cols = ["key", "window_start", "window_end", "cnt", "total"]
    assert found(out, *cols) == sorted((tuple(r[c] for c in cols) for r in want), key=repr)


def test_closed_sessions_take_no_more_records(spark):
    rows = [("a", 1000, 1), ("b", 1400, 1), ("a", 1200, 2)]  # a's session closed at 1400 - 50 - 300
    out = sessions.run_session_final(stream_of(spark, in_files(rows + [("b", 9000, 1)], 4)), 300, 50, "closed")
    assert found(out, "key", "window_start", "window_end", "cnt") == [("a", 1000, 1000, 1), ("a", 1200, 1200, 1), ("b", 1400, 1400, 1)]


def test_full_join_with_equal_records(spark):
    """Records that are equal in all columns are told apart by number."""
    left = spark.createDataFrame([("a", 100, 1, 0), ("a", 100, 1, 0)], "key string, ms bigint, value bigint, seq bigint")
    right = spark.createDataFrame([("a", 140, 5, 0)] * 2 + [("a", 500, 6, 1)] * 3, left.schema)
    for bucket in (None, 7, 400):
        got = found(joins.interval_join(left, right, 50, joins.FULL, bucket_ms=bucket), "left_ms", "right_ms")
        assert got == [(100, 140)] * 4 + [(None, 500)] * 3


def test_full_join_on_a_stream_random(spark):
    rnd = random.Random(4)
    rows = {}
    for side in "lr":
        at = [(rnd.choice("ab"), 1000 + 40 * i + rnd.randrange(30), rnd.randrange(9)) for i in range(60)]
        rows[side] = at + [("z", 10 ** 6, 0)]
    l, r = (stream_of(spark, in_files(rows[s], 4)) for s in "lr")
    got = found(run_full_join(l, r, 75, "full_random"), "key", "left_ms", "right_ms")
    want = []
    for k, m, _ in rows["l"]:
        near = [m2 for k2, m2, _ in rows["r"] if k2 == k and abs(m - m2) <= 75]
        want += [(k, m, m2) for m2 in near] or [(k, m, None)]
    want += [(k, None, m) for k, m, _ in rows["r"] if not any(k2 == k and abs(m - m2) <= 75 for k2, m2, _ in rows["l"])]
    assert got == sorted(want, key=repr)


def join_replay(left, right, bound, grace, how):
    """Files of (key, ms, value) by side, one of each a batch, under Spark's watermark: (key, left_ms, right_ms)."""
    before, now, held = 0, 0, ([], [])
    newest = [None, None]
    for batch in zip(left, right):
        for side, rows in enumerate(batch):
            held[side].extend(r for r in rows if r[1] > before)
            newest[side] = max([r[1] for r in rows] + [m for m in newest[side:side + 1] if m is not None])
        before, now = now, max(now, min(newest) - grace)
    pairs = [(l, r) for l in held[0] for r in held[1] if l[0] == r[0] and abs(l[1] - r[1]) <= bound]
    out = [(l[0], l[1], r[1]) for l, r in pairs]
    for side, rows in enumerate(held[:["inner", "left", "full"].index(how)]):
        met = [p[side] for p in pairs]
        out += [(r[0], r[1], None) if side == 0 else (r[0], None, r[1]) for r in rows if r not in met and r[1] + bound < now]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how, grace", [("inner", 0), ("left", 0), ("full", 0), ("full", 60)])
def test_join_of_late_and_equal_records_without_state_by_record(spark, monkeypatch, how, grace):
    rnd = random.Random(grace)
    sides = []
    for _ in "lr":
        rows = [(rnd.choice("ab"), 1000 + 30 * i - rnd.choice([0, 0, 0, 400]), None) for i in range(48)]
        sides.append([r for r in rows for _ in range(2 if r[1] % 4 == 0 else 1)])
    progress = []

    def watched(*args, **kw):
        progress.extend(found := runner(*args, **kw))
        return found
    runner = stream_joins.run_batches
    monkeypatch.setattr(stream_joins, "run_batches", watched)
    files = 4
    l, r = (stream_of(spark, in_files(rows, files)) for rows in sides)
    got = found(stream_joins.run_join(l, r, 45, f"{how}_late", how, grace), "key", "left_ms", "right_ms")
    cut = [[rows[i:i + -(-len(rows) // files)] for i in range(0, len(rows), -(-len(rows) // files))] for rows in sides]
    assert got == join_replay(*cut, 45, grace, how)
    # every record in a state store of its own was the time of a large batch
    assert progress and not any(p["stateOperators"] for p in progress)
