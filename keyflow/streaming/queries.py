"""Streaming forms registered as queries.

Each query runs a Structured Streaming job over the driver tables to
completion (``availableNow``), writes to the shared folder, and returns the
batch read of what it produced (or of its checkpointed state). The oracles in
``STREAMING_ORACLE`` describe exactly what a bounded run emits: in append mode
a window is emitted only once the watermark (max event time − grace) has
passed it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from keyflow.functions.text import jvm_tokens
from keyflow.operators import aggregates as agg
from keyflow.operators import punctuation, windows
from keyflow.plans import params as P
from keyflow.plans.catalog import STREAMING_QUERIES, arrival, user_partition
from keyflow.plans.oracle import ORACLE_SQL, R
from keyflow.sources import codec
from keyflow.sources.records import event_records
from keyflow.sources.stream import read_table_stream
from keyflow.streaming.joins import run_join
from keyflow.streaming.processors import (
    WORD_COUNT_OUTPUT,
    MaxProcessor,
    WordCountProcessor,
    max_output_schema,
    pre_aggregate_max,
)
from keyflow.streaming.runner import NO_BATCH, newest_per_key, read_changelog, run_batches, run_stream
from keyflow.streaming.sources import event_record_stream
from keyflow.streaming.state import open_store, read_state, state_lookup


# ---------------------------------------------------------------- windows, final (append)
def tumbling_count_final(spark, sf_dir):
    s = event_record_stream(spark, sf_dir)
    run = run_stream(windows.tumbling(s, P.TUMBLING_COUNT_SIZE, windows.COUNT, P.TUMBLING_COUNT_GRACE),
                     "tumbling_count_final")
    return run.read(spark)


def hopping_count_final(spark, sf_dir):
    s = event_record_stream(spark, sf_dir)
    run = run_stream(windows.hopping(s, P.HOPPING_SIZE, P.HOPPING_ADVANCE, windows.COUNT, P.HOPPING_GRACE),
                     "hopping_count_final")
    return run.read(spark)


def session_count_final(spark, sf_dir):
    from keyflow.streaming.sessions import run_session_final
    s = event_record_stream(spark, sf_dir, key="user_id")
    return run_session_final(s, P.SESSION_COUNT_GAP, P.SESSION_COUNT_GRACE, "session_count_final", "bigint").drop("total")


# ---------------------------------------------------------------- early results / changelogs
def session_intermediate(spark, sf_dir):
    """Every change of every session (``toStream().foreach`` of the session
    count): upserts and retractions of what changed in a batch. The current
    result is the newest non-retracted row per session."""
    from keyflow.streaming.sessions import current_sessions, run_session_updates
    s = event_record_stream(spark, sf_dir, key="user_id")
    log = run_session_updates(s, P.SESSION_COUNT_GAP, P.SESSION_COUNT_GRACE, "session_intermediate", "bigint")
    return current_sessions(log).drop("total")


def changelog_of_counts(spark, sf_dir):
    """``count().toStream()``: update mode emits the changed counts per batch."""
    s = event_record_stream(spark, sf_dir)
    run = run_stream(agg.count_by_key(s), "changelog_of_counts", mode="update")
    return newest_per_key(read_changelog(spark, run), ["key"])


# ---------------------------------------------------------------- sinks
def stream_sink_roundtrip(spark, sf_dir):
    """Typed topic sink and source: records are written in the Kafka wire form
    (String key, 8-byte big-endian Long value) to a topic folder by one
    streaming query and decoded by a second one."""
    s = event_record_stream(spark, sf_dir)
    wire = s.select(codec.encode_string("key").alias("key"), codec.encode_long("value").alias("value"),
                    F.col("ts").alias("timestamp"), F.col("seq").alias("offset"))
    topic = run_stream(wire, "topic_write")
    back = spark.readStream.schema(spark.read.parquet(topic.output).schema).parquet(topic.output)
    decoded = back.select(codec.decode_string("key").alias("key"), codec.decode_long("value").alias("value"),
                          F.unix_millis("timestamp").alias("ms"), F.col("offset").alias("seq"))
    return run_stream(decoded, "topic_read").read(spark)


# ---------------------------------------------------------------- stateful processors and state
def _max_run(spark, sf_dir, name, seeded: bool):
    recs = pre_aggregate_max(event_record_stream(spark, sf_dir).select("key", "value", "ms", "seq"))
    proc = MaxProcessor(P.MAX_STREAM_TICK)
    if not seeded:
        out = recs.groupBy("key").transformWithStateInPandas(proc, max_output_schema(), "Append", "None")
        return run_stream(out, name)
    # Seed state from the first half of the time range (a batch aggregate);
    # stream the second half.
    b = event_records(spark, sf_dir)
    lo, hi = b.agg(F.min("ms"), F.max("ms")).first()
    mid = lo + (hi - lo) // 2
    seed = b.filter(F.col("ms") < mid).groupBy("key").agg(F.max("value").alias("value"))
    # one seed above every value to come
    seed = seed.withColumn("value", F.when(F.col("key") == P.FILTER_KEY, P.HIGH_SEED).otherwise(F.col("value")))
    out = recs.filter(F.col("ms") >= mid).groupBy("key").transformWithStateInPandas(
        proc, max_output_schema(), "Append", "None", initialState=seed.groupBy("key"))
    return run_stream(out, name)


def stateful_max(spark, sf_dir):
    run = _max_run(spark, sf_dir, "stateful_max", seeded=False)
    st = read_state(spark, run.checkpoint, state_var="max")
    return st.select("key", F.col("max").alias("max_value"))


def stateful_max_seeded(spark, sf_dir):
    run = _max_run(spark, sf_dir, "stateful_max_seeded", seeded=True)
    st = read_state(spark, run.checkpoint, state_var="max")
    return st.select("key", F.col("max").alias("max_value"))


def stateful_max_emitted(spark, sf_dir):
    """What the punctuator emitted: a row per tick that a key's records cross."""
    return _max_run(spark, sf_dir, "stateful_max_emitted", seeded=False).read(spark)


def word_count_emitted(spark, sf_dir):
    """Event types as words, counted in event time: a row per tick that a word's records cross."""
    words = event_record_stream(spark, sf_dir).select(F.col("key").alias("word"), "ms", "seq")
    out = words.groupBy("word").transformWithStateInPandas(
        WordCountProcessor(P.WORD_COUNT_TICK), WORD_COUNT_OUTPUT, "Append", "None")
    return run_stream(out, "word_count_emitted").read(spark)


def word_count_timer(spark, sf_dir):
    """Stateful word count of a stream of texts, a trigger being the tick: each micro-batch sends the words
    whose count it changed. Counted by Spark's own state, combined map-side; the newest row per word is its count."""
    docs = read_table_stream(spark, sf_dir, "documents").select("text")
    words = jvm_tokens(docs, F.lower(F.col("text")), name="word")
    run = run_stream(words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")), "word_count_timer", mode="update")
    return newest_per_key(read_changelog(spark, run), ["word"])


def _count_store(spark, sf_dir):
    s = event_record_stream(spark, sf_dir)
    # a store's name is the caller's; here one per run, since each run starts anew
    store = f"clicks-count-{uuid.uuid4().hex[:12]}"
    run_stream(s.groupBy("key").agg(F.count(F.lit(1)).alias("cnt")), "clicks_count_store", mode="update", store=store)
    return open_store(spark, store)


def state_scan(spark, sf_dir):
    st = _count_store(spark, sf_dir)
    return st.select("key", F.col(st.columns[1]).alias("cnt"))


def state_lookup_query(spark, sf_dir):
    st = _count_store(spark, sf_dir)
    return state_lookup(st, F.col("key") == F.lit(P.FILTER_KEY)).select("key", F.col(st.columns[1]).alias("cnt"))


# ---------------------------------------------------------------- stream-stream joins
def _ss_join(how):
    def q(spark, sf_dir):
        def side(t):
            s = event_record_stream(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
            return s.filter(F.col("event_type") == t).drop("event_type")
        return run_join(side("click"), side("purchase"), P.JOIN_BOUND, f"ss_join_{how}_stream", how)
    return q


STREAMING_QUERIES.update({
    "tumbling_count_final": tumbling_count_final,
    "hopping_count_final": hopping_count_final,
    "session_count_final": session_count_final,
    "session_intermediate": session_intermediate,
    "changelog_of_counts": changelog_of_counts,
    "stream_sink_roundtrip": stream_sink_roundtrip,
    "stateful_max": stateful_max,
    "stateful_max_seeded": stateful_max_seeded,
    "stateful_max_emitted": stateful_max_emitted,
    "word_count_timer": word_count_timer,
    "word_count_emitted": word_count_emitted,
    "state_scan": state_scan,
    "state_lookup": state_lookup_query,
    "ss_join_inner_stream": _ss_join("inner"),
    "ss_join_left_stream": _ss_join("left"),
    "ss_join_full_stream": _ss_join("full"),
})


# ---------------------------------------------------------------- oracles
def _final(sql: str, end_expr: str, grace: int) -> str:
    return f"""SELECT q.* FROM ({sql}) q
WHERE {end_expr} <= (SELECT max(epoch_us(ts) // 1000) FROM events) - {grace}"""


def _ss_join_final(kind: str) -> str:
    b = P.JOIN_BOUND
    wm = """(SELECT least(max(CASE WHEN event_type = 'click' THEN epoch_us(ts) // 1000 END),
                      max(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) // 1000 END)) FROM events)"""
    base = ORACLE_SQL[f"ss_join_{kind}"]
    return f"""SELECT q.* FROM ({base}) q
WHERE (q.left_seq IS NOT NULL AND q.right_seq IS NOT NULL)
   OR (q.right_seq IS NULL AND q.left_ms + {b} < {wm})
   OR (q.left_seq IS NULL AND q.right_ms + {b} < {wm})"""


def _ticks(tick: int, columns: str) -> str:
    """A row where a key's stream time, in arrival order, crosses ticks from its first record's time."""
    return R + f""", s AS (
  SELECT event_type AS key, seq, max(ms) OVER w AS st, max(cents) OVER w AS top, count(*) OVER w AS n,
         first_value(ms) OVER w AS t0
  FROM r WINDOW w AS (PARTITION BY event_type ORDER BY seq ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, (st - t0) // {tick} AS k, lag((st - t0) // {tick}) OVER (PARTITION BY key ORDER BY seq) AS before FROM s)
SELECT {columns} FROM k WHERE before IS NULL OR k > before"""


STREAMING_ORACLE: dict[str, str] = {
    "tumbling_count_final": _final(ORACLE_SQL["tumbling_count"], "q.window_end", P.TUMBLING_COUNT_GRACE),
    "hopping_count_final": _final(ORACLE_SQL["hopping_count"], "q.window_end", P.HOPPING_GRACE),
    "session_count_final": _final(ORACLE_SQL["session_count"], f"q.window_end + {P.SESSION_COUNT_GAP}",
                                  P.SESSION_COUNT_GRACE),
    "session_intermediate": ORACLE_SQL["session_count"],
    "changelog_of_counts": ORACLE_SQL["count_by_key"],
    "stream_sink_roundtrip": ORACLE_SQL["stream_scan"],
    "stateful_max": R + "SELECT event_type AS key, max(cents) AS max_value FROM r GROUP BY ALL",
    "stateful_max_seeded": R + f"""SELECT event_type AS key,
       CASE WHEN event_type = '{P.FILTER_KEY}' THEN {P.HIGH_SEED} ELSE max(cents) END AS max_value FROM r GROUP BY event_type""",
    "stateful_max_emitted": _ticks(P.MAX_STREAM_TICK,
                                   "key, top AS value, st AS stream_time, 'stream-time' AS kind"),
    "word_count_emitted": _ticks(P.WORD_COUNT_TICK, "key AS word, CAST(n AS VARCHAR) AS count, st AS stream_time"),
    "word_count_timer": ORACLE_SQL["word_count"],
    "state_scan": ORACLE_SQL["count_by_key"],
    "state_lookup": ORACLE_SQL["table_filter_counts"],
    "ss_join_inner_stream": ORACLE_SQL["ss_join_inner"],
    "ss_join_left_stream": _ss_join_final("left"),
    "ss_join_full_stream": _ss_join_final("full"),
}


# ---------------------------------------------------------------- foreign-key join changelog
def fk_join_changelog(spark, sf_dir):
    """Purchases (user → nation key ``user_id % 25``) joined to ``nation`` as a
    streaming changelog; returns the current join (newest row per user)."""
    from keyflow.streaming.fk_changelog import current_join, run_fk_join
    ev = event_record_stream(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    left = ev.filter(F.col("event_type") == "purchase").select(
        F.lit("L").alias("side"), F.col("key").cast("string").alias("key"),
        (F.col("key") % F.lit(P.FK_MODULUS)).cast("string").alias("value"),
        (F.col("key") % F.lit(P.FK_MODULUS)).cast("string").alias("fk"), F.col("seq"))
    nation = read_table_stream(spark, sf_dir, "nation")
    # a topic of its own, with offsets from 0
    right = nation.select(F.lit("R").alias("side"), F.col("n_nationkey").cast("string").alias("key"),
                          F.col("n_name").alias("value"), F.col("n_nationkey").cast("string").alias("fk"),
                          F.col("n_nationkey").cast("bigint").alias("seq"))
    cur = current_join(run_fk_join(left.unionByName(right), "fk_join_changelog"))
    return cur.select(F.col("pk").cast("bigint").alias("key"), "value")


STREAMING_QUERIES["fk_join_changelog"] = fk_join_changelog
STREAMING_ORACLE["fk_join_changelog"] = ORACLE_SQL["fk_join"]


# ---------------------------------------------------------------- branches and taps on streams
def branch_fanout_stream(spark, sf_dir):
    """``split().branch()...`` on a stream: one micro-batch, three sinks."""
    from keyflow.operators import stateless
    from keyflow.session import shared_dir
    from keyflow.sources.sinks import fan_out

    s = event_record_stream(spark, sf_dir).select("key", "value", "ms", "seq")
    names = [n for n, _ in stateless.BRANCHES] + [stateless.DEFAULT_BRANCH]

    def branch(name):
        return lambda b: stateless.branch_label(b).filter(F.col("branch") == name).select(
            "key", "value", "seq", "branch")

    base = shared_dir(spark, "branches")
    schema = branch(names[0])(spark.createDataFrame([], s.schema)).schema
    for n in names:  # so that a run without a batch can be read
        spark.createDataFrame([], schema).write.parquet(f"{base}/{n}/batch_id={NO_BATCH}")
    q = (s.writeStream.option("checkpointLocation", f"{base}/checkpoint")
         .foreachBatch(fan_out({n: branch(n) for n in names}, base)).trigger(availableNow=True).start())
    q.awaitTermination()
    parts = [spark.read.schema(schema).parquet(f"{base}/{n}").drop("batch_id") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe_metrics_stream(spark, sf_dir):
    """What a tap on a stream saw: every micro-batch writes its observation
    beside its records, so the number of batches does not matter."""
    from keyflow.operators.stateless import TAP_SCHEMA, observe_tap
    from keyflow.session import shared_dir
    s = event_record_stream(spark, sf_dir).select("key", "value", "ms", "seq")
    base = shared_dir(spark, "events_tap")

    def write(batch, batch_id):
        out, seen = observe_tap(batch, f"tap-{batch_id}")
        out.write.mode("overwrite").parquet(f"{base}/records/batch_id={batch_id}")
        row = tuple(seen.get[k] for k in ("records", "max_value", "max_ms"))
        (batch.sparkSession.createDataFrame([row], TAP_SCHEMA)
         .write.mode("overwrite").parquet(f"{base}/tap/batch_id={batch_id}"))
    run_batches(s, "events_tap", write, f"{base}/checkpoint")
    return spark.read.schema(TAP_SCHEMA).parquet(f"{base}/tap").agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.max("max_value").alias("max_value"),
        F.max("max_ms").alias("max_ms"))


STREAMING_QUERIES["branch_fanout_stream"] = branch_fanout_stream
STREAMING_QUERIES["observe_metrics_stream"] = observe_metrics_stream
STREAMING_ORACLE["branch_fanout_stream"] = ORACLE_SQL["branch_label"]
STREAMING_ORACLE["observe_metrics_stream"] = ORACLE_SQL["observe_metrics"]


# ---------------------------------------------------------------- sliding windows on a stream
def _sliding_final(kind, grace):
    def q(spark, sf_dir):
        from keyflow.streaming.sliding import run_sliding
        s = event_record_stream(spark, sf_dir, key="user_id")
        diff = P.SLIDING_DIFF if kind == "count" else P.SLIDING_SUM_DIFF
        col = "cnt" if kind == "count" else "total"
        return run_sliding(s, diff, grace, f"sliding_{kind}_final", "bigint").select("key", "window_start", "window_end", col)
    return q


def _sliding_final_sql(name: str, grace: int, d: int) -> str:
    # A window is emitted when the watermark passes owner + d + 1; the owner is
    # the record at the window's end if there is one (left window), else the
    # record just before its start (right window).
    return f"""WITH pts AS (SELECT DISTINCT user_id AS k, epoch_us(ts) // 1000 AS ms FROM events)
SELECT q.* FROM ({ORACLE_SQL[name]}) q
LEFT JOIN pts ON pts.k = q.key AND pts.ms = q.window_end
WHERE (CASE WHEN pts.ms IS NOT NULL THEN q.window_end ELSE q.window_start - 1 END) + {d + 1}
      < (SELECT max(epoch_us(ts) // 1000) FROM events) - {grace}"""


STREAMING_QUERIES["sliding_count_final"] = _sliding_final("count", 0)
STREAMING_QUERIES["sliding_sum_final"] = _sliding_final("sum", P.SLIDING_SUM_GRACE)
STREAMING_ORACLE["sliding_count_final"] = _sliding_final_sql("sliding_count", 0, P.SLIDING_DIFF)
STREAMING_ORACLE["sliding_sum_final"] = _sliding_final_sql("sliding_sum", P.SLIDING_SUM_GRACE, P.SLIDING_SUM_DIFF)


# ---------------------------------------------------------------- early results of time windows
def tumbling_count_updates(spark, sf_dir):
    """Every change of every tumbling window (update mode); the newest row per
    window is its count."""
    s = event_record_stream(spark, sf_dir)
    run = run_stream(windows.tumbling(s, P.TUMBLING_COUNT_SIZE, windows.COUNT, P.TUMBLING_COUNT_GRACE),
                     "tumbling_count_updates", mode="update")
    return newest_per_key(read_changelog(spark, run), ["key", "window_start"])


STREAMING_QUERIES["tumbling_count_updates"] = tumbling_count_updates
STREAMING_ORACLE["tumbling_count_updates"] = ORACLE_SQL["tumbling_count"]


# ---------------------------------------------------------------- changelog tables on a stream
def _user_changelog_stream(spark, sf_dir):
    from keyflow.operators.tables import tombstone
    s = event_record_stream(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    return tombstone(s, F.col("event_type") == "error")


def table_latest_stream(spark, sf_dir):
    """Streaming aggregation keeping, per key, the newest value (a null value is a delete); update mode
    emits the keys that changed in each batch."""
    s = _user_changelog_stream(spark, sf_dir)
    run = run_stream(s.groupBy("key").agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")),
                     "table_latest_stream", mode="update")
    cur = newest_per_key(read_changelog(spark, run), ["key"])
    return cur.filter(F.col("value").isNotNull()).select("key", "value")


def table_agg_add_subtract_stream(spark, sf_dir):
    """Users' current values, with adder and subtractor, a group for each user."""
    from keyflow.streaming.table_aggregate import current_totals, run_table_aggregate
    log = run_table_aggregate(_user_changelog_stream(spark, sf_dir), F.col("key"), "table_agg_stream", "bigint", "bigint")
    return current_totals(log)


def table_regroup_sum_stream(spark, sf_dir):
    """Users re-grouped by the last digit of their value, with adder and subtractor."""
    from keyflow.streaming.table_aggregate import current_totals, run_table_aggregate
    log = run_table_aggregate(_user_changelog_stream(spark, sf_dir), F.col("value") % F.lit(10), "table_regroup", "bigint",
                              "bigint")
    return current_totals(log)


STREAMING_QUERIES["table_regroup_sum_stream"] = table_regroup_sum_stream
STREAMING_ORACLE["table_regroup_sum_stream"] = ORACLE_SQL["table_regroup_sum"]
STREAMING_QUERIES["table_latest_stream"] = table_latest_stream
STREAMING_QUERIES["table_agg_add_subtract_stream"] = table_agg_add_subtract_stream
STREAMING_ORACLE["table_latest_stream"] = ORACLE_SQL["table_latest"]
STREAMING_ORACLE["table_agg_add_subtract_stream"] = ORACLE_SQL["table_agg_add_subtract"]


# ---------------------------------------------------------------- cogroup fold on a stream
def cogroup_fold_stream(spark, sf_dir):
    """Clicks (" first " + cents) and views (" second " + props) folded per
    user in arrival order. A micro-batch writes only its new pieces, folded per
    user and chunk; the fold is the initial value and all parts in order."""
    from keyflow.operators.aggregates import COGROUP_FIRST, COGROUP_INITIAL, COGROUP_SECOND, fold_parts, ordered_concat
    from keyflow.session import shared_dir
    s = event_record_stream(spark, sf_dir, key="user_id",
                            extra={"event_type": F.col("event_type"), "props": F.col("props")})
    piece = (F.when(F.col("event_type") == "click", F.concat(F.lit(COGROUP_FIRST), F.col("value").cast("string")))
             .when(F.col("event_type") == "view", F.concat(F.lit(COGROUP_SECOND), F.col("props"))))
    base = shared_dir(spark, "cogroup_fold")

    def write(batch, batch_id):
        fold_parts(batch).write.mode("overwrite").parquet(f"{base}/parts/batch_id={batch_id}")
    run_batches(s.select("key", "seq", piece.alias("piece")), base.rsplit("/", 1)[-1], write, f"{base}/checkpoint")
    parts = spark.read.schema("key bigint, chunk bigint, part string, batch_id int").parquet(f"{base}/parts")
    folded = (parts.withColumn("o", F.struct("batch_id", "chunk")).groupBy("key")
              .agg(ordered_concat("o", "part").alias("folded")))
    return folded.select("key", F.concat(F.lit(COGROUP_INITIAL), F.col("folded")).alias("value"))


STREAMING_QUERIES["cogroup_fold_stream"] = cogroup_fold_stream
STREAMING_ORACLE["cogroup_fold_stream"] = ORACLE_SQL["cogroup_fold"]


# ---------------------------------------------------------------- stream time record by record
def _arrived_stream(spark, sf_dir, **kw):
    return event_record_stream(spark, sf_dir, extra={"user_id": F.col("user_id")}, **kw)


def late_drop_exact_stream(spark, sf_dir):
    """Tumbling counts of a stream under the exact late rule, whatever the micro-batches."""
    from keyflow.streaming.stream_time import current_counts, run_late_exact
    return current_counts(run_late_exact(_arrived_stream(spark, sf_dir), P.TUMBLING_COUNT_SIZE, P.TUMBLING_COUNT_GRACE,
                                         arrival(), F.col("seq"), "late_drop_exact_stream"))


def max_flush_all_stream(spark, sf_dir):
    """Running maxima of users, all sent on at every tick of the partition's stream time."""
    from keyflow.streaming.stream_time import run_flush_all
    return run_flush_all(_arrived_stream(spark, sf_dir, key="user_id"), P.MAX_STREAM_TICK, punctuation.MAX, arrival(),
                         F.col("seq"), "max_flush_all", user_partition(), "bigint")


def word_count_flush_all_stream(spark, sf_dir):
    """Words of the events' properties, counted per partition, all sent on at every tick."""
    from keyflow.streaming.stream_time import run_flush_all

    def words(df, keep):
        return jvm_tokens(df, F.lower("value"), keep=keep, name="key").withColumn("value", F.lit(1).cast("bigint"))
    out = run_flush_all(_arrived_stream(spark, sf_dir, value=F.col("props")), P.WORD_COUNT_TICK, punctuation.SUM, arrival(),
                        F.col("seq"), "word_count_flush_all", user_partition(), changes=words)
    return out.select("partition", F.col("key").alias("word"), F.col("value").cast("string").alias("count"), "stream_time")


# ---------------------------------------------------------------- whole changelogs
def changelog_of_counts_all(spark, sf_dir):
    """``count().toStream()`` without caching: every update of every count."""
    from keyflow.streaming.changelogs import run_count_updates
    s = event_record_stream(spark, sf_dir)
    return run_count_updates(s.filter("key is not null and value is not null"), {"key": "string"}, "changelog_of_counts_all")


def tumbling_count_updates_all(spark, sf_dir):
    """Every update of every tumbling window's count."""
    from keyflow.functions.time import floor_div
    from keyflow.streaming.changelogs import run_count_updates
    size = P.TUMBLING_COUNT_SIZE
    s = event_record_stream(spark, sf_dir).filter("key is not null")
    log = run_count_updates(s.withColumn("window_start", floor_div("ms", size) * F.lit(size)),
                            {"key": "string", "window_start": "long"}, "tumbling_count_updates_all")
    return log.select("key", "window_start", (F.col("window_start") + F.lit(size)).alias("window_end"), "cnt", "seq")


def table_filter_changelog(spark, sf_dir):
    """Users whose current value passes a threshold: inserts, updates and deletes of the filtered table."""
    from keyflow.streaming.changelogs import run_filter_changelog
    return run_filter_changelog(_user_changelog_stream(spark, sf_dir), F.col("value") >= F.lit(P.FILTER_VALUE),
                                "table_filter_changelog", "bigint")


STREAMING_QUERIES.update({
    "late_drop_exact_stream": late_drop_exact_stream,
    "max_flush_all_stream": max_flush_all_stream,
    "word_count_flush_all_stream": word_count_flush_all_stream,
    "changelog_of_counts_all": changelog_of_counts_all,
    "tumbling_count_updates_all": tumbling_count_updates_all,
    "table_filter_changelog": table_filter_changelog,
})
STREAMING_ORACLE.update({
    "late_drop_exact_stream": ORACLE_SQL["late_drop_exact"],
    "max_flush_all_stream": ORACLE_SQL["max_flush_all"],
    "word_count_flush_all_stream": ORACLE_SQL["word_count_flush_all"],
    "changelog_of_counts_all": R + """SELECT event_type AS key, seq,
       count(*) OVER (PARTITION BY event_type ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cnt
FROM r WHERE event_type IS NOT NULL AND cents IS NOT NULL""",
    "tumbling_count_updates_all": R + f""", w AS (
  SELECT event_type AS key, seq, (ms // {P.TUMBLING_COUNT_SIZE}) * {P.TUMBLING_COUNT_SIZE} AS window_start FROM r)
SELECT key, window_start, window_start + {P.TUMBLING_COUNT_SIZE} AS window_end, seq,
       count(*) OVER (PARTITION BY key, window_start ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cnt
FROM w WHERE key IS NOT NULL""",
    "table_filter_changelog": R + f""", t AS (
  SELECT user_id AS key, CASE WHEN event_type = 'error' THEN NULL ELSE cents END AS value, seq FROM r),
i AS (SELECT key, seq, value, lag(value) OVER (PARTITION BY key ORDER BY seq) AS before FROM t),
m AS (SELECT key, seq, CASE WHEN before >= {P.FILTER_VALUE} THEN before END AS old_value,
             CASE WHEN value >= {P.FILTER_VALUE} THEN value END AS new_value FROM i)
SELECT key, seq, CASE WHEN old_value IS NULL THEN 'insert' WHEN new_value IS NULL THEN 'delete' ELSE 'update' END AS change,
       old_value, new_value
FROM m WHERE old_value IS NOT NULL OR new_value IS NOT NULL""",
})
