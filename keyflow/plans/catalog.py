"""The registered queries: each reference operator wired on the driver tables.

Every query is ``(spark, sf_dir) -> DataFrame`` over whole tables. Keys follow
the survey: ``event_type`` (5 keys) or ``user_id``; value = amount in cents;
``seq`` = ``event_id``. Output columns are flat, bounds are epoch-ms BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.text import SESSION_KEY_FORMAT, jvm_tokens, window_text
from keyflow.functions.time import iso_instant
from keyflow.operators import aggregates as agg
from keyflow.operators import joins, late, punctuation, stateless, tables, windows
from keyflow.plans import params as P
from keyflow.sources.records import event_records, load_table

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf_dir, key="event_type", **kw):
    return event_records(spark, sf_dir, key=key, **kw)


def _typed_events(spark, sf_dir, key, event_type):
    return _events(spark, sf_dir, key=key, extra={"event_type": F.col("event_type")}).filter(
        F.col("event_type") == event_type).drop("event_type")


# ---------------------------------------------------------------- sources / sinks
def stream_scan(spark, sf_dir):
    return _events(spark, sf_dir).select("key", "value", "ms", "seq")


def table_delete(spark, sf_dir):
    recs = _events(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    return tables.tombstone(recs, F.col("event_type") == "error").select("key", "value", "seq")


# ---------------------------------------------------------------- stateless
def select_key_length(spark, sf_dir):
    recs = _events(spark, sf_dir, key="user_id")
    out = stateless.select_key(recs, F.length(F.col("key").cast("string")).cast("bigint"))
    return out.select("key", "value", "seq")


def filter_map_upper(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = agg.tokens(docs, "doc_id")
    kept = stateless.filter_records(toks, F.length("value") > F.lit(P.MIN_VALUE_LENGTH))
    return stateless.map_values(kept, F.upper("value")).select("key", "value")


def flatmap_key_chars_count(spark, sf_dir):
    recs = stateless.flat_map_key_chars(_events(spark, sf_dir))
    return agg.count_by_key(recs)


def flatmap_values_scale(spark, sf_dir):
    return stateless.flat_map_values_scale(_events(spark, sf_dir)).select("key", "value", "seq")


def flatmap_values_count(spark, sf_dir):
    return agg.count_by_key(stateless.flat_map_values_scale(_events(spark, sf_dir)))


def repartition_sum(spark, sf_dir):
    """Sum per key laid out in the reference's explicit 6 partitions.

    The width is applied to the aggregated rows, not to the raw records:
    same result, but the records are combined map-side and shuffled over the
    cluster's full width instead of through 6 tasks.
    """
    return stateless.repartition_by_key(agg.sum_by_key(_events(spark, sf_dir)), P.REPARTITION_WIDTH)


def sum_by_key(spark, sf_dir):
    return agg.sum_by_key(_events(spark, sf_dir))


def count_by_key(spark, sf_dir):
    return agg.count_by_key(_events(spark, sf_dir))


def count_by_value_mod10(spark, sf_dir):
    return agg.count_by_key(_events(spark, sf_dir), key=F.col("value") % F.lit(10))


def branch_label(spark, sf_dir):
    return stateless.branch_label(_events(spark, sf_dir)).select("key", "value", "seq", "branch")


def branch_counts(spark, sf_dir):
    labelled = stateless.branch_label(_events(spark, sf_dir))
    return labelled.groupBy("branch").agg(F.count(F.lit(1)).alias("cnt"))


def observe_metrics(spark, sf_dir):
    """What the tap saw, as a row; the records it passed on go to a noop sink."""
    out, seen = stateless.observe_tap(_events(spark, sf_dir), "events_tap")
    out.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[k] for k in ("records", "max_value", "max_ms"))],
                                 stateless.TAP_SCHEMA)


# ---------------------------------------------------------------- tables
def _user_changelog(spark, sf_dir):
    recs = _events(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    return tables.tombstone(recs, F.col("event_type") == "error")


def table_latest(spark, sf_dir):
    return tables.table_latest(_user_changelog(spark, sf_dir)).select("key", "value")


def table_agg_add_subtract(spark, sf_dir):
    return tables.table_agg_add_subtract(_user_changelog(spark, sf_dir))


def table_regroup_sum(spark, sf_dir):
    """Users re-grouped by the last digit of their current value, summed."""
    return tables.table_agg_add_subtract(_user_changelog(spark, sf_dir), F.col("value") % F.lit(10))


def table_filter_counts(spark, sf_dir):
    counts = agg.count_by_key(_events(spark, sf_dir))
    return agg.filter_counts(counts, F.col("key") == F.lit(P.FILTER_KEY))


def _nation_table(spark, sf_dir):
    n = load_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"))


def global_table_lookup(spark, sf_dir):
    recs = _events(spark, sf_dir, key="user_id")
    out = tables.global_table_lookup(recs, _nation_table(spark, sf_dir),
                                     (F.col("key") % F.lit(P.FK_MODULUS)).cast("string"))
    return out.select("key", "seq", "lookup_key", F.col("table_value").alias("nation"))


def fk_join(spark, sf_dir):
    purchases = _events(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    purchases = purchases.filter(F.col("event_type") == "purchase").withColumn(
        "value", F.col("key") % F.lit(P.FK_MODULUS))
    return tables.fk_join(purchases, _nation_table(spark, sf_dir), right_is_snapshot=True)


def fk_join_orders(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("value"))
    customer = load_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"))
    return tables.fk_join(orders, customer, left_is_snapshot=True, right_is_snapshot=True)


# ---------------------------------------------------------------- aggregations
def _fold_inputs(spark, sf_dir):
    recs = _events(spark, sf_dir, key="user_id",
                   extra={"event_type": F.col("event_type"), "props": F.col("props")})
    clicks = recs.filter(F.col("event_type") == "click")
    views = recs.filter(F.col("event_type") == "view")
    return (clicks, views, F.concat(F.lit(agg.COGROUP_FIRST), F.col("value").cast("string")),
            F.concat(F.lit(agg.COGROUP_SECOND), F.col("props")))


def cogroup_fold(spark, sf_dir):
    return agg.cogroup_fold(*_fold_inputs(spark, sf_dir))


def cogroup_fold_parts(spark, sf_dir):
    return agg.cogroup_fold_parts(*_fold_inputs(spark, sf_dir), chunk_rows=P.FOLD_CHUNK)


def word_count(spark, sf_dir):
    return agg.word_count(load_table(spark, sf_dir, "documents").select("text"))


# ---------------------------------------------------------------- windows
def tumbling_count(spark, sf_dir):
    return windows.tumbling(_events(spark, sf_dir), P.TUMBLING_COUNT_SIZE, windows.COUNT,
                            P.TUMBLING_COUNT_GRACE)


def tumbling_sum(spark, sf_dir):
    return windows.tumbling(_events(spark, sf_dir, key="user_id"), P.TUMBLING_SUM_SIZE, windows.SUM, 0)


def hopping_count(spark, sf_dir):
    return windows.hopping(_events(spark, sf_dir), P.HOPPING_SIZE, P.HOPPING_ADVANCE,
                           windows.COUNT, P.HOPPING_GRACE)


def sliding_count(spark, sf_dir):
    return windows.sliding(_events(spark, sf_dir, key="user_id"), P.SLIDING_DIFF, windows.COUNT)


def sliding_sum(spark, sf_dir):
    return windows.sliding(_events(spark, sf_dir, key="user_id"), P.SLIDING_SUM_DIFF, windows.SUM)


def session_count(spark, sf_dir):
    return windows.session(_events(spark, sf_dir, key="user_id"), P.SESSION_COUNT_GAP, windows.COUNT,
                           P.SESSION_COUNT_GRACE)


def session_sum(spark, sf_dir):
    return windows.session(_events(spark, sf_dir, key="user_id"), P.SESSION_SUM_GAP, windows.SUM,
                           P.SESSION_SUM_GRACE)


def window_key_text(spark, sf_dir):
    """Tumbling sum re-keyed to ``key : Window{startMs=…, endMs=…}``."""
    w = tumbling_sum(spark, sf_dir)
    return w.select(window_text(F.col("key").cast("string"), "window_start", "window_end").alias("key"),
                    F.col("total").alias("value"))


def session_key_text(spark, sf_dir):
    """Session sum re-keyed to ``key - start:<instant> end:<instant>``."""
    return _bounds_text(session_sum(spark, sf_dir))


def sliding_key_text(spark, sf_dir):
    """Sliding sum re-keyed to ``key - start:<instant> end:<instant>``."""
    return _bounds_text(sliding_sum(spark, sf_dir))


def _bounds_text(w):
    text = F.format_string(SESSION_KEY_FORMAT, F.col("key").cast("string"),
                           iso_instant("window_start"), iso_instant("window_end"))
    return w.select(text.alias("key"), F.col("total").alias("value"))


def arrival():
    """Arrival order is a deterministic shuffle of event order (ties by id)."""
    return F.expr("seq + (seq * 7919) % 151")


def user_partition():
    """Topics are keyed by user."""
    return F.expr(f"pmod(user_id, {P.PARTITIONS})")


def max_flush_all(spark, sf_dir):
    """Running maxima of users, all sent on whenever the partition's stream time passes a tick."""
    recs = _events(spark, sf_dir, key="user_id", extra={"user_id": F.col("user_id")})
    return punctuation.max_flush_all(recs, P.MAX_STREAM_TICK, arrival(), F.col("seq"), user_partition())


def word_count_flush_all(spark, sf_dir):
    """Words of the events' properties, counted per partition, all sent on at every tick."""
    recs = _events(spark, sf_dir, value="props", extra={"user_id": F.col("user_id")})
    return punctuation.word_count_flush_all(
        recs, P.WORD_COUNT_TICK, lambda df, keep: jvm_tokens(df, F.lower("value"), keep=keep, name="key"), arrival(),
        F.col("seq"), user_partition())


def _late(grace_ms, size_ms=P.TUMBLING_COUNT_SIZE, advance_ms=None):
    def q(spark, sf_dir):
        recs = _events(spark, sf_dir)
        return windows.late_drop_exact(recs, size_ms, grace_ms, arrival(), F.col("seq"), advance_ms=advance_ms)
    return q


def _late_session(kind):
    def q(spark, sf_dir):
        recs = _events(spark, sf_dir, key="user_id", extra={"user_id": F.col("user_id")})
        return late.late_drop_session(recs, P.SESSION_COUNT_GAP, P.LATE_SESSION_GRACE, arrival(), F.col("seq"),
                                      user_partition(), kind)
    return q


def _late_sliding(kind):
    def q(spark, sf_dir):
        recs = _events(spark, sf_dir, key="user_id", extra={"user_id": F.col("user_id")})
        return late.late_drop_sliding(recs, P.SLIDING_DIFF, P.LATE_SLIDING_GRACE, arrival(), F.col("seq"),
                                      user_partition(), kind)
    return q


# ---------------------------------------------------------------- joins
def _join(how):
    def q(spark, sf_dir):
        clicks = _typed_events(spark, sf_dir, "user_id", "click")
        purchases = _typed_events(spark, sf_dir, "user_id", "purchase")
        return joins.interval_join(clicks, purchases, P.JOIN_BOUND, how)
    return q


QUERIES: dict[str, Query] = {
    "stream_scan": stream_scan,
    "table_delete": table_delete,
    "select_key_length": select_key_length,
    "filter_map_upper": filter_map_upper,
    "flatmap_key_chars_count": flatmap_key_chars_count,
    "flatmap_values_scale": flatmap_values_scale,
    "flatmap_values_count": flatmap_values_count,
    "repartition_sum": repartition_sum,
    "sum_by_key": sum_by_key,
    "count_by_key": count_by_key,
    "count_by_value_mod10": count_by_value_mod10,
    "branch_label": branch_label,
    "branch_counts": branch_counts,
    "observe_metrics": observe_metrics,
    "table_latest": table_latest,
    "table_agg_add_subtract": table_agg_add_subtract,
    "table_regroup_sum": table_regroup_sum,
    "table_filter_counts": table_filter_counts,
    "global_table_lookup": global_table_lookup,
    "fk_join": fk_join,
    "fk_join_orders": fk_join_orders,
    "cogroup_fold": cogroup_fold,
    "cogroup_fold_parts": cogroup_fold_parts,
    "word_count": word_count,
    "tumbling_count": tumbling_count,
    "tumbling_sum": tumbling_sum,
    "hopping_count": hopping_count,
    "sliding_count": sliding_count,
    "sliding_sum": sliding_sum,
    "session_count": session_count,
    "session_sum": session_sum,
    "window_key_text": window_key_text,
    "session_key_text": session_key_text,
    "sliding_key_text": sliding_key_text,
    "max_flush_all": max_flush_all,
    "word_count_flush_all": word_count_flush_all,
    **{name: _late(g) for name, g in P.LATE_GRACES.items()},
    "late_drop_hopping": _late(P.LATE_HOPPING_GRACE, P.HOPPING_SIZE, P.HOPPING_ADVANCE),
    "late_drop_session": _late_session(windows.COUNT),
    "late_drop_session_sum": _late_session(windows.SUM),
    "late_drop_sliding": _late_sliding(windows.COUNT),
    "late_drop_sliding_sum": _late_sliding(windows.SUM),
    "ss_join_inner": _join(joins.INNER),
    "ss_join_left": _join(joins.LEFT),
    "ss_join_full": _join(joins.FULL),
}

# Filled by keyflow.streaming.queries (streaming runs whose output is read back).
STREAMING_QUERIES: dict[str, Query] = {}
