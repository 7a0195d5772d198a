"""DuckDB oracle SQL for every registered batch query.

Views ``events``, ``nation``, ``orders``, ``customer``, ``documents`` … are the
driver's parquet tables. Event time is ``epoch_us(ts) // 1000`` (DuckDB's
``epoch_ms`` rounds; Spark floors), money is exact cents, window bounds are
integer epoch arithmetic (``time_bucket`` uses another origin).
"""

from __future__ import annotations

from keyflow.plans import params as P

R = """WITH r AS (
  SELECT event_id AS seq, event_type, user_id, props,
         CAST(round(value * 100) AS BIGINT) AS cents,
         epoch_us(ts) // 1000 AS ms
  FROM events)
"""

CHANGELOG = R + """, t AS (
  SELECT user_id AS key, CASE WHEN event_type = 'error' THEN NULL ELSE cents END AS value, seq FROM r),
l AS (SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM t)
"""

TOKENS_SPLIT = """regexp_split_to_array({text}, '\\W+')"""


def _jvm_tokens(text: str, key: str | None) -> str:
    arr = TOKENS_SPLIT.format(text=text)
    key_sel = f"{key} AS key, " if key else ""
    return f"""a AS (SELECT {key_sel}{arr} AS arr FROM documents),
tk AS (SELECT {'key, ' if key else ''}unnest(arr) AS tok, unnest(generate_series(1, len(arr))) AS pos, arr FROM a),
jt AS (SELECT {'key, ' if key else ''}tok FROM tk
       WHERE (tok <> '' OR pos = 1)
         AND NOT (len(arr) > 1 AND array_to_string(arr, '') = ''))
"""


def _tumbling(key: str, size: int, agg: str, name: str) -> str:
    return R + f"""SELECT {key} AS key, (ms // {size}) * {size} AS window_start,
       (ms // {size}) * {size} + {size} AS window_end, {agg} AS {name}
FROM r GROUP BY ALL"""


def _hopping(key: str, size: int, adv: int) -> str:
    n = -(-size // adv)  # candidate starts per record
    return R + f""", s AS (
  SELECT {key} AS key, ms, (ms // {adv}) * {adv} - k * {adv} AS window_start
  FROM r, range(0, {n}) AS g(k))
SELECT key, window_start, window_start + {size} AS window_end, count(*) AS cnt
FROM s WHERE window_start <= ms AND ms < window_start + {size}
GROUP BY ALL"""


def _sliding(d: int, agg: str, name: str) -> str:
    return R + f""", e AS (SELECT user_id AS k, ms, cents FROM r),
p AS (SELECT DISTINCT k, ms FROM e),
nx AS (SELECT k, ms, lead(ms) OVER (PARTITION BY k ORDER BY ms) AS nxt FROM p),
st AS (SELECT k, ms - {d} AS s FROM p
       UNION SELECT k, ms + 1 AS s FROM nx WHERE nxt <= ms + 1 + {d})
SELECT st.k AS key, st.s AS window_start, st.s + {d} AS window_end, {agg} AS {name}
FROM st JOIN e ON e.k = st.k AND e.ms BETWEEN st.s AND st.s + {d}
GROUP BY ALL"""


def _session(gap: int, agg: str, name: str) -> str:
    return R + f""", g AS (
  SELECT user_id AS key, ms, cents,
         CASE WHEN ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, seq) <= {gap} THEN 0 ELSE 1 END AS brk
  FROM r),
s AS (SELECT *, sum(brk) OVER (PARTITION BY key ORDER BY ms ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT key, min(ms) AS window_start, max(ms) AS window_end, {agg} AS {name}
FROM s GROUP BY key, sid"""


# records of a partition in arrival order: position and stream time
ARRIVED = R + f"""
, a AS (SELECT *, user_id % {P.PARTITIONS} AS partition, seq + (seq * 7919) % 151 AS arr FROM r),
s AS (SELECT *, max(ms) OVER w AS st, row_number() OVER w AS n
      FROM a WINDOW w AS (PARTITION BY partition ORDER BY arr, seq ROWS UNBOUNDED PRECEDING))"""


def _flushes(tick: int) -> str:
    return ARRIVED + f""",
t AS (SELECT partition, st // {tick} AS tick, min(n) AS n, min(st) AS stream_time FROM s GROUP BY ALL)"""


def _word_flushes() -> str:
    return _flushes(P.WORD_COUNT_TICK) + """,
b AS (SELECT partition, n, regexp_split_to_array(lower(props), '\\W+') AS arr FROM s),
u AS (SELECT partition, n, unnest(arr) AS word, unnest(generate_series(1, len(arr))) AS pos, arr FROM b),
w AS (SELECT partition, n, word FROM u WHERE (word <> '' OR pos = 1)
      AND NOT (len(arr) > 1 AND array_to_string(arr, '') = ''))
SELECT t.partition, word, CAST(count(*) AS VARCHAR) AS count, stream_time
FROM t JOIN w ON w.partition = t.partition AND w.n <= t.n GROUP BY t.partition, tick, stream_time, word"""


def _late_session(measure: str, name: str) -> str:
    """A key's records one by one, against the list of its sessions."""
    gap, grace = P.SESSION_COUNT_GAP, P.LATE_SESSION_GRACE
    near = "x.a <= ms + {0} AND x.b >= ms - {0} AND x.b >= close".format(gap)
    return ARRIVED.replace("WITH r AS", "WITH RECURSIVE r AS") + f""",
e AS MATERIALIZED (SELECT user_id AS key, ms, {measure} AS v, st - {grace + gap} AS close,
      row_number() OVER (PARTITION BY user_id ORDER BY arr, seq) AS i FROM s),
z(key, i, ss) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), CAST([] AS STRUCT(a BIGINT, b BIGINT, v BIGINT)[]) FROM e
  UNION ALL
  SELECT key, i, CASE WHEN len(near) = 0 AND ms < close THEN ss ELSE list_append(far, struct_pack(
      a := list_min(list_append(list_transform(near, lambda x: x.a), ms)),
      b := list_max(list_append(list_transform(near, lambda x: x.b), ms)),
      v := CAST(list_sum(list_append(list_transform(near, lambda x: x.v), v)) AS BIGINT))) END
  FROM (SELECT z.key, e.i, ss, ms, v, close, list_filter(ss, lambda x: {near}) AS near,
               list_filter(ss, lambda x: NOT ({near})) AS far
        FROM z JOIN e ON e.key = z.key AND e.i = z.i + 1) q),
f AS (SELECT key, unnest(arg_max(ss, i)) AS x FROM z GROUP BY key)
SELECT key, x.a AS window_start, x.b AS window_end, x.v AS {name} FROM f"""


def _late_sliding(agg: str, name: str) -> str:
    d, grace = P.SLIDING_DIFF, P.LATE_SLIDING_GRACE
    return ARRIVED + f""",
b AS (SELECT user_id AS key, ms - {d} AS a FROM s WHERE ms + {grace} > st
      UNION SELECT user_id, ms + 1 FROM s WHERE ms + {1 + d + grace} > st)
SELECT key, a AS window_start, a + {d} AS window_end, {agg} AS {name}
FROM b JOIN s ON s.user_id = b.key AND ms BETWEEN a AND a + {d} AND a + {d + grace} > st GROUP BY key, a"""


def _late(grace: int) -> str:
    size = P.TUMBLING_COUNT_SIZE
    return R + f""", a AS (
  SELECT event_type AS key, ms, seq, seq + (seq * 7919) % 151 AS arr FROM r),
s AS (SELECT *, max(ms) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM a)
SELECT key, (ms // {size}) * {size} AS window_start, (ms // {size}) * {size} + {size} AS window_end,
       count(*) AS cnt
FROM s WHERE (ms // {size}) * {size} + {size + grace} > st
GROUP BY ALL"""


def _late_hopping(grace: int) -> str:
    size, adv = P.HOPPING_SIZE, P.HOPPING_ADVANCE
    return R + f""", a AS (
  SELECT event_type AS key, ms, seq, seq + (seq * 7919) % 151 AS arr FROM r),
s AS (SELECT *, max(ms) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM a),
w AS (SELECT key, ms, st, (ms // {adv}) * {adv} - k * {adv} AS window_start FROM s, range(0, {-(-size // adv)}) AS g(k))
SELECT key, window_start, window_start + {size} AS window_end, count(*) AS cnt
FROM w WHERE window_start + {size} > ms AND window_start + {size + grace} > st
GROUP BY ALL"""


def _join(kind: str) -> str:
    b = P.JOIN_BOUND
    key = "coalesce(l.key, x.key)" if kind.startswith("FULL") else "l.key"
    return R + f""", l AS (SELECT user_id AS key, seq, ms, cents AS v FROM r WHERE event_type = 'click'),
x AS (SELECT user_id AS key, seq, ms, cents AS v FROM r WHERE event_type = 'purchase')
SELECT {key} AS key, l.seq AS left_seq, x.seq AS right_seq, l.ms AS left_ms, x.ms AS right_ms,
       'user: ' || coalesce(CAST(l.v AS VARCHAR), 'null') || ' details: ' || coalesce(CAST(x.v AS VARCHAR), 'null') AS value
FROM l {kind} JOIN x ON l.key = x.key AND abs(l.ms - x.ms) <= {b}"""


def _window_text() -> str:
    size = P.TUMBLING_SUM_SIZE
    return R + f"""SELECT CAST(user_id AS VARCHAR) || ' : Window{{startMs=' || CAST((ms // {size}) * {size} AS VARCHAR)
       || ', endMs=' || CAST((ms // {size}) * {size} + {size} AS VARCHAR) || '}}' AS key,
       CAST(sum(cents) AS BIGINT) AS value
FROM r GROUP BY user_id, ms // {size}"""


def _iso(col: str) -> str:
    return (f"strftime(make_timestamp(({col} // 1000) * 1000000), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN {col} % 1000 = 0 THEN '' ELSE '.' || lpad(CAST({col} % 1000 AS VARCHAR), 3, '0') END || 'Z'")


def _session_text() -> str:
    inner = _session(P.SESSION_SUM_GAP, "CAST(sum(cents) AS BIGINT)", "total")
    return f"""SELECT CAST(key AS VARCHAR) || ' - start:' || {_iso('window_start')} || ' end:' || {_iso('window_end')} AS key,
       total AS value FROM ({inner}) q"""


def _sliding_text() -> str:
    inner = _sliding(P.SLIDING_SUM_DIFF, "CAST(sum(e.cents) AS BIGINT)", "total")
    return f"""SELECT CAST(key AS VARCHAR) || ' - start:' || {_iso('window_start')} || ' end:' || {_iso('window_end')} AS key,
       total AS value FROM ({inner}) q"""


ORACLE_SQL: dict[str, str] = {
    "stream_scan": R + "SELECT event_type AS key, cents AS value, ms, seq FROM r",
    "observe_metrics": R + "SELECT count(*) AS records, max(cents) AS max_value, max(ms) AS max_ms FROM r",
    "table_delete": R + "SELECT user_id AS key, CASE WHEN event_type = 'error' THEN NULL ELSE cents END AS value, seq FROM r",
    "select_key_length": R + "SELECT CAST(length(CAST(user_id AS VARCHAR)) AS BIGINT) AS key, cents AS value, seq FROM r",
    "filter_map_upper": "WITH " + _jvm_tokens("text", "doc_id")
    + f"SELECT key, upper(tok) AS value FROM jt WHERE length(tok) > {P.MIN_VALUE_LENGTH}",
    "flatmap_key_chars_count": R + """SELECT upper(c) AS key, count(*) AS cnt
FROM r, unnest(string_split(event_type, '')) AS u(c) WHERE c <> '' GROUP BY ALL""",
    "flatmap_values_scale": R + """SELECT event_type AS key, unnest([cents * 10, cents * 100, cents * 1000]) AS value, seq FROM r""",
    "flatmap_values_count": R + "SELECT event_type AS key, 3 * count(*) AS cnt FROM r GROUP BY ALL",
    "repartition_sum": R + "SELECT event_type AS key, CAST(sum(cents) AS BIGINT) AS total FROM r GROUP BY ALL",
    "sum_by_key": R + "SELECT event_type AS key, CAST(sum(cents) AS BIGINT) AS total FROM r GROUP BY ALL",
    "count_by_key": R + "SELECT event_type AS key, count(cents) AS cnt FROM r GROUP BY ALL",
    "count_by_value_mod10": R + "SELECT cents % 10 AS key, count(*) AS cnt FROM r GROUP BY ALL",
    "branch_label": R + """SELECT event_type AS key, cents AS value, seq,
       CASE WHEN cents < 2500 THEN 'lt-25' WHEN cents < 5000 THEN 'lt-50' ELSE 'unfiltered' END AS branch FROM r""",
    "branch_counts": R + """SELECT CASE WHEN cents < 2500 THEN 'lt-25' WHEN cents < 5000 THEN 'lt-50' ELSE 'unfiltered' END AS branch,
       count(*) AS cnt FROM r GROUP BY ALL""",
    "table_latest": CHANGELOG + "SELECT key, value FROM l WHERE rn = 1 AND value IS NOT NULL",
    "table_agg_add_subtract": CHANGELOG + """SELECT key, CAST(coalesce(value, 0) AS BIGINT) AS total FROM l
WHERE rn = 1 AND key IN (SELECT key FROM t WHERE value IS NOT NULL)""",
    "table_regroup_sum": CHANGELOG + """, g AS (SELECT DISTINCT value % 10 AS key FROM t WHERE value IS NOT NULL),
s AS (SELECT value % 10 AS key, sum(value) AS total FROM l WHERE rn = 1 AND value IS NOT NULL GROUP BY ALL)
SELECT g.key, CAST(coalesce(s.total, 0) AS BIGINT) AS total FROM g LEFT JOIN s USING (key)""",
    "table_filter_counts": R + f"SELECT event_type AS key, count(cents) AS cnt FROM r WHERE event_type = '{P.FILTER_KEY}' GROUP BY ALL",
    "global_table_lookup": R + f"""SELECT r.user_id AS key, r.seq, CAST(r.user_id % {P.FK_MODULUS} AS VARCHAR) AS lookup_key, n.n_name AS nation
FROM r LEFT JOIN nation n ON CAST(r.user_id % {P.FK_MODULUS} AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)""",
    "fk_join": R + f""", p AS (SELECT user_id AS key, user_id % {P.FK_MODULUS} AS value, seq,
                  row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
           FROM r WHERE event_type = 'purchase')
SELECT p.key, 'user: ' || CAST(p.value AS VARCHAR) || ' details: ' || n.n_name AS value
FROM p JOIN nation n ON CAST(p.value AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR) WHERE p.rn = 1""",
    "fk_join_orders": """SELECT o.o_orderkey AS key, 'user: ' || CAST(o.o_custkey AS VARCHAR) || ' details: ' || c.c_name AS value
FROM orders o JOIN customer c ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)""",
    "cogroup_fold": R + """, pc AS (
  SELECT user_id AS key, seq, ' first ' || CAST(cents AS VARCHAR) AS piece FROM r WHERE event_type = 'click'
  UNION ALL
  SELECT user_id AS key, seq, ' second ' || props AS piece FROM r WHERE event_type = 'view')
SELECT key, ' ' || string_agg(piece, '' ORDER BY seq) AS value FROM pc GROUP BY key""",
    "cogroup_fold_parts": R + f""", pc AS (
  SELECT user_id AS key, seq, ' first ' || CAST(cents AS VARCHAR) AS piece FROM r WHERE event_type = 'click'
  UNION ALL
  SELECT user_id AS key, seq, ' second ' || props AS piece FROM r WHERE event_type = 'view')
SELECT key, seq // {P.FOLD_CHUNK} AS chunk, string_agg(piece, '' ORDER BY seq) AS part FROM pc GROUP BY ALL""",
    "word_count": "WITH " + _jvm_tokens("lower(text)", None) + "SELECT tok AS word, count(*) AS cnt FROM jt GROUP BY tok",
    "tumbling_count": _tumbling("event_type", P.TUMBLING_COUNT_SIZE, "count(*)", "cnt"),
    "tumbling_sum": _tumbling("user_id", P.TUMBLING_SUM_SIZE, "CAST(sum(cents) AS BIGINT)", "total"),
    "hopping_count": _hopping("event_type", P.HOPPING_SIZE, P.HOPPING_ADVANCE),
    "sliding_count": _sliding(P.SLIDING_DIFF, "count(*)", "cnt"),
    "sliding_sum": _sliding(P.SLIDING_SUM_DIFF, "CAST(sum(e.cents) AS BIGINT)", "total"),
    "session_count": _session(P.SESSION_COUNT_GAP, "count(*)", "cnt"),
    "session_sum": _session(P.SESSION_SUM_GAP, "CAST(sum(cents) AS BIGINT)", "total"),
    "window_key_text": _window_text(),
    "session_key_text": _session_text(),
    **{name: _late(g) for name, g in P.LATE_GRACES.items()},
    "late_drop_hopping": _late_hopping(P.LATE_HOPPING_GRACE),
    "sliding_key_text": _sliding_text(),
    "late_drop_session": _late_session("CAST(1 AS BIGINT)", "cnt"),
    "late_drop_session_sum": _late_session("cents", "total"),
    "late_drop_sliding": _late_sliding("count(*)", "cnt"),
    "late_drop_sliding_sum": _late_sliding("CAST(sum(cents) AS BIGINT)", "total"),
    "max_flush_all": _flushes(P.MAX_STREAM_TICK) + """
SELECT t.partition, user_id AS key, max(cents) AS value, stream_time
FROM t JOIN s ON s.partition = t.partition AND s.n <= t.n GROUP BY t.partition, tick, stream_time, user_id""",
    "word_count_flush_all": _word_flushes(),
    "ss_join_inner": _join("INNER"),
    "ss_join_left": _join("LEFT"),
    "ss_join_full": _join("FULL OUTER"),
}
