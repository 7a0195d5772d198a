"""Query parameters.

Fixed values: the reference's durations scaled by 36,000 (100 ms → 1 h), because
the driver's events are hours apart where the reference's demo records are
milliseconds apart. Thresholds, factors and formats are the reference's own.
"""

HOUR = 3_600_000
MINUTE = 60_000

TUMBLING_COUNT_SIZE = 6 * HOUR          # 600 ms
TUMBLING_COUNT_GRACE = 3 * HOUR + 30 * MINUTE  # 350 ms
TUMBLING_SUM_SIZE = 100 * HOUR          # 10 s, no grace
HOPPING_SIZE = 3 * HOUR                 # 300 ms
HOPPING_ADVANCE = 2 * HOUR              # 200 ms
HOPPING_GRACE = 10 * HOUR               # 1000 ms
SLIDING_DIFF = 3 * HOUR                 # 300 ms (count)
SLIDING_SUM_DIFF = 100 * HOUR           # 10 s
SLIDING_SUM_GRACE = 50 * HOUR           # 5 min
SESSION_COUNT_GAP = 3 * HOUR            # 300 ms
SESSION_COUNT_GRACE = 10 * HOUR         # 1000 ms
SESSION_SUM_GAP = 30 * HOUR             # 3 s
SESSION_SUM_GRACE = 50 * HOUR           # 5 min
JOIN_BOUND = 15 * HOUR                  # 1500 ms, no grace
WORD_COUNT_TICK = 10 * HOUR             # 1 s stream-time punctuation
MAX_STREAM_TICK = 100 * HOUR            # 10 s stream-time punctuation
MAX_WALL_CLOCK_SECONDS = 60             # 60 s wall-clock punctuation
LATE_GRACES = {"late_drop_exact": TUMBLING_COUNT_GRACE, "late_drop_exact_grace_1h": HOUR,
               "late_drop_exact_no_grace": 0}
FOLD_CHUNK = 1 << 10                    # arrival positions per part of the ordered fold
LATE_HOPPING_GRACE = HOUR               # small, so that records are late
LATE_SESSION_GRACE = HOUR
LATE_SLIDING_GRACE = HOUR
HIGH_SEED = 10 ** 12                    # above every value, so that an ignored seed shows
REPARTITION_WIDTH = 6
FK_MODULUS = 25                         # events → nation foreign key: user_id % 25
FILTER_KEY = "click"                    # the reference filters its count table on "book"
MIN_VALUE_LENGTH = 3                    # filter(v.length() > 3)
PARTITIONS = 4                          # source partitions of the per-partition queries
FILTER_VALUE = 5000                     # cents; the filtered table's predicate over the value
