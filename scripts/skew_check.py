"""Hot-key check: how much of the data lands in the largest reducer partition.

Derives a skewed variant of ``events`` (every click and view belongs to user 0,
about 40% of all rows) and compares hash partitioning by ``key`` alone (what a
plain ``partitionBy(key)`` window, ``session_window`` or equi-join would do)
with the ``(key, time bucket)`` layouts the operators use.

usage: python scripts/skew_check.py [sf_dir] [partitions]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from keyflow.functions.time import floor_div  # noqa: E402
from keyflow.plans import params as P  # noqa: E402
from keyflow.session import build_session  # noqa: E402
from keyflow.sources.records import event_records  # noqa: E402


def max_share(df, n, *cols):
    part = F.pmod(F.hash(*[F.col(c) for c in cols]), F.lit(n))
    sizes = df.groupBy(part.alias("p")).count()
    row = sizes.agg(F.max("count").alias("mx"), F.sum("count").alias("total")).first()
    return round(row.mx / row.total, 4)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 64
    spark = build_session()
    recs = event_records(spark, sf_dir, key="user_id", extra={"event_type": F.col("event_type")})
    hot = recs.withColumn("key", F.when(F.col("event_type").isin("click", "view"), F.lit(0))
                          .otherwise(F.col("key")))
    report = {"partitions": n,
              "hot_key_share": round(hot.filter("key = 0").count() / hot.count(), 4)}
    for name, width in [("sliding", max(8 * (P.SLIDING_DIFF + 1), 3_600_000)),
                        ("session", max(8 * P.SESSION_COUNT_GAP, 86_400_000)),
                        ("interval_join", P.JOIN_BOUND)]:
        b = hot.withColumn("bucket", floor_div("ms", width))
        report[name] = {"by_key": max_share(b, n, "key"), "by_key_bucket": max_share(b, n, "key", "bucket")}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
