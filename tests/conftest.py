import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyflow.session import build_session, ship_package  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="keyflow-tests")
    ship_package(s)
    yield s
    s.stop()


def records(spark, rows, key_type="string", value_type="bigint"):
    """Micro-fixture record frame from (key, ms, value[, seq]) tuples.

    ``seq`` defaults to the position in the list (arrival order).
    """
    from pyspark.sql import functions as F
    full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, f"key {key_type}, ms bigint, value {value_type}, seq bigint")
    return df.withColumn("ts", F.timestamp_millis("ms")).select("key", "value", "ms", "ts", "seq")
