from pyspark.sql import functions as F

from conftest import records
from keyflow.operators import tables


def test_table_with_delete(spark):
    cl = records(spark, [("a", 1, 5), ("a", 2, None), ("b", 3, 7)])
    latest = {r.key: r.value for r in tables.table_latest(cl).collect()}
    assert latest == {"b": 7}
    summed = {r.key: r.total for r in tables.table_agg_add_subtract(cl).collect()}
    assert summed == {"a": 0, "b": 7}


def test_table_replace(spark):
    cl = records(spark, [("a", 1, 5), ("a", 2, 3)])
    assert {r.key: r.total for r in tables.table_agg_add_subtract(cl).collect()} == {"a": 3}


def test_key_with_only_deletes_has_no_row(spark):
    cl = records(spark, [("a", 1, None), ("b", 2, 1)])
    assert {r.key: r.total for r in tables.table_agg_add_subtract(cl).collect()} == {"b": 1}


def test_fk_join_inner_keyed_by_left(spark):
    left = records(spark, [("john", 1, 1), ("alex", 2, 2), ("mike", 3, 9)])
    right = records(spark, [("1", 1, "xx"), ("2", 2, "yy")], value_type="string")
    out = {r.key: r.value for r in tables.fk_join(left, right).collect()}
    assert out == {"john": "user: 1 details: xx", "alex": "user: 2 details: yy"}


def test_regroup_by_value_keeps_emptied_groups(spark):
    cl = records(spark, [("a", 1, 5), ("a", 2, 12), ("b", 3, 7), ("b", 4, None), ("c", 5, 15), (None, 6, 40)])
    out = {r.key: r.total for r in tables.table_agg_add_subtract(cl, F.floor(F.col("value") / 10)).collect()}
    assert out == {0: 0, 1: 27}


def test_global_table_lookup_left(spark):
    stream = records(spark, [(1, 1, 10), (2, 2, 20)], key_type="bigint")
    table = spark.createDataFrame([("1", "ONE")], "key string, value string")
    out = tables.global_table_lookup(stream, table, F.col("key").cast("string"))
    assert sorted((r.key, r.table_value) for r in out.collect()) == [(1, "ONE"), (2, None)]
