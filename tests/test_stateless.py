from pyspark.sql import functions as F

from conftest import records
from keyflow.functions.text import joiner_text, jvm_split, jvm_tokens
from keyflow.operators import aggregates as agg
from keyflow.operators import stateless


def test_map_filter_passes_and_uppercases(spark):
    df = records(spark, [("one", 1, "first")], value_type="string")
    out = stateless.map_values(stateless.filter_records(df, F.length("value") > 3), F.upper("value"))
    assert [(r.key, r.value) for r in out.collect()] == [("one", "FIRST")]


def test_map_filter_drops_short_values(spark):
    df = records(spark, [("two", 1, "two"), ("three", 2, "third"), ("four", 3, "four")], value_type="string")
    out = stateless.map_values(stateless.filter_records(df, F.length("value") > 3), F.upper("value"))
    assert sorted((r.key, r.value) for r in out.collect()) == [("four", "FOUR"), ("three", "THIRD")]


def test_flat_map_values_scale(spark):
    out = stateless.flat_map_values_scale(records(spark, [("a", 1, 2)]))
    assert sorted(r.value for r in out.collect()) == [20, 200, 2000]


def test_flat_map_key_chars(spark):
    out = stateless.flat_map_key_chars(records(spark, [("bo", 1, 7)]))
    assert sorted((r.key, r.value) for r in out.collect()) == [("B", 7), ("O", 7)]


def test_branch_first_match_and_null_default(spark):
    df = records(spark, [("a", 1, 1), ("a", 2, 2500), ("a", 3, 6000), ("a", 4, None)])
    out = stateless.branch_label(df).orderBy("seq").collect()
    assert [r.branch for r in out] == ["lt-25", "lt-50", "unfiltered", "unfiltered"]
    parts = stateless.split_branches(df)
    assert {k: v.count() for k, v in parts.items()} == {
        "Branch-lt-25": 1, "Branch-lt-50": 1, "Branch-unfiltered": 2}


def test_select_key_length(spark):
    out = stateless.select_key(records(spark, [("john", 1, 1)]), F.length("key"))
    assert out.collect()[0].key == 4


def test_jvm_split_rules(spark):
    df = spark.createDataFrame([(",Hello, World! ",), (",,",), ("",), ("a b",)], "t string")
    got = [r[0] for r in df.select(jvm_split(F.lower("t"))).collect()]
    assert got == [["", "hello", "world"], [], [""], ["a", "b"]]
    toks = jvm_tokens(df.withColumn("id", F.monotonically_increasing_id()), F.lower(F.col("t")), keep=["t"])
    by_text = {}
    for r in toks.collect():
        by_text.setdefault(r.t, []).append(r.tok)
    assert by_text == {",Hello, World! ": ["", "hello", "world"], "": [""], "a b": ["a", "b"]}


def test_word_count_counts_each_token(spark):
    df = spark.createDataFrame([("The cat, the hat.",), ("hat",)], "text string")
    got = {r.word: r.cnt for r in agg.word_count(df).collect()}
    assert got == {"the": 2, "cat": 1, "hat": 2}


def test_joiner_prints_null_for_missing_side(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    assert df.select(joiner_text("a", "b")).collect()[0][0] == "user: null details: x"


def test_observe_tap_passes_rows_and_collects_metrics(spark):
    df = records(spark, [("a", 1000, 5), ("b", 2000, 7)])
    out, obs = stateless.observe_tap(df, "t1")
    assert out.count() == 2
    assert obs.get == {"records": 2, "max_value": 7, "max_ms": 2000}


def test_cogroup_fold_in_arrival_order(spark):
    first = records(spark, [("a", 1, 5, 1)])
    second = records(spark, [("a", 2, "x", 2)], value_type="string")
    out = agg.cogroup_fold(first, second,
                           F.concat(F.lit(" first "), F.col("value").cast("string")),
                           F.concat(F.lit(" second "), F.col("value")))
    assert [(r.key, r.value) for r in out.collect()] == [("a", "  first 5 second x")]


def test_cogroup_fold_chunking_is_invisible(spark):
    rows = [("k", i, i, i) for i in range(50)]
    first = records(spark, [r for r in rows if r[3] % 3])
    second = records(spark, [r for r in rows if not r[3] % 3])
    p1 = F.concat(F.lit(" first "), F.col("value").cast("string"))
    p2 = F.concat(F.lit(" second "), F.col("value").cast("string"))
    a = agg.cogroup_fold(first, second, p1, p2, chunk_rows=4).collect()
    b = agg.cogroup_fold(first, second, p1, p2, chunk_rows=1 << 20).collect()
    assert a == b
    expected = " " + "".join((" first " if i % 3 else " second ") + str(i) for i in range(50))
    assert a[0].value == expected
