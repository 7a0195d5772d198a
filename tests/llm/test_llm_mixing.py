import re
from math import comb

import pytest
from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F

from keyflow.llm import mixing as M


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes):
    """Water filling over sources in code point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        t = {s: 3 * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        capped |= over


def check(spark, folder):
    docs = [(r.doc_id, words(r.text), r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    sizes = {}
    for _, n, s in docs:
        sizes[s] = sizes.get(s, 0) + n
    want = targets(sizes) if sizes else {}
    rows = M.op9_mixing(spark, folder).collect()
    assert sorted(((r.doc_id, r["size"], r.source_size) for r in rows), key=repr) == sorted(
        ((i, n, sizes[s]) for i, n, s in docs), key=repr)
    assert sorted(r.target for r in rows) == pytest.approx(sorted(want[s] for _, _, s in docs))
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    taken = {}
    for r in rows:
        taken.setdefault(round(r.target, 6), []).append(r.taken)
    for t, got in taken.items():
        n = sum(abs(x - t) < 1e-5 for x in want.values())  # sources with this target
        assert abs(sum(got) - n * t) <= n * M.BLOCK / 2 + 1
    assert rows == M.op9_mixing(spark, folder).collect() or sorted(rows) == sorted(M.op9_mixing(spark, folder).collect())
    return rows


def test_query_against_water_filling(spark):
    check(spark, SF)


def test_odd_rows_and_empty_table(spark, tmp_path):
    check(spark, on_tables(spark, tmp_path / "a", documents=odd_docs(spark)))
    assert check(spark, on_tables(spark, tmp_path / "b", documents=no_docs(spark))) == []


def test_every_shard_has_its_exact_quota(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.sized_rows(docs, ["doc_id", "text"])
    _, mix = M.mixture(rows, shard_blocks=50)
    mix = mix.cache()
    per = [r.n for r in mix.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per) > 8 and max(per) - min(per) <= 1
    assert mix.select("rid", "block", "round").distinct().count() == mix.count()  # disjoint
    _, again = M.mixture(rows, shard_blocks=50)
    assert mix.exceptAll(again.select(mix.columns)).count() == 0
    mix.unpersist()


def test_quotas_add_up(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 1), ("c", 0), (None, 333)], "source string, quota bigint")
    for n in (1, 2, 7, 16):
        out = M.split_quotas(quotas, n, seed=3)
        per = {r.source: (r.s, r.h) for r in out.groupBy("source").agg(
            F.sum(F.col("high") - F.col("low")).alias("s"), F.max("high").alias("h")).collect()}
        assert per == {"a": (1000, 1000), "b": (1, 1), None: (333, 333)}
        shards = [r.s for r in out.groupBy("shard").agg(F.sum(F.col("high") - F.col("low")).alias("s")).collect()]
        assert len(shards) == n and max(shards) - min(shards) <= 1
        # the large source is spread about evenly
        big = [r.high - r.low for r in out.where("source = 'a'").collect()]
        assert max(big) - min(big) <= 40


def test_mixed_documents(spark):
    df = odd_docs(spark)
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    rows = M.sized_rows(df, df.columns)
    _, mix = M.mixture(rows)
    want = mix.agg(F.sum("words")).first()[0]
    got = out.collect()
    assert sum(words(r.text) for r in got) == want
    whole = {r.text for r in df.collect() if r.text}
    for r in got:
        assert r.n_chars == len(r.text)
        blocks = re.findall(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,64}", r.text)
        assert any(all(b in t for b in blocks[:-1]) and blocks[-1].strip() in t for t in whole)
    assert M.mixed_documents(no_docs(spark)).count() == 0


@pytest.mark.parametrize("more,good,want", [(10, 4, 5), (40, 1, 20), (60, 30, 7), (3000, 900, 1500), (9, 9, 4), (5, 0, 3), (1, 1, 1)])
def test_draws_follow_the_hypergeometric_distribution(spark, more, good, want):
    n = 12_000
    out = spark.range(n).select(M.hypergeometric(
        *[F.lit(x).cast("bigint") for x in (more, good, want)], M.uniform(7, F.col("id"))).alias("d"))
    got = {r.d: r["count"] for r in out.groupBy("d").count().collect()}
    chance = {x: comb(good, x) * comb(more - good, want - x) / comb(more, want) for x in range(good + 1) if 0 <= want - x <= more - good}
    assert set(got) <= set(chance)
    # outcomes with few expected draws are one class
    cells = [(got.get(x, 0), p * n) for x, p in chance.items() if p * n >= 8]
    cells.append((n - sum(c[0] for c in cells), n - sum(c[1] for c in cells)))
    square = sum((g - e) ** 2 / e for g, e in cells if e > 0.5)
    free = max(1, len(cells) - 1)
    assert square < free + 5 * (2 * free) ** 0.5 + 8


def test_draws_of_large_numbers(spark):
    """Far beyond what factorials in doubles could hold: mean and deviation of the draws."""
    more, good, want = 4_000_000_000, 1_000_000_000, 1_000_000
    out = spark.range(300).select(M.hypergeometric(*[F.lit(x).cast("bigint") for x in (more, good, want)],
                                                   M.uniform(3, F.col("id"))).alias("d"))
    mean, deviation = out.agg(F.avg("d"), F.stddev("d")).first()
    sd = (want * 0.25 * 0.75) ** 0.5
    assert abs(mean - want / 4) < 4 * sd / 300 ** 0.5 and 0.85 * sd < deviation < 1.15 * sd
