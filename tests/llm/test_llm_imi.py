import numpy as np
import pytest
from llm_cases import SF, on_tables

from keyflow.llm import imi


def brute(vectors, top=20):
    """Per query: (id, score) of all others, nearest first, ties to the smaller id."""
    ids = np.array(sorted(vectors))
    x = np.stack([vectors[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = (x * vectors[q]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:top]
        out[int(q)] = [(int(ids[k]), s[k]) for k in order]
    return out


def check(spark, folder, vectors, least, floor=0.0):
    found = {}
    for r in imi.op7_imi_search(spark, folder).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want, hits, total = brute(vectors), 0, 0
    assert set(found) == set(want)
    for q, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        assert all(i != q and s == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-12) for _, i, s in rows)
        hit = len({i for _, i, _ in rows} & {i for i, _ in want[q]})
        assert hit >= floor * len(want[q])
        hits += hit
        total += len(want[q])
    assert hits >= least * total


def test_recall_against_brute_force(spark):
    for folder in (SF, "/root/testdata/sf0.1"):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
        check(spark, folder, {r.vec_id: np.array(r.embedding, float) for r in rows}, 0.9, 0.4)


def test_least_recall_on_clusters_of_all_sizes(spark, tmp_path):
    """Dense clusters, sparse ones and single vectors: no query may miss all its neighbours."""
    rng = np.random.default_rng(5)
    parts = [rng.normal(size=16) * rng.uniform(0.3, 3) + rng.normal(size=(n, 16)) * w
             for n, w in [(2500, 0.05), (1500, 0.4), *[(60, 0.3)] * 20, *[(1, 1.0)] * 300]]
    x = np.concatenate(parts)[rng.permutation(sum(map(len, parts)))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    check(spark, on_tables(spark, tmp_path, embeddings=df), dict(enumerate(x)), 0.93, 0.5)


def test_repeated_ids_and_mixed_lengths(spark, tmp_path):
    """Every row is a candidate of its own; each length is searched apart."""
    rng = np.random.default_rng(6)
    rows = [(i % 50, rng.normal(size=d).round(2)) for i in range(100) for d in (4, 6)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.vec_id, round(r.score, 9)) for r in
                 imi.neighbours(spark.read.parquet(f"{on_tables(spark, tmp_path, embeddings=df)}/embeddings.parquet"), top=200).collect())
    want = sorted((i, k, round(float((v * w).sum()), 9)) for a, (i, v) in enumerate(rows) if i % 20 == 0
                  for b, (k, w) in enumerate(rows) if a != b and len(v) == len(w))
    assert got == want


def test_hot_vector_and_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)).round(3)
    x[100:260] = x[7]  # a hot vector
    good = {i: v for i, v in enumerate(x)}
    rows = [(i, v.tolist(), 1) for i, v in good.items()]
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1020, [1.0, None] + [0.0] * 6, 1), (1040, [float("nan")] + [1.0] * 7, 1),
             (1060, [float("inf")] + [1.0] * 7, 1), (1080, [1.0] * 5, 1), (1100, [], 1), (None, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, first int")
    folder = on_tables(spark, tmp_path / "a", embeddings=df)
    check(spark, folder, good, 0.9)
    hot = [(r["rank"], r.vec_id) for r in imi.op7_imi_search(spark, folder).where("query_id = 120").collect()]
    assert sorted(hot) == [(k + 1, i) for k, i in enumerate([7, *[i for i in range(100, 121) if i != 120]][:20])]
    assert imi.op7_imi_search(spark, on_tables(spark, tmp_path / "b", embeddings=df.limit(0))).count() == 0
    few = df.where("vec_id in (20, 21, 40)")
    assert imi.op7_imi_search(spark, on_tables(spark, tmp_path / "c", embeddings=few)).count() == 4


@pytest.mark.parametrize("margin", [0.0, 0.3, 1.0, 100.0])
def test_heap_visits_cells_by_descending_sum(margin):
    rng = np.random.default_rng(1)
    index = imi.MultiIndex(rng.normal(size=(6, 4)), rng.normal(size=(5, 4)), margin)
    counts, q = rng.integers(0, 4, (6, 5)), rng.normal(size=8)
    order = sorted(((-(index.first[i] @ q[:4] + index.second[j] @ q[4:]), i, j) for i in range(6) for j in range(5)))
    for enough in range(1, int(counts.sum()) + 1):
        want, got, last = {}, 0, np.inf
        for key, i, j in order:
            if key > last:
                break
            if counts[i, j]:
                want[i] = want.get(i, 0) | 1 << j
                got += counts[i, j]
                if got >= enough and last == np.inf:
                    last = key + margin * np.sqrt(q @ q)
        assert index.visits(q, counts.tolist(), enough) == want


def test_every_query_returns_all_its_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.uniform(1, 2, (40, 8)), 45, axis=0)  # copy groups
    x[::100] = -rng.uniform(5, 9, (18, 8))                 # a few outliers on the other side, all of them queries
    for n in (1800, 15):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:n])], "vec_id bigint, embedding array<double>")
        out = imi.op7_imi_search(spark, on_tables(spark, tmp_path / str(n), embeddings=df))
        found = {r.query_id: r["count"] for r in out.groupBy("query_id").count().collect()}
        assert found == {i: min(20, n - 1) for i in range(0, n, 20)}


def test_groups_of_queries():
    assert imi.query_groups([3, 0, 4, 5, 25, 2, 9], 10) == ([0, 0, 0, 1, 2, 5, 6], [1, 1, 1, 1, 3, 1, 1])
    assert imi.query_groups([0, 0], 10) == ([0, 0], [1, 1])
