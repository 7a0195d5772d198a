import random
import re

import xxhash
from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F

from keyflow.llm.components import connected_components
from keyflow.llm.simhash import fingerprint_links, keep_one, op3_simhash_neardup

LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs):
    """Rows (id, hex, smallest id reachable) by comparing all fingerprints."""
    fps = {fingerprint(t) for _, t in docs}
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                root[top(a)] = top(b)
    low = {}
    for i, t in docs:
        k = top(fingerprint(t))
        if i is not None:
            low[k] = min(low.get(k, i), i)
    return sorted(((i, f"{fingerprint(t):016x}", low.get(top(fingerprint(t)))) for i, t in docs), key=repr)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op3_simhash_neardup(spark, SF).collect()), key=repr)
    assert got == brute(docs)


def test_odd_rows(spark, tmp_path):
    df = odd_docs(spark)
    got = op3_simhash_neardup(spark, on_tables(spark, tmp_path, documents=df))
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)
    kept = keep_one(df)
    assert kept.columns == df.columns
    # copies and empty texts leave one row, that with the smallest id
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted({c or -1 for _, _, c in brute(docs)})


def test_empty_table(spark, tmp_path):
    assert op3_simhash_neardup(spark, on_tables(spark, tmp_path, documents=no_docs(spark))).count() == 0
    assert keep_one(no_docs(spark)).count() == 0


def test_links_reach_all_near_pairs(spark):
    rng = random.Random(3)
    fps = {0}
    for _ in range(12):  # chains and balls of near fingerprints
        f = rng.getrandbits(64)
        for _ in range(25):
            f ^= 1 << rng.randrange(64)
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    for bits in (1, 2, 3):
        links = fingerprint_links(spark.createDataFrame(signed, "fp bigint"), bits)
        near = [(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits]
        got = {(min(r), max(r)) for r in links.collect()}
        assert got <= set(near)
        if bits % 2:
            assert got == set(near)
        found = dict(map(tuple, connected_components(links).collect()))
        assert all(found[a] == found[b] for a, b in near)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(7, 7), (200, 300), (300, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").union(spark.createDataFrame([(5, None)], "a bigint, b bigint"))
    got = dict(map(tuple, connected_components(df).collect()))
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 50)} | {200: 200, 300: 200}
    assert got == want
    assert connected_components(df.where(F.lit(False))).count() == 0
