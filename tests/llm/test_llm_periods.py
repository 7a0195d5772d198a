"""Runs of repeated words, against their definition."""

import hashlib
import random
from zlib import crc32

import numpy as np

from keyflow.llm import periods
from llm_cases import SF, no_docs, odd_docs, on_tables


def brute_runs(words, least=24, times=3):
    """Per period the maximal stretches with that distance between equal words; smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                start, end = i, j + q
                # a smaller period of the same stretch was found before
                if not any(s <= start and end <= e for s, e in found.values()) or not any(
                        all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q)):
                    if end - start >= max(least, times * q):
                        found[start, q] = (start, end)
            i = j + 1
    return sorted(((s, e - s, q) for (s, q), (_, e) in found.items()), key=lambda r: (r[0], r[2]))


def brute_words(doc_id, text):
    words = [] if text is None else [w for w in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    n = len(words)
    if doc_id is None or not n or crc32(str(doc_id).encode()) % 10:
        return words
    g = crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    words = brute_words(doc_id, text)
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def test_least_prefix():
    assert periods.least_prefix(24, 3) == 16


def test_suffix_order_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        words = np.array([rng.randrange(3) for _ in range(rng.randrange(1, 60))])
        order, lcp = periods.suffix_neighbours(words)
        text = [words[i:].tolist() for i in order]
        assert text == sorted(text)
        for k in range(1, len(text)):
            common = next((i for i, (x, y) in enumerate(zip(text[k - 1], text[k], strict=False)) if x != y),
                          min(len(text[k - 1]), len(text[k])))
            assert lcp[k] == common


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(400):
        words = []
        while len(words) < rng.randrange(20, 160):
            piece = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(1, 13))]
            words += (piece * rng.randrange(1, 9))[:rng.randrange(1, 90)]
        got = periods.find_runs(np.array(words), 12, 2), periods.find_runs(np.array(words))
        assert got == (brute_runs(words, 12, 2), brute_runs(words))


def test_batches_find_the_same(monkeypatch):
    rng = random.Random(7)
    texts = []
    for _ in range(200):
        piece = [str(rng.randrange(50)).encode() for _ in range(rng.randrange(1, 30))]
        texts.append(([b"a", b"b"] + piece * rng.randrange(1, 6) + [b"c"])[:rng.randrange(120)])
    got = [o[1] for o in periods.scan_batch(texts, 24, 3)]
    assert got == [brute_runs(t) for t in texts]
    assert sum(map(bool, got)) > 20


def test_long_periodic_text():
    words = np.array([1, 2, 3, 4, 5] * 60_000 + [9] + [7] * 50_000)
    assert periods.find_runs(words) == [(0, 300_000, 5), (300_001, 50_000, 1)]


def test_many_equal_lines():
    """Equal lines apart from each other: classes grow, but nothing repeats side by side."""
    words = np.array([w for i in range(3000) for w in (*range(20), 100 + i)])
    assert periods.find_runs(words) == []


def test_best_and_collapsed():
    words = [b"x"] + [b"a", b"b"] * 15 + [b"y"] + [b"c"] * 24
    (n, runs, best, text), = periods.scan_batch([words], 24, 3)
    assert (n, runs, best) == (56, [(1, 30, 2), (32, 24, 1)], (32, 24, 1))
    assert text == b"x a b y c"
    assert periods.best_run([(5, 30, 10), (9, 27, 9), (0, 24, 9)]) == (5, 30, 10)


def test_query_against_the_definition(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    short = docs.where("length(text) < 1800").unionByName(odd_docs(spark).select("doc_id", "text").where(
        "coalesce(length(text), 0) < 1000"))
    folder = on_tables(spark, tmp_path, documents=short)
    out = periods.op12_periodic_runs(spark, folder)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    want = [brute_row(r.doc_id, r.text) for r in short.collect()]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 5


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = {(r.doc_id, r.n_words, len(r.runs)) for r in periods.periodic_runs(docs).collect()}
    assert {(2, 0, 0), (3, 0, 0), (4, 0, 0), (8, 1, 0)} <= out
    # 400 stretches of period 3, and the whole text
    assert {n for i, _, n in out if i in (5, 6)} == {401}
    assert periods.periodic_runs(no_docs(spark)).collect() == []
