"""Exact duplicates by radix partitioning, against a dictionary of lower-cased texts."""

import hashlib
import random

from keyflow.llm import radix
from llm_cases import LONG, no_docs, odd_docs, on_tables


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(-1 if i is None else i)
    out = []
    for text, ids in groups.items():
        keep = None if max(ids) == -1 else max(ids)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, reverse=True):
            out.append((None if i == -1 else i, keep, len(ids), first, sha))
            first = False
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert found(radix.exact_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    assert radix.exact_duplicates(no_docs(spark)).collect() == []


def test_texts_that_part_late(spark, monkeypatch):
    """Texts equal up to some byte, ended there or going on, around the borders of the digits."""
    monkeypatch.setattr(radix, "MOST", 2048)
    base = "".join(chr(97 + i % 26) for i in range(9000))
    texts = []
    for at in (1, 63, 64, 65, 127, 511, 512, 513, 4095, 4096, 4097, 8999):
        texts += [base[:at], base[:at].upper(), base[:at] + "X" + base[at + 1:], base[:at] + "é" + base[at + 1:],
                  base[:at] + "É" + base[at + 1:], base[:at] + "x" + base[at + 1:]]
    texts += ["é" * 64, "É" * 64, "É" * 64, "é" * 32, "K" * 70, "K" + "k" * 67, "\x00", "\x00\x00", "", None]
    rng = random.Random(1)
    rows = [(rng.choice([i, i, i // 2, None]), t) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert found(radix.exact_duplicates(docs)) == brute(rows)


def test_hot_group_and_clashing_columns(spark):
    rows = [(i, LONG if i % 3 == 0 else f"{LONG[:100 * (i % 50)]}{i % 90}") for i in range(600)]
    docs = spark.createDataFrame([(i, t, 0, "", 5) for i, t in rows],
                                 "doc_id bigint, text string, gid int, digit string, n int").repartition(5)
    assert found(radix.exact_duplicates(docs)) == brute(rows)


def test_query(spark, tmp_path):
    folder = on_tables(spark, tmp_path, documents=odd_docs(spark))
    got = found(radix.op11_radix_dedup(spark, folder))
    assert got == brute([(r.doc_id, r.text) for r in odd_docs(spark).collect()])
