import random
import re
from collections import Counter

import numpy as np
from llm_cases import SF, no_docs, odd_docs, on_tables

from keyflow.llm import quality as Q


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(8)}
    out = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))
    return out, len(w) < 20 or 100 * len(covered) > 30 * len(w)


def check(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = Q.op4_quality_rules(spark, folder).collect()
    got = sorted(((r.doc_id, tuple(r[c] for c in Q.BASE), r.base_failed) for r in rows), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in texts), key=repr)
    assert not any(r.kept for r in rows if r.base_failed)
    return rows


def test_base_counts_and_labels(spark):
    rows = check(spark, SF)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r.kept for r in rows if not r.base_failed and quality.get(r.doc_id) == 1]
    assert np.mean(good) >= 0.97


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    x, y = Q.labelled_sample(docs, labels)
    half = len(y) // 2
    model = Q.fit_quality(x[:half], y[:half])
    kept = model.margin(x[half:]) >= model.cut
    assert kept[y[half:] == 1].mean() >= 0.98 and kept[y[half:] == 0].mean() <= 0.2


def test_odd_rows_and_no_labels(spark, tmp_path):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (99, 0, 0), (5, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    df = odd_docs(spark)
    rows = check(spark, on_tables(spark, tmp_path / "a", documents=df, labels=labels))
    assert all(r.kept == (not r.base_failed) for r in rows)
    out = Q.keep_good(df, labels)
    assert out.columns == df.columns and out.count() == sum(r.kept for r in rows)
    assert check(spark, on_tables(spark, tmp_path / "b", documents=no_docs(spark), labels=labels.limit(0))) == []


def test_repeat_words_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        w = [rng.choice("abc") for _ in range(rng.randrange(60))]
        w += w[rng.randrange(len(w) + 1):]
        number = {x: k for k, x in enumerate(dict.fromkeys(w))}
        ids = np.array([number[x] for x in w], np.int64)
        assert Q.repeat_words(ids) == base(" ".join(w))[0][4]


def test_trees_keep_their_signs():
    rng = np.random.default_rng(0)
    x = rng.random((600, 4))
    y = (x[:, 0] + np.sin(6 * x[:, 1]) + rng.normal(0, 0.3, 600) > 1).astype(float)
    model = Q.fit_trees(x, y, [1, 0, -1, 0])
    at = rng.random((200, 4))
    more = at.copy()
    more[:, 0] += rng.random(200)
    assert (model.margin(more) >= model.margin(at) - 1e-12).all()
    more = at.copy()
    more[:, 2] += rng.random(200)
    assert (model.margin(more) <= model.margin(at) + 1e-12).all()
    # the flat arrays score like a walk down each tree
    def walk(row):
        total = model.start
        for n in model.roots:
            while model.left[n] != n:
                n = model.right[n] if row[model.feature[n]] > model.above[n] else model.left[n]
            total += model.value[n]
        return total
    assert np.allclose(model.margin(at), [walk(r) for r in at])
