"""Distances of sources, against a plain computation over all terms."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from keyflow.llm import divergence
from llm_cases import no_docs, odd_docs, on_tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=30, top=50):
    rows = [((x or ""), (s or ""), Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
                                           for w in TERM.findall(t or ""))) for t, x, s in rows]
    out = []
    for lang in {x for x, _, _ in rows}:
        docs = Counter(w for x, _, c in rows if x == lang for w in c)
        kept = [w for w in docs if docs[w] >= min_docs]
        count = {}
        for x, s, c in rows:
            if x == lang:
                count.setdefault(s, Counter()).update({w: n for w, n in c.items() if w in set(kept)})

        def price(c):
            whole = sum(c.values()) + 5 * len(kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 5) // whole for w in kept}
        own = {s: price(c) for s, c in count.items()}
        every = price(sum(count.values(), Counter()))
        for s in count:
            pairs = sorted((-sum(abs(own[s][w] - own[o][w]) for w in kept), o.encode()) for o in count if o != s)
            terms = sorted((every[w] - own[s][w], w.encode()) for w in kept if count[s][w] and own[s][w] > every[w])[:top]
            out += [(lang, s, part, i.decode(), -v, r + 1)
                    for part, found in (("pair", pairs), ("term", terms)) for r, (v, i) in enumerate(found)]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def some_docs(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "abKé" for b in "eioü" for c in "nrsß"]
    rows = []
    for i in range(n):
        source = rng.choice(["s0", "s0", "s1", "s2", "S2", None, "ü", "s10"])
        mine = words[len(source) * 3:] if source else words
        text = rng.choice([" ", ",", "1", "\n"]).join(rng.choice(mine[:rng.choice([3, 20, 60])]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([text, text, text, None, text.upper()]), rng.choice(["en", "en", "de", None]), source))
    rows.append(("rare alone", "xx", "s0"))
    rows.append(("rare alone", "xx", "s1"))
    return rows


def test_terms():
    assert divergence.terms_of("A-b c_D É1é`Zz{\x7f x".encode()) == [
        w.encode() for w in ["a", "b", "c", "d", "É", "é", "zz", " x"]]


def test_counts_passed_on_early(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en", "de"]), pa.array(["a", "a", "b"]),
                                        pa.array([b"x y x", b"y", b"x"])], ["lang", "source", "text"])
    want = {("en", "a", b"x", 2, 1), ("en", "a", b"y", 2, 2), ("de", "b", b"x", 1, 1), ("en", "a", None, 0, 0),
            ("de", "b", None, 0, 0)}
    for held, times in ((100, 1), (1, 2)):
        monkeypatch.setattr(divergence, "HELD", held)
        out = [tuple(r.values()) for b in divergence._count_batches(iter([batch] * times)) for r in b.to_pylist()]
        assert set(out) == want and len(out) == len(want) * times


def test_shares_of_a_cell(monkeypatch):
    rng = np.random.default_rng(1)
    for columns in (2, 7, 1000):
        monkeypatch.setattr(divergence, "COLUMNS", columns)
        a, b = rng.integers(0, 5, (4, 30)), rng.integers(0, 9, (3, 30))
        totals = a.sum(1).tolist(), b.sum(1).tolist()

        def price(c, total):
            return 1 + divergence.SCALE * (c + 5) // (total + 5 * 40)
        want = [[sum(abs(int(price(int(x), ta)) - int(price(int(y), tb))) for x, y in zip(ra, rb, strict=True))
                 for rb, tb in zip(b, totals[1], strict=True)] for ra, ta in zip(a, totals[0], strict=True)]
        assert divergence.cell_shares(a, totals[0], b, totals[1], 40).tolist() == want


def test_against_brute_force(spark):
    rows = some_docs(500, 1)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert found(divergence.audit(docs)) == brute(rows)
    assert any(r[2] == "term" for r in brute(rows))


def test_many_blocks(spark, monkeypatch):
    """Blocks of a few terms and sources."""
    rows = some_docs(160, 2)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    for name, v in (("TERMS", 5), ("SOURCES", 2)):
        monkeypatch.setattr(divergence, name, v)
    assert found(divergence.audit(docs, min_docs=6, top=3)) == brute(rows, 6, 3)


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    want = brute([(r.text, r.lang, r.source) for r in docs.collect()])
    assert found(divergence.audit(docs)) == want
    assert {r[4] for r in want} == {0}
    assert found(divergence.op13_divergence_audit(spark, on_tables(spark, tmp_path, documents=docs))) == want
    assert divergence.audit(no_docs(spark)).collect() == []


def test_large_counts_stay_exact(spark):
    row = spark.sql("select 3000000000000L n, 7000000000001L total, 100L kinds").select(
        divergence.price("n", "total", "kinds").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (3 * 10**12 + 5) // (7 * 10**12 + 1 + 500)
