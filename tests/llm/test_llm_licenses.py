import re

from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F

from keyflow.llm import licenses as L

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w = words(text)
    at = [(i, label) for p, label in L.BASE_PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({label for _, label in at})))


def check(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = L.op1_license_scan(spark, folder).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in texts), key=repr)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)
    return {r.doc_id: r for r in rows}


def test_base_against_brute_force(spark):
    check(spark, SF)


def test_odd_rows_and_empty_table(spark, tmp_path):
    check(spark, on_tables(spark, tmp_path / "a", documents=odd_docs(spark)))
    assert check(spark, on_tables(spark, tmp_path / "b", documents=no_docs(spark))) == {}


def test_notices_with_changes_and_near_misses(spark, tmp_path):
    mit = L.NOTICES["mit"].split()
    texts = {
        1: "Copyright. " + " ".join(mit[:40]) + " EXTRA words here " + ", ".join(mit[40:60]) + " " + " ".join(mit[62:]),
        2: " ".join(mit[:12]) + " and then something else entirely " * 5,
        3: "cc cc by by CC-BY all rights all rights reserved General  Public\nLicense",
        4: "ALL \u212AK r\u0130ghts reserved; all rights\u00e9 reserved",  # letters that lower to ASCII are not
        5: " ".join(reversed(mit)),
        6: "all rights reserved " * 3000,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = check(spark, on_tables(spark, tmp_path, documents=df))
    assert got[1].labels == "mit" and 0.5 <= got[1].score < 1
    assert got[2].labels == "" and 0 < got[2].score < 0.5
    assert got[3].n_base == 4 and got[4].n_base == 0 and got[5].labels == "" and got[6].n_base == 3000


def test_spans_carry_their_place(spark):
    df = spark.createDataFrame([(1, "x y " + L.NOTICES["bsd"] + " z")], "doc_id bigint, text string")
    row = L.license_spans(df).select(F.explode("spans").alias("s")).select("s.*").collect()
    assert [(r["first"], r["last"], r.share) for r in row] == [(2, 2 + len(L.NOTICES["bsd"].split()) - 1, 1.0)]


def test_words_put_into_a_notice(spark):
    """Anything from a line to most of a notice's length, in one place or two; copies side by side stay apart."""
    mit = L.NOTICES["mit"].split()
    junk = [f"w{i}" for i in range(60)]
    texts = {n: "a b " + " ".join(mit[:50] + junk[:n] + mit[50:]) for n in (6, 7, 20, 60)}
    texts[100] = " ".join(mit[:30] + junk[:25] + mit[30:60] + junk[25:50] + mit[60:])
    texts[101] = " ".join(mit + mit + ["x"] * 500 + mit[:50] + junk[:30] + mit[50:])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    names = [label for label, _, phrase in L._all_templates()]
    spans = {r.doc_id: [(s["first"], s["last"]) for s in r.spans if names[s["t"]] == "mit"] for r in L.license_spans(df).collect()}
    n = len(mit)
    assert all(spans[k] == [(2, 1 + n + k)] for k in (6, 7, 20, 60))
    assert spans[100] == [(0, n + 49)]
    assert spans[101] == [(0, n - 1), (n, 2 * n - 1), (2 * n + 500, 3 * n + 529)]
