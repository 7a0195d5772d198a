import re
from hashlib import sha256

import sentencepiece
from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F

import corpus_pipeline as P
from keyflow.llm.pieces import default_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, folder, tmp_path):
    """Rows after each stage, each written and read again."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out.append(docs)
    return out


def test_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good, unique, clean, mixed, ids = stages(spark, SF, tmp_path)
    assert [s for s, _ in P.STAGES] == ["quality rules", "SimHash near-dedup", "secret scans", "mixing sources", "SentencePiece ids"]
    for df in (good, unique, clean, mixed):
        assert df.columns == docs.columns == COLUMNS
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id: r.text for r in good.collect()}
    assert 0.5 * len(text) < len(kept) < len(text) and all(text[i] == t for i, t in kept.items())
    one = {r.doc_id for r in unique.collect()}
    assert one < set(kept) and len(one) == unique.count()
    assert len({kept[i] for i in one}) == len(one) and min(kept) in one  # no exact copies, smallest ids stay
    after = {r.doc_id: r for r in clean.collect()}
    assert set(after) == one and all(r.n_chars == len(r.text) for r in after.values())
    assert not any(re.search(r'token = "[0-9A-Fa-f]{40}', r.text) for r in after.values())
    assert {r.doc_id for r in mixed.collect()} <= one
    lib = sentencepiece.SentencePieceProcessor(model_file=default_model())
    want = sorted((r.doc_id, sha256(",".join(map(str, lib.encode(r.text))).encode()).hexdigest()) for r in mixed.collect())
    rows = ids.collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in rows) == want
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_run_gives_the_last_stage(spark, tmp_path):
    want = stages(spark, SF, tmp_path)[-1]
    got = P.run(spark, SF)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_odd_rows_and_empty_table(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    for name, df in (("a", odd_docs(spark).unionByName(some, allowMissingColumns=True)), ("b", no_docs(spark))):
        folder = on_tables(spark, tmp_path / name, documents=df, labels=labels)
        out = stages(spark, folder, tmp_path / f"{name}-out")
        assert all(x.columns == df.columns for x in out[:-1])
        assert (out[0].count() > 0) == (name == "a") and out[1].count() <= out[0].count()


# names of columns that the operators add, and some that look like it
CLASHES = ["__k1", "__k2", "__blocks", "__new", "__text", "__stats", "__kept", "__base_failed", "__places", "__p", "__id", "__y",
           "__m", "row", "masked", "part", "rid", "fp", "size", "spans", "kind", "value", "component", "words", "owner", "repo",
           "digest", "stats", "best", "block", "low"]


def test_extra_columns_keep_their_values(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    for c in CLASHES:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    folder = on_tables(spark, tmp_path / "t", documents=docs, labels=labels)
    for df in stages(spark, folder, tmp_path / "out")[:-1]:
        assert df.columns == docs.columns
        rows = df.collect()
        assert len(rows) > 20
        assert all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHES)
