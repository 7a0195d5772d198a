import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyflow.llm import rans as R
from keyflow.llm.common import shared_folder

LIB = Tokenizer.from_file(R.default_tokenizer())


def ids_of(text):
    return LIB.encode(text, add_special_tokens=False).ids


def check(spark, folder):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = R.op6_rans_tokens(spark, folder).collect()
    each = sorted(((i, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes()))
                   for i, t in docs for x in [ids_of(t)]), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == each
    # starts follow each other in ascending order of id, nulls first
    rows.sort(key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


def test_query_against_the_library(spark):
    check(spark, SF)


def test_odd_rows_and_empty_table(spark, tmp_path):
    check(spark, on_tables(spark, tmp_path / "a", documents=odd_docs(spark)))
    check(spark, on_tables(spark, tmp_path / "b", documents=no_docs(spark)))


def test_many_segments_and_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = shared_folder(spark, "tok-test")
    catalogue = R.write_tokens(docs, folder, R.default_tokenizer(), segment=3000)
    assert catalogue.count() > 20
    got = {r.doc_id: (r.start, list(r.ids)) for r in R.read_tokens(R.with_starts(catalogue), folder, with_ids=True).collect()}
    at = 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*ids_of(r.text or ""), 2]
        assert got[r.doc_id] == (at, ids)
        at += len(ids)


@pytest.mark.parametrize("n", [1, 2, 31, 33, 1000, R.BLOCK, R.BLOCK + 1, 100_000])
def test_segment_round_trip(n):
    rng = np.random.default_rng(n)
    for v in (1, 2, 300, 50_000):
        ids = (rng.zipf(1.3, n) % v).astype(np.uint32)
        data = R.encode_segment(ids)
        assert (R.decode_segment(data) == ids).all()
        if n > 2 * R.BLOCK:  # blocks stand alone
            assert (R.decode_segment(data, 1, 2) == ids[R.BLOCK:2 * R.BLOCK]).all()


def test_a_damaged_block_is_noticed():
    ids = (np.random.default_rng(0).zipf(1.3, 50_000) % 500).astype(np.uint32)
    data = bytearray(R.encode_segment(ids))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        R.decode_segment(bytes(data))


def test_frequencies_sum_and_keep_every_symbol():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 50_000):
        counts = rng.zipf(1.5, n).clip(max=10**9)
        bits = max(12, int(n).bit_length() + 2)
        f = R.frequencies(counts, bits)
        assert f.sum() == 1 << bits and f.min() >= 1


def encoded(tokens, texts):
    ids, many = tokens.batch(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])]


def test_words_at_a_time_against_whole_texts():
    tokens, rng = R.WordTokens(R.default_tokenizer()), random.Random(2)
    some = ["the", "a", "  ", "\n\n", "\t", "é", "<|endoftext|>", "'s", "12", "!!", "\x1c", "\x85", "\u2028", "日本", "\r\n", "\xa0"]
    plain = ["the", "ing", " ", "\n", "'s", "12", ".", "é", "日", ",", "?", ":", "K"]
    texts = ["".join(rng.choice(some if k % 2 else plain) for _ in range(rng.randrange(12))) for k in range(5000)]
    assert encoded(tokens, texts) == [ids_of(t) for t in texts]
    assert encoded(tokens, texts[:100]) == [ids_of(t) for t in texts[:100]]


def test_long_texts_and_a_full_table(monkeypatch):
    monkeypatch.setattr(R, "SLICE", 50)
    monkeypatch.setattr(R, "MEMO", 40)
    rng = random.Random(3)
    words = [f"w{i}{'.' if i % 3 else ''}" for i in range(60)]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(n)) for n in (0, 1, 9, 30, 400, 2, 150, 0)]
    tokens = R.WordTokens(R.default_tokenizer())
    got = [x.tolist() for first, last, ids, many in tokens.slices(pa.array(texts)) for x in np.split(ids, np.cumsum(many)[:-1])]
    assert got == [ids_of(t) for t in texts]


def test_catalogue_is_found_in_another_session(spark):
    docs = spark.createDataFrame([(5, "a b"), (None, "x"), (7, "long " * 50), (7, ""), (7, None)], "doc_id bigint, text string")
    folder = shared_folder(spark, "tok-test")
    R.write_tokens(docs, folder, R.default_tokenizer(), segment=40)
    other = spark.newSession()
    got = [tuple(r) for r in R.read_tokens(R.with_starts(R.open_tokens(other, folder)), folder, with_ids=True)
           .select("doc_id", "start", "ids").orderBy("start").collect()]
    lengths = [len(ids_of(t)) + 1 for t in ("x", "a b")]
    assert got[0] == (None, 0, [*ids_of("x"), 2]) and got[1] == (5, lengths[0], [*ids_of("a b"), 2])
    assert sorted(len(g[2]) for g in got[2:]) == [1, 1, len(ids_of("long " * 50)) + 1]


def test_many_empty_documents_are_parted(spark):
    folder = shared_folder(spark, "tok-test")
    docs = spark.range(600_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).coalesce(1)
    catalogue = R.write_tokens(docs, folder, R.default_tokenizer())
    assert catalogue.agg(F.max(F.size("docs"))).first()[0] <= R.SEGMENT_DOCS
    back = R.read_tokens(R.with_starts(catalogue), folder)
    assert back.where("start <> doc_id or n_tokens <> 1").count() == 0 and back.count() == 600_000
