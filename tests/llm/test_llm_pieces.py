import random
from hashlib import sha256

import sentencepiece
from llm_cases import SF, no_docs, odd_docs, on_tables
from pyspark.sql import functions as F

from keyflow.llm.pieces import PieceCodec, decoded, default_model, encoded, op2_sentencepiece

LIB = sentencepiece.SentencePieceProcessor(model_file=default_model())


def want(texts):
    out = []
    for i, t in texts:
        ids = LIB.encode(t or "")
        out.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    sha256((LIB.decode(ids) if ids else "").encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, op2_sentencepiece(spark, folder).collect()), key=repr) == want(texts)


def test_query_against_the_library(spark):
    check(spark, SF)


def test_odd_rows_and_empty_table(spark, tmp_path):
    check(spark, on_tables(spark, tmp_path / "a", documents=odd_docs(spark)))
    check(spark, on_tables(spark, tmp_path / "b", documents=no_docs(spark)))


def test_random_strings_against_the_library():
    codec, rng = PieceCodec(default_model()), random.Random(5)
    pieces = list(codec.score)
    makers = [
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(8))),
        lambda: "".join(rng.choice("aabbcde  \n\tthe and ingerst") for _ in range(rng.randrange(30))),
        lambda: "".join(chr(rng.choice([rng.randrange(0x180), rng.randrange(0x3000, 0x3100),
                                        rng.randrange(0x1F600, 0x1F640), 0x2581, 32])) for _ in range(rng.randrange(20))),
        lambda: " " * rng.randrange(20) + rng.choice(pieces) + " " * rng.randrange(20) + "x",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(300))) + "<s><0x41></s>",
    ]
    for k in range(4000):
        text = makers[k % len(makers)]()
        assert codec.encode(text) == LIB.encode(text), repr(text)


def test_ids_column_round_trip(spark):
    df = encoded(odd_docs(spark), default_model(), into="__p").select("doc_id", "text", F.col("__p.ids").alias("ids"))
    back = decoded(df.withColumn("old", F.col("text")), default_model()).collect()
    assert all(r.text == LIB.decode(LIB.encode(r.old or "")) for r in back if r.old)
