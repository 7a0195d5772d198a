"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has a bit set where over half of its shingle hashes
have it. Two fingerprints within ``d`` bits share a point within ``d/2`` bits of
both, so every distinct fingerprint emits all variants in that ball, variants
are shuffled, and those that collide are compared. For an even ``d`` all
fingerprints in a bucket are within ``d`` of each other, and a bucket holds at
most the ball's size (65 for two bits) of distinct ones, whatever the data; the
smallest is linked to the others, which keeps every component.

Defined results: null or wordless text has fingerprint 0 and links like any
other; rows with a null ``doc_id`` take part but never name a component unless
it has no other (then null); repeated rows each get a row; an empty table gives
none. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import boxed, checkpointed, content_key, field, ship_package, text_of
from keyflow.llm.components import connected_components

BITS = 64


def fingerprint_bytes(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text as a signed 64-bit number."""
    words = text.lower().split()  # bytes: only A-Z, and only ASCII blanks
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if n > 1 else [b" ".join(words)]
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(s, seed) for s in runs]), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(raw), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(raw[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(raw)).view(">i8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """Fingerprint column (bigint) of a string column."""
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_bytes(bytes(t), shingle, seed) for t in texts], dtype="int64")
    return of(text.cast("binary"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _ball(radius: int) -> Column:
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in masks])


def fingerprint_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Verified links ``(a, b)`` between distinct fingerprints (column ``fp``).

    Enough links to connect all fingerprints within ``max_bits`` for an even
    number; all such pairs for an odd one.
    """
    def ball(radius: int) -> DataFrame:
        return fps.select("fp", F.explode(_ball(radius)).alias("mask")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    if max_bits % 2 == 0:
        pairs = (ball(max_bits // 2).groupBy("variant").agg(F.collect_list("fp").alias("fps"))
                 .where(F.size("fps") > 1)
                 .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")))
    else:
        wide = ball(max_bits // 2 + 1)
        pairs = (ball(max_bits // 2).withColumnRenamed("fp", "a")
                 .join(wide.withColumnRenamed("fp", "b"), "variant").select("a", "b"))
    return (pairs.where("a <> b").distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: its id, content key, ``fp`` and ``component_id``."""
    ship_package(docs.sparkSession)
    text = text_of(text_col)
    rows = checkpointed(docs.select(F.col(id_col).alias("doc_id"),
                                    *content_key(F.col(id_col), text),
                                    fingerprint(text, shingle, seed).alias("fp")))
    # copies meet here, combined map-side: from now on a group of copies is one row
    fps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    found = connected_components(fingerprint_links(fps, max_bits)).withColumnRenamed("node", "fp")
    named = fps.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    label = named.join(low, "component").select("fp", "component", "component_id")
    return rows.join(label, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (a null id only where there is no other; of equal ids one row)."""
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__k1", "__k2")).alias("best")
    kept = (near_duplicates(docs, id_col, text_col, shingle, max_bits, seed)
            .groupBy("component").agg(best).select("best.__k1", "best.__k2"))
    keyed = boxed(docs).select("row", *content_key(field(id_col), text_of(field(text_col))))
    return keyed.join(kept, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).select("row.*")


def op3_simhash_neardup(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, fingerprint, component_id over all documents."""
    from keyflow.llm.common import load_table
    return near_duplicates(load_table(spark, sf_dir, "documents")).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
