"""Exact duplicates by distributed MSD radix partitioning.

A text is read as its length followed by its bytes, A-Z in lower case. Every
round splits each open group of rows by the next bytes, one digit of the
radix: the length and the first ``FIRST`` bytes at first, then up to ``GROW``
times as many as all before. A group ends when its bytes do (its rows are of one
length and equal) or when it holds a single row. Rows are grouped by the digits
themselves, so equality needs no digest; the SHA-256 is carried for the result.

A round is an aggregate per (group, digit), combined map-side, and a join of the
rows with it, which Spark splits where a group is hot: a group of copies with a
third of all rows is a few aggregated rows and is spread over tasks. Joins are
shuffles whatever the size, since groups grow with the data. Only rows
that share their length and first bytes with another row go on; their texts
travel once, and after that only the bytes that the round looks at.

Defined results: null text counts as empty, and empty texts are equal; a null
id is below all others (a group of null ids only has a null ``keep_id``); of
rows with the same text and id one stays; an empty table gives none. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import load_table, row_id, shared_folder, text_of, written

FIRST = 64             # bytes of the first digit
GROW = 8
MOST = 1 << 20         # bytes of a digit at most


def lowered(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _first_digit(text: Column) -> Column:
    # the first bytes lie within as many characters
    return F.substring(lowered(F.substring(text, 1, FIRST)).cast("binary"), 1, FIRST)


def _split(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (rid, gid, doc_id, sha, n_bytes, digit) with the group that the digit parts them into,
    its number of rows ``n`` and its ``top`` row by id."""
    keys = ["gid", "n_bytes", "digit"]
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("part"),
                                     F.max(F.struct("doc_id", "rid")).alias("top"))
    # read back, both sides of the join are plain shuffles, of which Spark splits a hot one
    groups = written(groups, f"{path}/groups")
    parted = rows.join(groups.hint("merge"), keys).select("rid", F.col("part").alias("gid"), "doc_id", "sha", "n_bytes",
                                                          "n", "top")
    return written(parted, f"{path}/rows")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    base = shared_folder(docs.sparkSession, "radix")
    raw = text_of(text_col)
    first = [F.octet_length(raw).alias("size"), _first_digit(raw).alias("head")]
    shared = (docs.select(*first).groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("size", "head", row_id().alias("gid")))
    shared = written(shared, f"{base}/heads")
    text = lowered(raw)
    rows = docs.select(F.col(id_col).alias("doc_id"), *first, F.sha2(text, 256).alias("sha"), text.cast("binary").alias("text"))
    rows = written(rows.join(shared.hint("merge"), ["size", "head"], "left").select(
        row_id().alias("rid"), "gid", "doc_id", "sha", F.octet_length("text").alias("n_bytes"),
        F.when(F.col("gid").isNotNull(), F.col("text")).alias("text")), f"{base}/rows")
    alone = F.struct("doc_id", "rid").alias("top")
    done = rows.where("gid is null").select("rid", "doc_id", "sha", F.lit(1).cast("bigint").alias("n"), alone)
    texts = rows.where("gid is not null")
    still, at, number = texts, FIRST, 0
    while not still.isEmpty():
        width = min(at * (GROW - 1), MOST)
        digit = F.substring("text", at + 1, width).alias("digit")
        if number:
            read = texts.where(F.col("n_bytes") > at).select("rid", digit)
            still = written(still.hint("merge").join(read, "rid"), f"{base}/{number}/digits")
        else:
            still = still.select("rid", "gid", "doc_id", "sha", "n_bytes", digit)
        parted = _split(still, f"{base}/{number}")
        at, number = at + width, number + 1
        more = (F.col("n") > 1) & (F.col("n_bytes") > at)
        still = parted.where(more).drop("n", "top")
        done = done.unionByName(parted.where(~more).select("rid", "doc_id", "sha", "n", "top"))
    return done.select("doc_id", F.col("top.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                       (F.col("top.rid") == F.col("rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def op11_radix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return exact_duplicates(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
