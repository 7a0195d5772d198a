"""How far the sources of a language are apart in their terms, by one-hot level products.

A term's price in a group is a smoothed, scaled share that depends on its count
there alone, so the distance of two groups summed over all terms follows from
their joint table: how many terms have count c in the one and c' in the other.
In a block of terms every (group, level of the count) is an indicator column,
and the product of the transposed columns with the columns holds the joint
tables of all pairs of groups at once. A table times the differences of prices
is the block's share of the distances.

Spark counts the terms (combined in each task first), parts each language's
terms into blocks of about ``TERMS`` by hash and its sources into blocks of
about ``SOURCES``, and prices every (block of terms, pair of blocks of sources)
on its own: a task holds the counts of one such cell, whatever the data. Terms
that neither block of sources has are added at the end from their number. Counts
are products of zeros and ones, exact as float32 up to 2**24 terms in a block;
prices and sums are integers.

Defined results: null text, language and source count as empty; a group without
kept terms has count 0 for all; repeated rows are documents of their own; a
language without kept terms has pairs with value 0; an empty table gives none.
Columns other than those named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import load_table, shared_folder, ship_package, text_of, written

# The audit's scale and smoothing, the least documents of a kept term, the terms listed.
SCALE = 1_000_000_000
SMOOTH = 5
MIN_DOCS = 30
TOP_TERMS = 50
TERMS = 256            # in a block
SOURCES = 32           # in a block
COLUMNS = 1024         # of one product at most, unless a single source has more
HELD = 400_000         # counts that a task holds before it passes them on

COUNTED = "lang string, source string, term binary, n bigint, docs bigint"
SHARES = "lang string, a string, b string, value bigint, n_terms bigint, zero_a bigint, zero_b bigint"
# ASCII letters in lower case and all bytes above ASCII stay, the others part terms
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters above ASCII, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


def _counts(groups: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (seen, docs) in groups.items():
        n = len(seen) + 1  # and a row without a term
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * n), pa.array([source] * n), pa.array([*seen, None], pa.binary()),
             pa.array([*seen.values(), 0], pa.int64()), pa.array([*map(docs.__getitem__, seen), 0], pa.int64())],
            ["lang", "source", "term", "n", "docs"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            words = terms_of(text)
            seen.update(words)
            docs.update(set(words))
        if sum(len(seen) for seen, _ in groups.values()) > HELD:
            yield from _counts(groups)
            groups = {}
    yield from _counts(groups)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n occurrences, docs with it), and a row with a null term for every group."""
    ship_package(docs.sparkSession)
    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"),
                       text_of(text_col).cast("binary").alias("text"))
    return (rows.mapInArrow(_count_batches, COUNTED).withColumn("term", F.col("term").cast("string"))
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def price(n: str, total: str, kinds: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kinds)), exactly."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))) "
                  f"div cast({total} + {SMOOTH} * {kinds} as decimal(20,0))")


def _prices(counts: np.ndarray, total: int, kinds: int) -> np.ndarray:
    whole = total + SMOOTH * kinds
    return np.array([1 + SCALE * (c + SMOOTH) // whole if whole else 0 for c in counts.tolist()], np.int64)


def _indicators(counts: np.ndarray, totals: list[int], kinds: int) -> Iterator[tuple]:
    """Sources (rows of ``counts``) in turns: their numbers, indicator columns, first column each, column prices."""
    n_terms = counts.shape[1]
    levels = [np.unique(row, return_inverse=True) for row in counts]
    k = 0
    while k < len(levels):
        own, width, starts = [], 0, []
        while k < len(levels) and (not own or width + len(levels[k][0]) <= COLUMNS):
            own.append(k)
            starts.append(width)
            width += len(levels[k][0])
            k += 1
        hot = np.zeros((n_terms, width), np.float32)
        for s, first in zip(own, starts, strict=True):
            hot[np.arange(n_terms), first + levels[s][1]] = 1
        yield own, hot, starts, np.concatenate([_prices(levels[s][0], totals[s], kinds) for s in own])


def cell_shares(counts_a: np.ndarray, totals_a: list[int], counts_b: np.ndarray, totals_b: list[int],
                kinds: int) -> np.ndarray:
    """Distances of every source of ``a`` to every source of ``b`` over the terms (columns) of one block."""
    out = np.zeros((len(totals_a), len(totals_b)), np.int64)
    if not counts_a.shape[1]:
        return out
    for own_a, hot_a, first_a, price_a in _indicators(counts_a, totals_a, kinds):
        for own_b, hot_b, first_b, price_b in _indicators(counts_b, totals_b, kinds):
            joint = hot_a.T @ hot_b
            paid = joint.astype(np.int64) * np.abs(price_a[:, None] - price_b[None, :])
            out[np.ix_(own_a, own_b)] = np.add.reduceat(np.add.reduceat(paid, first_a, axis=0), first_b, axis=1)
    return out


def _cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    lang, _, low, high = key
    heads = rows[rows["term"].isna()].sort_values("source", ignore_index=True)
    body = rows[rows["term"].notna()]
    number, terms = pd.factorize(body["term"])
    counts = np.zeros((len(heads), len(terms)), np.int64)
    counts[np.searchsorted(heads["source"].to_numpy(object), body["source"].to_numpy(object)), number] = body["n"]
    kinds, names, totals = int(heads["kinds"].iloc[0]), heads["source"].to_numpy(object), heads["total"].tolist()
    in_a, in_b = (np.flatnonzero(heads["part"] == p) for p in (low, high))
    value = cell_shares(counts[in_a], [totals[k] for k in in_a], counts[in_b], [totals[k] for k in in_b], kinds)
    zero = [int(_prices(np.zeros(1, np.int64), t, kinds)[0]) for t in totals]
    # each pair once
    out = [(lang, names[i], names[j], int(value[x, y]), len(terms), zero[i], zero[j])
           for x, i in enumerate(in_a) for y, j in enumerate(in_b) if low != high or i < j]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value", "n_terms", "zero_a", "zero_b"])


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def source_pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every group and each other source of its language.

    ``held`` has (lang, source, term, n) of the kept terms with a count, ``groups`` every group's
    (lang, source, total, kinds, n_sources).
    """
    blocks = groups.select(
        "lang", "source", "total", "kinds",
        F.greatest(F.lit(1), F.expr(f"(kinds + {TERMS - 1}) div {TERMS}")).alias("n_blocks"),
        F.greatest(F.lit(1), F.expr(f"(n_sources + {SOURCES - 1}) div {SOURCES}")).alias("n_parts"))
    blocks = blocks.withColumn("part", F.expr("pmod(xxhash64(source), n_parts)"))
    heads = blocks.select("*", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("block"),
                          F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"))
    body = held.join(blocks, ["lang", "source"]).withColumn("block", F.expr("pmod(xxhash64(term), n_blocks)"))
    cells = heads.unionByName(body.select(heads.columns)).withColumn("other", F.explode(F.expr("sequence(0L, n_parts - 1)")))
    shares = (cells.select("lang", "block", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                           "source", "part", "term", "n", "total", "kinds")
              .groupBy("lang", "block", "low", "high").applyInPandas(_cell, SHARES))
    apart = shares.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms"),
                                                 F.max(F.abs(F.col("zero_a") - F.col("zero_b"))).alias("zero"))
    kinds = groups.select("lang", "kinds").distinct()
    whole = F.col("value") + (F.col("kinds") - F.col("n_terms")) * F.col("zero")
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return apart.join(kinds, "lang").select("lang", F.explode(ways).alias("w"), whole.alias("value")).select(
        "lang", "w.source", "w.item", "value")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources of the language (``pair``)
    and the terms that a source has more of than its language (``term``)."""
    base = shared_folder(docs.sparkSession, "divergence")
    counts = written(term_counts(docs, text_col, lang_col, source_col), f"{base}/counts")
    kept = written(counts.where("term is not null").groupBy("lang", "term")
                   .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= min_docs).drop("docs"), f"{base}/kept")
    held = written(counts.drop("docs").join(kept, ["lang", "term"]), f"{base}/held")
    groups = counts.where("term is null").select("lang", "source")
    langs = (groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
             .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total")), "lang", "left")
             .na.fill(0, ["kinds", "lang_total"]))
    groups = written(groups.join(held.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                     .na.fill(0, ["total"]).join(langs, "lang"), f"{base}/groups")
    more = (held.join(groups, ["lang", "source"])
            .withColumn("p", price("n", "total", "kinds")).withColumn("q", price("lang_n", "lang_total", "kinds"))
            .where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    pairs = source_pairs(held.select("lang", "source", "term", "n"), groups)
    return _ranked(pairs, "pair").unionByName(_ranked(more, "term").where(F.col("rank") <= top))


def op13_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return audit(load_table(spark, sf_dir, "documents").select("text", "lang", "source"))
