"""Runs of repeated words by a descending-LCP Kruskal over suffix classes.

A run is a stretch of consecutive words with a smallest period q that no
neighbouring word extends, at least ``MIN_EXPONENT`` times q and ``MIN_LENGTH``
words long. In each text the suffixes (by word) are sorted, and edges between
neighbours in that order are taken by decreasing length of their common prefix,
as Kruskal takes edges: union-find joins the classes of suffixes, each with its
positions in order, the smaller set into the larger. Two positions of different
classes that become neighbours in the joined set are ``d`` words apart and share
exactly ``lcp`` words. If ``d`` is within ``lcp`` they seed a run of period
``d``; it is whole where the words before them differ. ``d`` is its smallest
period, since with a smaller one there would be a position between them.

A run that counts has a seed with a common prefix of at least ``length - q``
words, so edges below the least such prefix are left out, and a suffix whose
first words occur nowhere else in the text is a class of its own. A batch of
texts is searched for repeated words of that length at once (by a hash, which
can only find too many; what follows is exact).

A text is one row and is worked on in one task, in memory proportional to its
words times the logarithm of their number; batches of texts are cut to
``BATCH_WORDS`` words.

Defined results: null text counts as empty and has no words, no run and an
empty collapsed text; repeated rows each get a row; an empty table gives none.
Columns other than those named are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import load_table, ship_package, text_of

MIN_LENGTH = 24
MIN_EXPONENT = 3
BATCH_WORDS = 1 << 19

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"n_words bigint, runs array<{RUN}>, best {RUN}, collapsed string"


def least_prefix(min_length: int, min_exponent: int) -> int:
    """The shortest common prefix of a position of a run that counts and the one a period on."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), np.int64)
    new[order] = np.cumsum(np.concatenate([[0], keys[order][1:] != keys[order][:-1]]))
    return new


def suffix_neighbours(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (of word numbers) in order, and the words each shares with the one before it."""
    n = len(words)
    levels, step = [_ranks(words)], 1
    while step < n and levels[-1].max() + 1 < n:
        here = levels[-1]
        there = np.full(n, -1, np.int64)
        there[:n - step] = here[step:]
        levels.append(_ranks(here * (n + 1) + there + 1))
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # ranks of blocks that the end cuts off are equal only for equal suffixes, and there are none
        inside = np.maximum(a, b) < n
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        lcp[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, np.concatenate([[0], lcp])


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """Runs (start, length, period) of a text's word numbers, by start then period."""
    n = len(words)
    if n < min_length:
        return []
    order, lcp = suffix_neighbours(words)
    edges = np.flatnonzero(lcp >= least_prefix(min_length, min_exponent))
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    runs = []

    def root(x: int) -> int:
        top = parent.setdefault(x, x)
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if ((min_exponent - 1) * d <= common and common + d >= min_length
                and (i == 0 or words[i - 1] != words[j - 1])):
            runs.append((i, common + d, d))

    for k, common in zip(edges.tolist(), lcp[edges].tolist(), strict=True):
        few, many = root(int(order[k - 1])), root(int(order[k]))
        small, large = members.pop(few, [few]), members.pop(many, [many])
        if len(small) > len(large):
            few, many, small, large = many, few, large, small
        before = -1
        for at, x in enumerate(small):
            p = bisect_left(large, x)
            after = small[at + 1] if at + 1 < len(small) else n
            # neighbours in the joined set, from either class
            if p and large[p - 1] > before:
                seed(large[p - 1], x, common)
            if p < len(large) and large[p] < after:
                seed(x, large[p], common)
            before = x
        if len(small) * 8 < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)  # two ordered stretches: linear
        parent[few] = many
        members[many] = large
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _with_repeats(words: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the texts of a batch in which ``n`` consecutive words may occur twice."""
    grams = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    length, factor = 1, 0xD6E8FEB86659FD93
    while length < n:  # windows by doubling; the last two may overlap
        step = min(length, n - length)
        if len(grams) <= step:
            return np.zeros(0, np.int64)
        first, second = grams[:-step], grams[step:]
        grams = (first ^ (first >> np.uint64(29))) * np.uint64(factor) + second
        length, factor = length + step, (factor * 0x2545F4914F6CDD1D + 2 * step) % (1 << 64) | 1
    whole = text[:len(grams)] == text[n - 1:]
    mixed = (grams ^ (text[:len(grams)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))[whole]
    where = text[:len(grams)][whole]
    order = np.argsort(mixed)
    same = mixed[order][1:] == mixed[order][:-1]
    return np.unique(where[order][1:][same])


def best_run(runs: list[tuple]) -> tuple | None:
    """The run with the greatest length / period; of equal ones that with the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple]) -> bytes:
    """The text without the words of a run after its first period, joined by single spaces."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
    return b" ".join(words)


def scan_batch(texts: list[list[bytes]], min_length: int, min_exponent: int) -> Iterator[tuple]:
    """(number of words, runs, best run, collapsed text) of each text."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    every = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    some = set(_with_repeats(every, np.repeat(np.arange(len(texts)), sizes),
                             least_prefix(min_length, min_exponent)).tolist())
    for k, t in enumerate(texts):
        runs = find_runs(every[ends[k] - sizes[k]:ends[k]], min_length, min_exponent) if k in some else []
        yield len(t), runs, best_run(runs), collapsed(t, runs)


Rewrite = Callable[[list, object], list]


def _scanned(ids: pd.Series, texts: pd.Series, min_length: int, min_exponent: int, rewrite: Rewrite | None) -> pd.DataFrame:
    out, part, held = [], [], 0
    for row_id, text in zip(ids, texts, strict=True):
        words = bytes(text).split()  # bytes: the six ASCII blanks
        part.append(rewrite(words, row_id) if rewrite else words)
        held += len(words)
        if held >= BATCH_WORDS:
            out += scan_batch(part, min_length, min_exponent)
            part, held = [], 0
    out += scan_batch(part, min_length, min_exponent)
    named = ("start", "length", "period")
    return pd.DataFrame({
        "n_words": pd.Series([o[0] for o in out], dtype="int64"),
        "runs": pd.Series([[dict(zip(named, r, strict=True)) for r in o[1]] for o in out], dtype=object),
        "best": pd.Series([o[2] and dict(zip(named, o[2], strict=True)) for o in out], dtype=object),
        "collapsed": pd.Series([o[3].decode("utf-8", "replace") for o in out], dtype=object)})


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (by start, then period), best, collapsed (text).

    ``rewrite(words, id)`` may change a text's words (bytes) before they are searched.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            yield _scanned(ids, texts, min_length, min_exponent, rewrite)
    return docs.select(F.col(id_col).alias("doc_id"), scan(F.col(id_col).cast("string"), text_of(text_col).cast("binary")).alias("r")
                       ).select("doc_id", "r.*")


def planted(words: list, row_id: str | None) -> list:
    """The contract's words: in a tenth of the documents, chosen by their id, the words from some place on
    repeat with a period; the others (and rows without an id) as they are."""
    n = len(words)
    h = 1 if row_id is None else crc32(str(row_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def runs_text(runs: Column) -> Column:
    """Every run's ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents, with the runs that its rule plants by id."""
    found = periodic_runs(load_table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=planted)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(runs_text(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
