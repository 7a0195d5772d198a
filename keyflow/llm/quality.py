"""Quality rules: boosted trees over document statistics.

Statistics of a document are counts that one pass over its text gives. A model
is fitted on a bounded sample of labelled rows (the ``fit_rows`` labelled ids
with the smallest hash), with numpy: second-order boosting on binned features,
with monotonic constraints on chosen ones (more repetition, symbols or
duplicate lines never raise a document's score). The trees are flattened into
node arrays that score a whole batch level by level.

Defined results: null and empty texts count nothing and fail the base rule
(under 20 words); without labels of both kinds the model has no say and the
base rule decides alone; repeated rows each get a row; an empty table gives
none. Labels that are null or whose document is missing are not used; of a
document labelled twice the lower quality counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import boxed, field, load_table, ship_package, text_of

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "punct_share", "non_ascii_share", "words_per_line", "distinct_share", "top_word_share",
            "one_char_share", "long_word_share", "end_mark_share", "blank_share"]
# -1: a larger value never raises the score
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1}
WINDOW = 8
# The symbols counted, and the limits of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Word positions covered by a window of words that occurs twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
        x ^= x >> np.uint64(29)
        for i in range(window):
            h = h * np.uint64(0x100000001B3) + x[i:i + n]
    order = np.sort(h)
    same = order[1:][order[1:] == order[:-1]]
    if not len(same):
        return 0  # equal windows have equal hashes, so none repeats
    maybe = np.flatnonzero(np.isin(h, same))
    rows = np.stack([ids[maybe + i] for i in range(window)], axis=1)
    _, back, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = maybe[times[back.reshape(-1)] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple:
    """``BASE`` then ``FEATURES`` of one UTF-8 text."""
    words = text.split()  # bytes: the six ASCII blanks
    n = len(words)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(seen[0x80:0xC0].sum())
    blanks = int(seen[9:14].sum() + seen[32])
    chars = points - blanks
    symbols = int(seen[list(SYMBOLS)].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    repeat = repeat_words(ids)
    d, c, m = max(n, 1), max(chars, 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.int64, n)
    features = (
        np.log1p(n), chars / d, symbols / d, dup / m, repeat / d, seen[65:91].sum() / c, seen[48:58].sum() / c,
        (seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()) / c,
        seen[0xC0:].sum() / c, n / m, len(number) / d, np.bincount(ids).max() / d if n else 0.0,
        (sizes == 1).sum() / d, (sizes > 25).sum() / d,
        sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines) / m, blanks / max(points, 1))
    return (n, chars, symbols, dup, repeat, *map(float, features))


@dataclass
class Trees:
    """Boosted trees as node arrays; tree t starts at ``roots[t]``, a leaf points at itself."""

    feature: np.ndarray
    above: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float
    cut: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of a matrix of feature rows."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] > self.above[at], self.right[at], self.left[at])
            total += self.value[at]
        return total


def _grow(bins, edges, grad, hess, depth, lam, min_hess, signs, rate, nodes):
    """Add one tree to ``nodes`` (lists of feature, above, left, right, value); returns each row's step."""
    step = np.zeros(len(grad))

    def weight(g, h, low, high):
        return float(np.clip(-g / (h + lam), low, high))

    def build(rows, level, low, high):
        g, h = grad[rows].sum(), hess[rows].sum()
        at = len(nodes)
        nodes.append([0, np.inf, at, at, rate * weight(g, h, low, high)])
        best = (1e-6, None)
        if level < depth and h >= 2 * min_hess:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                b = bins[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], len(cuts) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], len(cuts) + 1))[:-1]
                gr, hr = g - gl, h - hl
                wl = np.clip(-gl / (hl + lam), low, high)
                wr = np.clip(-gr / (hr + lam), low, high)
                def score(gs, hs, w):
                    return -(gs * w + 0.5 * (hs + lam) * w * w)
                gain = score(gl, hl, wl) + score(gr, hr, wr) - score(g, h, weight(g, h, low, high))
                bad = (hl < min_hess) | (hr < min_hess) | (signs[f] * (wr - wl) < 0)
                gain = np.where(bad, -1.0, gain)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, wl[k], wr[k]))
        if best[1] is None:
            step[rows] = nodes[at][4]
            return at
        f, k, wl, wr = best[1]
        goes = bins[rows, f] > k
        mid = (wl + wr) / 2  # a child's weights stay on their side of it
        lo_hi = {0: ((low, high), (low, high)), -1: ((mid, high), (low, mid)), 1: ((low, mid), (mid, high))}[signs[f]]
        nodes[at][0], nodes[at][1] = f, edges[f][k]
        nodes[at][2] = build(rows[~goes], level + 1, *lo_hi[0])
        nodes[at][3] = build(rows[goes], level + 1, *lo_hi[1])
        return at

    build(np.arange(len(grad)), 0, -np.inf, np.inf)
    return step


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], n_trees: int = 60, depth: int = 3, rate: float = 0.15,
              lam: float = 1.0, min_hess: float = 1.0, n_bins: int = 32) -> Trees:
    """Boosted trees for log-odds of ``y``; ``signs``: 1, -1 or 0 per feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T, strict=True)]
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    rate_of = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate_of / (1 - rate_of)))
    margin, nodes, roots = np.full(len(y), start), [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(len(nodes))
        margin += _grow(bins, edges, p - y, p * (1 - p), depth, lam, min_hess, signs, rate, nodes)
    f, above, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(f.astype(np.int32), above.astype(float), left.astype(np.int32), right.astype(np.int32),
                 value.astype(float), np.array(roots, np.int32), depth, start, 0.0)


def fit_quality(x: np.ndarray, y: np.ndarray, lose: float = 0.002, folds: int = 4, **params) -> Trees | None:
    """Model with a cut: on rows it was not fitted on, at most the share ``lose``
    of good rows falls below it, and it never lies above even odds."""
    if len(y) < 40 or len(np.unique(y)) < 2:
        return None
    signs = [MONOTONE.get(f, 0) for f in FEATURES]
    held = np.zeros(len(y))
    fold = np.arange(len(y)) % folds
    for k in range(folds):
        held[fold == k] = fit_trees(x[fold != k], y[fold != k], signs, **params).margin(x[fold == k])
    model = fit_trees(x, y, signs, **params)
    good = np.sort(held[y == 1])
    model.cut = float(min(0.0, good[int(lose * len(good))]))
    return model


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "stats",
                    model: Trees | None = None) -> DataFrame:
    """``docs`` with a struct column of ``BASE``, ``FEATURES`` and the model's log-odds (null without one).

    One function gives both, so that a plan never computes the counts twice.
    """
    ship_package(docs.sparkSession)
    kind = ", ".join([f"{c} bigint" for c in BASE] + [f"{c} double" for c in [*FEATURES, "score"]])

    @F.pandas_udf(kind)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame([statistics(bytes(t)) for t in texts], columns=BASE + FEATURES)
            out["score"] = model.margin(out[FEATURES].to_numpy(float)) if model else None
            yield out
    return docs.withColumn(into, of(text_of(text_col).cast("binary")))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000, text_col: str = "text",
                    id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``fit_rows`` labelled documents, picked by a hash of the id."""
    chosen = (labels.where("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(fit_rows))
    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    # the sample is bounded by fit_rows, so its ids may be broadcast
    found = with_statistics(text.join(F.broadcast(chosen), "__id"), "__text", "s").select(
        "__id", "__y", *[f"s.{f}" for f in FEATURES]).toPandas().sort_values(["__id", *FEATURES])
    found = found.drop_duplicates("__id")
    order = np.random.default_rng(7).permutation(len(found))  # folds must not follow the ids
    found = found.iloc[order]
    return found[FEATURES].to_numpy(float), found["__y"].to_numpy(float)


def judged(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """``docs`` with columns __stats, __base_failed and __kept."""
    failed = ((F.col("__stats.n_words") < MIN_WORDS)
              | (100 * F.col("__stats.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__stats.n_words")))
    good = F.lit(True) if model is None else F.col("__stats.score") >= model.cut
    return (with_statistics(docs, text_col, "__stats", model)
            .withColumn("__base_failed", failed).withColumn("__kept", ~F.col("__base_failed") & good))


def quality_model(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000) -> Trees | None:
    return fit_quality(*labelled_sample(docs, labels, fit_rows))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000) -> DataFrame:
    """Rows of ``docs`` that the rules keep, unchanged."""
    rows = boxed(docs).select("row", field("text").alias("text"))
    return judged(rows, quality_model(docs, labels, fit_rows)).where("__kept").select("row.*")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents: base counts, base_failed, kept, and the model's log-odds."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, load_table(spark, sf_dir, "labels"))
    return judged(docs, model).select("doc_id", *[f"__stats.{c}" for c in BASE],
                                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
                                      F.col("__stats.score").alias("score"))
