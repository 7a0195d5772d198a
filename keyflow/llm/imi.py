"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, so ``k`` centroids per half
make ``k * k`` cells. For a query the centroids of each half are ranked by inner
product, and a heap walks the pairs by the sum of both; the entries of the cells
it takes are reranked with the exact inner product.

A query takes cells until they hold as many entries as it is to return, which
sets its level, and then all further cells down to a margin below that level, in
units of its own length. So each query has a floor of its own: one in a sparse
place goes as deep below its level as one in a dense place. Centroids come from a
sample of at most ``fit_rows`` rows (those with the smallest hash of their
content); every row is indexed. The margin is set on that sample: the least at
which the sample's own queries find ``recall`` of their true neighbours. It is
small where the data have structure and large where they have none.

Entries are dealt by first centroid and cut into blocks of bounded size. Queries
are grouped by the first cell they take, in groups of bounded size; a query goes
to the blocks of each first centroid it visits with a bit set of second
centroids, and a block is sent only to the groups that ask for it. So neither a
hot vector nor a popular cell makes a large task.

Defined results: vectors that are null, zero, or hold a null or non-finite
component take no part, nor do null ids. Vectors of another length cannot be
compared: each length is indexed and searched apart. Rows that share an id are
rows of their own, as queries and as candidates; ties go to the smaller id; an
empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyflow.llm.common import checkpointed, load_table, row_id, ship_package

CENTROIDS = 64         # per half; second centroids of a visit are a 64-bit set
FIT_ROWS = 8192
FIT_QUERIES = 256
RECALL = 0.96          # on the sample
QUERY_GROUP = 4096


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(rid, vec_id, v: array<double>) of the rows that take part; ``rid`` numbers rows."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0)))
    return checkpointed(rows.select(row_id().alias("rid"), "vec_id", "v"))


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    points = np.unique(x, axis=0)
    rng = np.random.default_rng(0)
    c = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        a = _nearest(x, c)
        n = np.bincount(a, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, a, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (2 * x @ c.T - (c * c).sum(axis=1)).argmax(axis=1)


@dataclass
class MultiIndex:
    """Centroids of both halves, and how far below its level a query goes, in units of its length."""

    first: np.ndarray
    second: np.ndarray
    margin: float

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _nearest(x[:, :self.half], self.first), _nearest(x[:, self.half:], self.second)

    def visits(self, q: np.ndarray, counts: np.ndarray, enough: float) -> dict[int, int]:
        """Second centroids, as bits, by first centroid, in the order they are met, of the cells that hold
        ``enough`` entries, taken by descending sum of both halves' products, and of those down to the margin."""
        a, b = self.first @ q[:self.half], self.second @ q[self.half:]
        i_of, j_of = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b = (-a).tolist(), (-b).tolist()
        heap, got, out = [(a[i_of[0]] + b[j_of[0]], 0, 0)], 0, {}
        reached = [0] * len(i_of)  # columns taken of each row
        last = np.inf              # heap keys are negative sums: they rise
        while heap and heap[0][0] <= last:
            key, i, j = heapq.heappop(heap)
            ci, cj = i_of[i], j_of[j]
            n = counts[ci][cj]
            if n:
                if got < enough <= got + n:
                    last = key + self.margin * float(np.sqrt(q @ q))
                got += n
                out[ci] = out.get(ci, 0) | 1 << cj
            reached[i] = j + 1
            if j + 1 < len(j_of) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[ci] + b[j_of[j + 1]], i, j + 1))
            if i + 1 < len(i_of) and reached[i + 1] == j:
                heapq.heappush(heap, (a[i_of[i + 1]] + b[cj], i + 1, j))
        return out


def fit(sample: np.ndarray, k: int = CENTROIDS, recall: float = RECALL, top: int = 20) -> MultiIndex:
    """Index parameters from a sample of vectors."""
    half = sample.shape[1] // 2
    index = MultiIndex(_kmeans(sample[:, :half], k), _kmeans(sample[:, half:], k), 0.0)
    q = sample[:FIT_QUERIES]
    own = np.arange(len(q))
    exact = q @ sample.T
    exact[own, own] = -np.inf
    top = min(top, len(sample) - 1)
    if top > 0:
        best = np.argsort(-exact, axis=1, kind="stable")[:, :top]
        one, two = index.cells(sample)
        rough = (q[:, :half] @ index.first.T)[:, one] + (q[:, half:] @ index.second.T)[:, two]
        # the level at which a query has gathered ``top`` entries and its own row
        level = -np.partition(-rough, top, axis=1)[:, top]
        below = (level[:, None] - np.take_along_axis(rough, best, axis=1)) / np.sqrt((q * q).sum(axis=1))[:, None]
        index.margin = float(max(0.0, np.quantile(below, recall)) * (1 + 1e-9))
    return index


def _top(scores: np.ndarray, ids: np.ndarray, owner: np.ndarray, top: int) -> np.ndarray:
    """Positions of the best ``top`` of each owner, by score and then id."""
    order = np.lexsort((ids, -scores, owner))
    o = owner[order]
    first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
    rank = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
    return order[rank < top]


def rerank(queries: np.ndarray, query_rows: np.ndarray, masks: np.ndarray, entries: np.ndarray, entry_ids: np.ndarray,
           entry_rows: np.ndarray, second: np.ndarray, top: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, entry, score) of each query's best in a block, among entries whose bit it visits."""
    vectors, of, many = np.unique(entries, axis=0, return_inverse=True, return_counts=True)
    of = of.reshape(-1)
    by_vector = np.lexsort((entry_ids, of))       # copies side by side, by id
    begin = np.cumsum(many) - many
    bit = second[by_vector[begin]].astype(np.uint64)
    out = []
    for at in range(0, len(queries), 128):
        q, own, mask = queries[at:at + 128], query_rows[at:at + 128], masks[at:at + 128]
        rough = q @ vectors.T
        rough[(mask[:, None] >> bit[None, :]) & np.uint64(1) == 0] = -np.inf
        if rough.shape[1] > top + 1:
            cut = -np.partition(-rough, top, axis=1)[:, top]
        else:
            cut = np.full(len(q), -np.inf)
        # with room for rounding: the exact products below decide
        near = (rough >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None]) & (rough > -np.inf)
        who, v = np.nonzero(near)
        copies = np.minimum(many[v], top + 1)     # of equal vectors the smallest ids win
        who, base = np.repeat(who, copies), np.repeat(begin[v], copies)
        step = np.arange(len(who)) - np.repeat(np.cumsum(copies) - copies, copies)
        entry = by_vector[base + step]
        other = entry_rows[entry] != own[who]
        who, entry = who[other], entry[other]
        exact = (q[who] * entries[entry]).sum(axis=1)
        keep = _top(exact, entry_ids[entry], who, top)
        out.append((own[who[keep]], entry_ids[entry[keep]], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def query_groups(per_home: list[int], size: int = QUERY_GROUP) -> tuple[list[int], list[int]]:
    """First group and number of groups of each home: small homes share a group, large ones have several."""
    begin, many, at, held = [], [], 0, 0
    for n in per_home:
        parts = max(1, -(-n // size))
        if held + n > size and held:
            at, held = at + 1, 0
        begin.append(at)
        many.append(parts)
        at, held = (at + parts, 0) if parts > 1 else (at, held + n)
    return begin, many


def neighbours(table: DataFrame, query_where: str = "vec_id % 20 = 0", top: int = 20, id_col: str = "vec_id",
               vec_col: str = "embedding", fit_rows: int = FIT_ROWS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found of every query among all other rows."""
    spark = table.sparkSession
    ship_package(spark)
    rows = usable(table, id_col, vec_col)
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for r in rows.groupBy(F.size("v").alias("d")).count().orderBy("d").collect():  # a row per length
        found = found.unionByName(_searched(rows.where(F.size("v") == r["d"]), query_where, top, fit_rows, recall))
    return found


def _searched(rows: DataFrame, query_where: str, top: int, fit_rows: int, recall: float) -> DataFrame:
    """``neighbours`` among vectors of one length, of which there is at least one."""
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(fit_rows).select("v").toPandas()["v"]
    index = fit(np.stack(sample.to_list()), recall=recall, top=top)

    @F.pandas_udf("first int, second int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for v in batches:
            one, two = index.cells(np.stack(v.to_list())) if len(v) else ([], [])
            yield pd.DataFrame({"first": one, "second": two}, dtype="int32")
    entries = checkpointed(rows.select("rid", "vec_id", "v", cell("v").alias("c")).select("rid", "vec_id", "v", "c.*"))
    counts = np.zeros((len(index.first), len(index.second)), np.int64)
    for r in entries.groupBy("first", "second").count().collect():  # a number per cell
        counts[r["first"], r["second"]] = r["count"]
    total = int(counts.sum())
    block = max(256, min(65536, total // 64))
    salts = [max(1, -(-int(n) // block)) for n in counts.sum(axis=1)]
    # room for ``top`` others beside the query's own row
    tally, enough = counts.tolist(), min(top + 1, total)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for q in batches:
            seen = [index.visits(np.asarray(v), tally, enough) for v in q["v"]]
            yield pd.DataFrame({
                "rid": q["rid"], "query_id": q["vec_id"], "q": q["v"], "home": [next(iter(s)) for s in seen],
                "seen": [[{"first": c, "mask": m - (1 << 64) if m >> 63 else m} for c, m in s.items()] for s in seen]})
    asking = checkpointed(rows.where(query_where).select("rid", "vec_id", "v").mapInPandas(
        visit, "rid bigint, query_id bigint, q array<double>, home int, seen array<struct<first:int,mask:bigint>>"))
    per_home = [0] * len(index.first)
    for r in asking.groupBy("home").count().collect():  # a number per first centroid
        per_home[r["home"]] = r["count"]
    begin, many = query_groups(per_home)
    salt_of = F.element_at(F.array(*map(F.lit, salts)), F.col("first") + 1)

    def at_home(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("home") + 1)
    part = (at_home(begin) + F.pmod(F.xxhash64("rid"), at_home(many))).cast("int")
    asked = (asking.select("rid", "q", part.alias("part"), F.inline("seen"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), salt_of - 1))))
    # a name of its own: both sides of the cogroup come from ``asking``
    wanted = asking.select(part.alias("of_part"), F.explode("seen.first").alias("first")).distinct()
    held = entries.withColumn("salt", F.pmod(F.xxhash64("rid"), salt_of).cast("int")).join(wanted, "first")

    def search(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(e):
            return pd.DataFrame({"rid": [], "vec_id": [], "score": []})
        masks = q["mask"].to_numpy(np.int64).view(np.uint64)
        best = rerank(np.stack(q["q"].to_list()), q["rid"].to_numpy(), masks, np.stack(e["v"].to_list()),
                      e["vec_id"].to_numpy(), e["rid"].to_numpy(), e["second"].to_numpy(), top)
        return pd.DataFrame(dict(zip(("rid", "vec_id", "score"), best, strict=True)))
    found = asked.groupBy("first", "salt", "part").cogroup(held.groupBy("first", "salt", "of_part")).applyInPandas(
        search, "rid bigint, vec_id bigint, score double")
    best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(asking.select("rid", "query_id"), "rid").select("query_id", "rank", "vec_id", "score"))


def op7_imi_search(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 nearest of every vec_id divisible by 20, over all embeddings."""
    return neighbours(load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
