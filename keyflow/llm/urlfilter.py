"""URL filters by Bloom filter cascades, in DataFrame functions only.

A cascade answers exactly, without a join, whether a key of a known universe is
listed. Level 0 is a Bloom filter of the listed keys; level 1 holds the other
keys of the universe that level 0 takes for listed; level 2 the listed keys that
level 1 takes for those; and so on until nothing is taken wrongly. A key is
listed if the first level that lacks it is odd.

Bits are set by a grouped ``bit_or``, so only the words of a filter reach the
driver. Their number follows the listed keys and is checked: beyond
``MAX_BYTES`` the lookup is a join with the listed keys instead, with the same
answers.

Rules and method: allow and block rules are two cascades over the complete
universe of (host suffix, path prefix) keys of all urls; where no rule fits, a
host is blocked if it is on a list gathered from the urls themselves: hosts with
tracking parameters in over a third of their urls.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and is allowed; repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, log2, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import checkpointed, load_table

MAX_BYTES = 64 << 20
LATER_RATE = 0.05      # false positives of all levels but the first

# The base rules, (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
TRACKING = r"[?&](utm_[a-z]+|ref|gclid|fbclid)="


@dataclass
class _Level:
    bits: int
    hashes: int
    seed: int
    words: list[int]

    def _places(self, key: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(self.seed + i)), F.lit(self.bits)) for i in range(self.hashes)])

    def has(self, key: Column) -> Column:
        # folded into one literal by the optimizer
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        return F.forall(self._places(key), lambda p: F.getbit(
            F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> _Level:
    hashes = max(1, ceil(-log2(rate)))
    bits = max(64, ceil(-n * log(rate) / log(2) ** 2))
    level = _Level(bits, hashes, seed, [])
    set_bits = (keys.select(F.explode(level._places(F.col("key"))).alias("p"))
                .groupBy(F.shiftright("p", 6).alias("w"))
                .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b")).collect())  # bits / 64 rows
    level.words = [0] * (bits // 64 + 1)
    for row in set_bits:
        level.words[row["w"]] = row["b"]
    return level


class Cascade:
    """Exact membership in ``listed`` for keys of ``universe`` (columns ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, seed: int = 0, max_bytes: int = MAX_BYTES):
        listed = checkpointed(listed.select("key").where("key is not null").distinct())
        others = checkpointed(universe.select("key").where("key is not null").distinct()
                              .join(listed, "key", "left_anti"))
        self.listed, self.levels = listed, []
        inside, outside = listed, others
        n, m = inside.count(), outside.count()
        rate = min(0.5, max(n, 1) * sqrt(0.5) / max(m, 1))
        used = 0
        while n:
            used += -n * log(rate) / log(2) ** 2 / 8
            if used > max_bytes:
                self.levels = None  # too many listed keys to broadcast
                return
            level = _level(inside, n, rate, seed + 101 * len(self.levels))
            self.levels.append(level)
            # what the level wrongly holds is what the next one has to know
            inside, outside = checkpointed(outside.where(level.has(F.col("key")))), inside
            n, rate = inside.count(), LATER_RATE

    @property
    def n_bytes(self) -> int | None:
        return None if self.levels is None else sum(8 * len(x.words) for x in self.levels)

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        if self.levels is None:
            raise ValueError("the list is too large for a cascade; use marked()")
        found = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            found = F.when(~self.levels[k].has(key), F.lit(k % 2 == 1)).otherwise(found)
        return found

    def marked(self, rows: DataFrame, keys: str, into: str) -> DataFrame:
        """``rows`` (with a unique ``rid``) with the listed ones of an array of keys, as an array."""
        if self.levels is not None:
            return rows.withColumn(into, F.filter(keys, self.has))
        held = (rows.select("rid", F.explode(keys).alias("key")).join(self.listed, "key")
                .groupBy("rid").agg(F.collect_set("key").alias(into)))
        none = F.array().cast("array<string>")
        return rows.join(held, "rid", "left").withColumn(into, F.coalesce(into, none))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty where there is no ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(text, shape, 1), upper, upper.lower()), F.regexp_extract(text, shape, 2))


def rule_keys(host: Column, path: Column, lengths: list[int], labels: int) -> Column:
    """All keys under which a rule for the url could be listed: each host suffix of at most ``labels`` labels
    with each path prefix of the rules' ``lengths``."""
    parts = F.reverse(F.slice(F.reverse(F.split(host, r"\.")), 1, labels))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    starts = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p)))))


def judged_urls(pages: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url",
                max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``pages``: rid, id, host, path, rule, verdict, and listed (the host is on the list)."""
    host, path = host_and_path(F.col(url_col))
    lengths = sorted({len(p) for _, _, p in rules})
    labels = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    rows = checkpointed(pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("page_id"),
                                     host.alias("host"), path.alias("path"),
                                     F.coalesce(F.col(url_col).rlike(TRACKING), F.lit(False)).alias("tracks"))
                        .withColumn("keys", rule_keys(F.col("host"), F.col("path"), lengths, labels)))
    spark = pages.sparkSession
    universe = checkpointed(rows.select(F.explode("keys").alias("key")).distinct())
    out = rows
    for kind in ("allow", "block"):
        named = [h + p for v, h, p in rules if v == kind]
        listed = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in named]).cast("array<string>")).alias("key"))
        out = Cascade(listed, universe, max_bytes=max_bytes).marked(out, "keys", kind)

    def as_rule(verdict):
        return lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), F.lit(verdict).alias("verdict"))
    longest = F.array_max(F.concat(*[F.transform(kind, as_rule(kind)) for kind in ("allow", "block")]))
    hosts = checkpointed(rows.where("host <> ''").groupBy(F.col("host").alias("key"))
                         .agg(F.avg(F.col("tracks").cast("int")).alias("share")))
    method = Cascade(hosts.where("share > 1D / 3"), hosts, seed=50_000, max_bytes=max_bytes)
    # an empty host is no key of the method's universe
    asked = F.filter(F.array("host"), lambda h: h != "")
    out = method.marked(out.withColumn("hosts", asked), "hosts", "bad").withColumn("best", longest)
    listed = F.size("bad") > 0
    return out.select("rid", "page_id", "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.when(listed, "block").otherwise("allow")).alias("verdict"),
                      listed.alias("listed"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query over all pages: page_id, host, path, rule, verdict, and whether the host is listed."""
    return judged_urls(load_table(spark, sf_dir, "pages").select("page_id", "url")).drop("rid")
