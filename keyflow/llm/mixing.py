"""Mixing sources to target weights, in DataFrame functions only.

Documents are cut into blocks of words. Each source's target gives the exact
number of blocks it adds to the mix: whole passes over the source, and of one
more pass the blocks that come first in a random order until the target is
reached. A splitting tree parts these quotas among the output shards: a node
gives its left child the vector that drawing half of its blocks without
replacement gives, so that every shard has an exact quota of each source and all
quotas add up. A shard then takes its range of each source's random order, and
within a shard blocks are ordered by another hash.

Ranks and running sums are taken in two steps, inside hash ranges of about
``RANGE`` blocks and over the sums of the ranges, so a source with a third of
all rows is spread like any other.

A draw of the tree is exact: it inverts the hypergeometric distribution, whose
weights follow from each other, outwards from the mode as far as they count in a
double (``REACH`` standard deviations). Source by source, a node's draws are
conditional on those before, which makes the vector multivariate.

Defined results: null text has size 0 and adds nothing; null sources are one
source, last in order; repeated rows are documents of their own; an empty table
gives an empty mix. Runs agree, since every choice comes from hashes of a row's
content and ``seed``.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyflow.llm.common import SPACE_WORD, boxed, checkpointed, content_key, field, load_table, row_id, text_of

# Weights by rank of the source, and the most passes over a source.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
BLOCK = 64             # words
RANGE = 512            # blocks in a hash range, until there are 2**16 ranges
SHARD_BLOCKS = 1 << 16
REACH = 9.0            # standard deviations; what lies beyond is below a double's last digit


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACE_WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """Per source of (source, size): source_size, n_blocks, target.

    All sources below their limit share one level of words per weight; it rises
    until what the limits cut off is reshared. The level and two sums are all
    that a round brings to the driver.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    table = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum(F.ceil(F.col("size") / BLOCK)).alias("n_blocks"))
    per = checkpointed(per.withColumn("weight", table))
    limit = (F.col("source_size") * passes).cast("double")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > limit
        n, cut, free = per.agg(F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))
                               ).first()
        if n == held or not free:
            break
        held, level = n, (total - (cut or 0.0)) / free
    return per.withColumn("target", F.least(F.col("weight") * F.lit(level), limit)).drop("weight")


def ranked_blocks(rows: DataFrame, seed: int) -> DataFrame:
    """Blocks of ``rows`` (rid, source, size, __k1, __k2) with their place in a random order of the
    source: ``place`` from 0, and ``words_before``."""
    total = rows.agg(F.sum(F.ceil(F.col("size") / BLOCK))).first()[0] or 0
    bits = min(16, max(0, ceil(log2(max(total, 1) / RANGE))))
    blocks = (rows.where("size > 0")
              .select("rid", "source", "size", "__k1", "__k2",
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("size") / BLOCK) - 1)).alias("block"))
              .withColumn("words", F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK))
              .withColumn("key", F.xxhash64(F.lit(seed), "__k1", "block"))
              .withColumn("part", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("bigint")))
    per_part = blocks.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(F.col("source").alias("s"), F.col("part").alias("p"),
                             F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                             F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"))
    inside = Window.partitionBy("source", "part").orderBy("key", "__k1", "__k2", "block", "rid")
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = (blocks.withColumn("i", F.row_number().over(inside) - 1)
              .withColumn("c", F.sum("words").over(run) - F.col("words")))
    return (ranked.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
            .select("rid", "source", "block", "words", "__k1", (F.col("n0") + F.col("i")).alias("place"),
                    (F.col("w0") + F.col("c")).alias("words_before")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _steps(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))


def uniform(*parts: Column | int) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    bits = F.shiftrightunsigned(F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts]), 11)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def hypergeometric(more: Column, good: Column, want: Column, u: Column) -> Column:
    """How many of ``want`` draws without replacement from ``more`` items are among its ``good`` ones: the
    outcome at ``u`` of the distribution's outcomes, taken from the mode upwards and then from the mode downwards."""
    def drawn(p: Column) -> Column:
        def real(x):
            return x.cast("double")

        def up(x: Column) -> Column:  # weight of x + 1 by that of x
            return (real(p["good"] - x) * real(p["want"] - x)) / (real(x + 1) * real(p["rest"] - p["want"] + x + 1))

        def down(x: Column) -> Column:  # weight of x - 1 by that of x
            return (real(x) * real(p["rest"] - p["want"] + x)) / (real(p["good"] - x + 1) * real(p["want"] - x + 1))

        def walk(n: Column, first: Column, ratio, at, t: Column) -> Column:
            """The outcome (-1: none) at which ``t`` is used up, and what is left of it."""
            start = F.struct(first.alias("w"), t.alias("t"), F.lit(-1).cast("bigint").alias("x"))

            def step(b, j):
                here = F.struct(b["w"].alias("w"), b["t"].alias("t"), at(j).alias("x"))
                on = F.struct((b["w"] * ratio(at(j))).alias("w"), (b["t"] - b["w"]).alias("t"), b["x"].alias("x"))
                return F.when(b["x"] >= 0, b).when(b["t"] < b["w"], here).otherwise(on)
            return F.aggregate(_steps(n), start, step)

        def total(n: Column, first: Column, ratio, at) -> Column:
            start = F.struct(first.alias("w"), F.lit(0.0).alias("s"))
            return F.aggregate(_steps(n), start, lambda b, j: F.struct(
                (b["w"] * ratio(at(j))).alias("w"), (b["s"] + b["w"]).alias("s")))["s"]
        one, mode = F.lit(1.0), p["mode"]
        ups, downs = F.least(p["hi"] - mode, p["reach"]) + 1, F.least(mode - p["lo"], p["reach"])
        above, below = (lambda j: mode + j - 1), (lambda j: mode - j)
        first = F.when(downs > 0, down(mode)).otherwise(F.lit(0.0))
        whole = total(ups, one, up, above) + total(downs, first, down, below)

        def rest(b):
            lower = _let(walk(downs, first, down, below, b["t"]), lambda c: F.when(c["x"] >= 0, c["x"]).otherwise(mode))
            return F.when(b["x"] >= 0, b["x"]).otherwise(lower)
        return _let(walk(ups, one, up, above, u * whole), rest)
    n, k, m = (x.cast("double") for x in (more, good, want))
    low, high = F.greatest(F.lit(0).cast("bigint"), want - (more - good)), F.least(good, want)
    share = k / F.greatest(n, F.lit(1.0))
    deviation = F.sqrt(F.greatest(F.lit(0.0), m * share * (1 - share) * (n - m) / F.greatest(n - 1, F.lit(1.0))))
    mode = F.floor((m + 1) * (k + 1) / (n + 2)).cast("bigint")
    return _let(F.struct(good.alias("good"), (more - good).alias("rest"), want.alias("want"), low.alias("lo"), high.alias("hi"),
                         F.least(high, F.greatest(low, mode)).alias("mode"),
                         (F.ceil(deviation * REACH) + 40).cast("bigint").alias("reach")), drawn)


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """Rows (source, quota) parted among shards: (source, shard, low, high), ranges of the source's places.

    Each round splits every node of the tree in two, one row per node with the
    vector of its quotas that are not zero; a node of k shards gives its left child k // 2.
    """
    zero = F.lit(0).cast("bigint")
    root = quotas.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source",
                                                           F.col("quota").cast("bigint").alias("q")))).alias("v"))
    nodes = root.select(F.lit(0).alias("first"), F.lit(n_shards).alias("k"), "v")

    def take(a, x):
        """The draw of one source: of ``more`` blocks left in the node, ``want`` still go left."""
        u = uniform(seed, F.col("first"), F.col("k"), x["source"], x["last"].cast("int"))
        return _let(hypergeometric(a["more"], x["q"], a["want"], u), lambda d: F.struct(
            (a["more"] - x["q"]).alias("more"), (a["want"] - d).alias("want"), F.concat(a["out"], F.array(d)).alias("out")))
    for _ in range(ceil(log2(n_shards)) if n_shards > 1 else 0):
        nodes = nodes.withColumn("all", F.aggregate("v", zero, lambda a, x: a + x["q"]))
        start = F.struct(F.col("all").alias("more"), F.expr("(all * (k div 2)) div k").alias("want"),
                         F.array().cast("array<bigint>").alias("out"))
        nodes = nodes.withColumn("l", F.when(F.col("k") > 1, F.aggregate("v", start, take, lambda a: a["out"])))
        part = "filter(transform(v, (x, i) -> named_struct('last', x.last, 'source', x.source, 'q', {})), x -> x.q > 0)"
        nodes = checkpointed(nodes.select(F.explode(F.when(F.col("k") > 1, F.array(
            F.struct("first", F.expr("k div 2").alias("k"), F.expr(part.format("l[i]")).alias("v")),
            F.struct(F.expr("first + k div 2").alias("first"), F.expr("k - k div 2").alias("k"),
                     F.expr(part.format("x.q - l[i]")).alias("v"))))
            .otherwise(F.array(F.struct("first", "k", "v")))).alias("n")).select("n.*").repartition("first"))
    leaves = checkpointed(nodes.select(F.col("first").alias("shard"), F.inline("v")).drop("last"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return (leaves.withColumn("high", F.sum("q").over(before)).withColumn("low", F.col("high") - F.col("q"))
            .where("q > 0").select("source", "shard", "low", "high"))


def sized_rows(docs: DataFrame, key_cols: list[str], text_col: str = "text", id_col: str = "doc_id",
               source_col: str = "source") -> DataFrame:
    """(rid, doc_id, source, size, __k1, __k2) of every row, kept in the checkpoint folder."""
    text = text_of(text_col)
    keys = [text if c == text_col else F.col(f"`{c}`") for c in key_cols]
    return checkpointed(docs.select(row_id().alias("rid"), F.col(id_col).alias("doc_id"),
                                    F.col(source_col).cast("string").alias("source"),
                                    word_count(text).alias("size"), *content_key(*keys)))


def mixture(rows: DataFrame, seed: int = 0, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Targets per source, and the mix: a row per use of a block, (rid, source, block, words, round,
    shard, turn). ``rows`` come from ``sized_rows``; order by ``turn`` shuffles within a shard."""
    targets = checkpointed(source_targets(rows))
    share = targets.select(F.col("source").alias("s"), "source_size", "n_blocks", "target")
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.col("target") - whole * F.col("source_size")
    # of the last pass a block is taken if that brings the words nearer to the target
    extra = (F.col("words_before") + F.col("words") / 2 <= rest).cast("bigint")
    blocks = checkpointed(ranked_blocks(rows, seed).join(share, F.col("source").eqNullSafe(F.col("s")))
                          .select("rid", "source", "block", "words", "__k1", "place", "n_blocks",
                                  (whole + extra).alias("uses")))
    quotas = blocks.groupBy("source").agg(F.sum("uses").alias("quota"))
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    n_shards = max(1, ceil(total / shard_blocks))
    units = (blocks.where("uses > 0")
             .withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("uses") - 1)))
             .withColumn("unit", F.col("round") * F.col("n_blocks") + F.col("place")))
    # units meet the shard whose range holds them, cell by cell of the unit numbers
    cell = max(1, min(RANGE, shard_blocks))
    ranges = split_quotas(quotas, n_shards, seed).select(
        F.col("source").alias("s"), "shard", "low", "high",
        F.explode(F.sequence(F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}"))).alias("cell"))
    placed = units.withColumn("c", F.expr(f"unit div {cell}")).join(
        ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("c") == F.col("cell"))
        & (F.col("unit") >= F.col("low")) & (F.col("unit") < F.col("high")))
    return targets, placed.select("rid", "source", "block", "words", "round", "shard",
                                  F.xxhash64(F.lit(seed + 1), "__k1", "block", "round").alias("turn"))


def mixed_documents(docs: DataFrame, seed: int = 0, text_col: str = "text", id_col: str = "doc_id",
                    source_col: str = "source") -> DataFrame:
    """The mix as documents: each document's whole passes as copies of its row, and one more row with the
    blocks that the last pass takes of it, in their order in the text (``n_chars``, where there is one, set anew).

    Rows without words add nothing.
    """
    names = docs.columns
    rows = sized_rows(docs, names, text_col, id_col, source_col)
    _, mix = mixture(rows, seed)
    full = F.ceil(F.col("size") / BLOCK)
    plan = (mix.groupBy("rid", "round").agg(F.array_sort(F.collect_list("block")).alias("blocks"))
            .join(rows, "rid")
            .select("__k1", "__k2", F.when(F.size("blocks") < full, F.col("blocks")).alias("__blocks")))
    text = text_of(field(text_col))
    keyed = boxed(docs).select("row", *content_key(*[text if c == text_col else field(c) for c in names]))
    out = keyed.dropDuplicates(["__k1", "__k2"]).join(plan, ["__k1", "__k2"])
    cut = F.regexp_extract_all(text, F.lit(rf"(?s)(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){{1,{BLOCK}}}+"), F.lit(0))
    # bound as a lambda's variable, the text is cut once and not for each block
    partial = F.transform(F.array(cut), lambda c: F.array_join(
        F.transform("__blocks", lambda i: F.element_at(c, (i + 1).cast("int"))), ""))[0]
    out = out.withColumn("part", F.when(F.col("__blocks").isNotNull(), partial))
    whole = F.col("__blocks").isNull()
    changed = {text_col: F.when(whole, field(text_col)).otherwise(F.col("part"))}
    if "n_chars" in names:
        changed["n_chars"] = F.when(whole, field("n_chars")).otherwise(
            F.length("part").cast(docs.schema["n_chars"].dataType))
    return out.select(*[changed.get(c, field(c)).alias(c) for c in names])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents: doc_id, size, source_size, target, taken."""
    rows = sized_rows(load_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id", "text"])
    targets, mix = mixture(rows)
    taken = mix.groupBy("rid").agg(F.sum("words").alias("taken"))
    share = targets.select(F.col("source").alias("s"), "source_size", "target")
    return (rows.join(taken, "rid", "left").join(share, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))
