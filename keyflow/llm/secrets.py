"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Every text is searched for candidate credentials. Each candidate value is hashed
and its digest counted over the corpus by distinct repositories and owners: a value that
many owners hold is a copied example, one that stays with few owners and looks
random is taken for live. Here a document is a repository and its source the
owner; both are parameters.

The parts of a text between the matches of a pattern and the matches themselves
give each match's place: the places are running sums over the pieces of one
document and kind. Counts are combined map-side, first per value, owner and
repository, then per value and owner, so a value in a third of all rows is a few
rows by the time it meets in one task.

Defined results: null text counts as empty; a null owner or repository counts as
one owner or repository; repeated rows each get a row but count once in the
ownership counts; documents without a match have empty spans; an empty table
gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyflow.llm.common import boxed, checkpointed, content_key, field, load_table, row_id, text_of

MASK = "[removed]"
CUT = 1024             # code points in a block of a text that is masked
# an owner-specific value is with this many owners at most
MAX_OWNERS = 2
MIN_DISTINCT_CHARS = 6
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|x{6}|\*{4}|your[_-]?(key|token|secret|password)|123456"


@dataclass(frozen=True)
class Kind:
    """A kind of candidate: its pattern, the group that is the value (it ends the
    match), the least length of the value, and a string that every match holds."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    holds: str | None = None


# The base kinds. For the last two, runs shorter than the least
# length never match and longer ones match whole, as with a test afterwards.
BASE_KINDS = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=1, least=8),
    Kind("access", r"AKIA[A-Z0-9]{12,}", holds="AKIA"),
    Kind("hex", r"[0-9a-f]{32,}"),
)
MORE_KINDS = (
    # no repeated group (the regex engine recurses for each round), and no start inside a run that failed before
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}", holds="PRIVATE KEY-----"),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", holds="eyJ"),
    Kind("forge", r"gh[pousr]_[A-Za-z0-9]{30,}", holds="gh"),
    Kind("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", holds="xox"),
    Kind("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]++:([^\s:/@]{8,}+)(?=@)", group=1, holds="://"),
)
KINDS = BASE_KINDS + MORE_KINDS


def _found(text: Column, kind: Kind) -> Column:
    hit = text.rlike(kind.pattern)
    return text.contains(kind.holds) & hit if kind.holds else hit


def _pieces(text: Column, kind: Kind) -> Column:
    """Per match of a kind: the text before it, the match and its value; then the rest with a null match."""
    return F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"),
                        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit"),
                        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("value"))


def _matches(text: Column, number: int, kind: Kind) -> Column:
    rows = F.transform(_pieces(text, kind), lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("pos"), F.length(x["gap"]).alias("gap"),
        F.length(x["hit"]).alias("size"), x["value"].alias("value")))
    none = F.array().cast("array<struct<kind:int,pos:int,gap:int,size:int,value:string>>")
    return F.when(_found(text, kind), F.filter(rows, lambda x: x["size"].isNotNull())).otherwise(none)


def _ok(kind: Column, value: Column) -> Column:
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), kind + 1)
    return F.length(value) >= least


def matches(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` times the matches of their text: kind, pos, gap, size, value; one row of nulls where none is."""
    text = F.col(text_col)
    every = F.concat(*[_matches(text, n, k) for n, k in enumerate(KINDS)])
    return rows.withColumn("__m", F.explode_outer(every)).select(
        *[F.col(f"`{c}`") for c in rows.columns if c != text_col], "__m.*")


def plausible(value: Column) -> Column:
    """Whether a value looks random and not like a placeholder."""
    return (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT_CHARS) & ~value.rlike(PLACEHOLDER)


def ownership(candidates: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """Per digest of a value (columns digest, owner, repo, plausible): n_repos, n_owners and whether it looks live."""
    by_repo = candidates.groupBy("digest", "owner", "repo").agg(F.max("plausible").alias("plausible"))
    by_owner = by_repo.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("plausible").alias("plausible"))
    # count(1) keeps null owners, which are one group
    total = by_owner.groupBy("digest").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"),
                                           F.max("plausible").alias("plausible"))
    return total.withColumn("live", (F.col("n_owners") <= max_owners) & F.col("plausible")).drop("plausible")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per row of ``docs``: id, content key, and ``spans``, an array by start then kind of
    (start, kind, end, pos, value, n_repos, n_owners, live); places in code points, end exclusive."""
    text = text_of(text_col)
    owner = F.col(owner_col).cast("string") if owner_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(row_id().alias("rid"), F.col(id_col).alias("doc_id"), *content_key(F.col(id_col), text),
                       owner.alias("owner"), F.col(repo_col or id_col).cast("string").alias("repo"),
                       text.alias("__text"))
    found = checkpointed(matches(rows, "__text"))  # all that is read below; no text, and one pass over it
    run = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = (found.where("kind is not null")
              .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(run))
              .withColumn("start", F.col("end") - F.col("size")).where(_ok(F.col("kind"), F.col("value")))
              .withColumn("digest", F.sha2("value", 256)))
    owned = ownership(placed.select("digest", "owner", "repo", plausible(F.col("value")).alias("plausible")), max_owners)
    spans = placed.join(owned, "digest").select("rid", F.struct(
        "start", "kind", "end", "pos", "value", "n_repos", "n_owners", "live").alias("span"))
    heads = found.select("rid", "doc_id", "__k1", "__k2").distinct()
    per_row = spans.groupBy("rid").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    return heads.join(per_row, "rid", "left").drop("rid").withColumn(
        "spans", F.coalesce("spans", F.array().cast(per_row.schema["spans"].dataType)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def live_places(found: DataFrame) -> DataFrame:
    """Per content key with a live value: ``__places``, an array by start of (start, end) of the live values
    that ``scan`` found, overlapping ones merged."""
    each = (found.select("__k1", "__k2", F.filter("spans", lambda s: s["live"]).alias("spans"))
            .where(F.size("spans") > 0).dropDuplicates(["__k1", "__k2"])
            .select("__k1", "__k2", F.explode("spans").alias("s"))
            # a value ends its match
            .select("__k1", "__k2", (F.col("s.end") - F.length("s.value")).alias("start"), F.col("s.end").alias("end")))
    order = Window.partitionBy("__k1", "__k2").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    merged = (each.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
              .withColumn("n", F.sum("new").over(run))
              .groupBy("__k1", "__k2", "n").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return merged.groupBy("__k1", "__k2").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__places"))


def _masked(text: Column, places: Column) -> Column:
    """``text`` with ``MASK`` for each of the places; its work is linear in the text and the places."""
    def cut(blocks):
        def part(p):
            first, last = (F.floor(p[x] / CUT).cast("int") for x in ("low", "high"))
            low, high = ((p[x] % CUT).cast("int") for x in ("low", "high"))
            head, tail = (F.coalesce(F.get(blocks, i), F.lit("")) for i in (first, last))
            return F.when(first == last, F.substring(head, low + 1, high - low)).otherwise(F.concat(
                F.substring(head, low + 1, F.lit(CUT)), F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
                F.substring(tail, F.lit(1), high)))
        lows = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(places, lambda p: p["end"]))
        highs = F.concat(F.transform(places, lambda p: p["start"]), F.array((F.size(blocks) * CUT).cast("bigint")))
        return F.array_join(F.transform(F.arrays_zip(lows.alias("low"), highs.alias("high")), part), MASK)
    # bound as a lambda's variable, the text is cut into blocks once
    return F.transform(F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))), cut)[0]


def remove_live(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """``docs`` with every live-looking value masked in its text (and ``n_chars``, where there is one, set anew).

    Texts without a candidate are passed on as they are; only the others meet
    their document's findings. A text is cut once, at the places found in it as it
    came, so no mask hides a live value from another kind; values that overlap
    get one mask.
    """
    findings = live_places(scan(docs, id_col, text_col, owner_col, repo_col, max_owners))
    text = text_of(field(text_col))
    suspect = _found(text, KINDS[0])
    for k in KINDS[1:]:
        suspect = suspect | _found(text, k)
    rows = boxed(docs)
    some = (rows.where(suspect).select("row", *content_key(field(id_col), text)).join(findings, ["__k1", "__k2"], "left")
            .withColumn("masked", F.when(F.col("__places").isNotNull(), _masked(text, F.col("__places")))))
    cut = F.col("masked").isNotNull()
    changed = {text_col: F.when(cut, F.col("masked")).otherwise(field(text_col))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(field("n_chars"))
    some = some.select(*[changed.get(c, field(c)).alias(c) for c in docs.columns])
    return rows.where(~suspect).select("row.*").unionByName(some)


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents; ``spans`` lists all spans, ``live_spans`` those of live-looking values,
    n_live and n_example count the spans of either class."""
    found = scan(load_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    live = F.filter("spans", lambda s: s["live"])

    def many(test):
        return F.size(F.filter("spans", test)).cast("bigint")

    def of_kind(n):
        return lambda s: s["kind"] == n
    return found.select(
        "doc_id", *[many(of_kind(n)).alias(f"n_{k.name}") for n, k in enumerate(BASE_KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        many(lambda s: s["live"]).alias("n_live"), many(lambda s: ~s["live"]).alias("n_example"),
        _listed(live).alias("live_spans"))
