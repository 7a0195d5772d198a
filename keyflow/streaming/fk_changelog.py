"""Table–table foreign-key join as a streaming changelog.

Input: one stream of table updates ``side ('L'|'R'), key, value, fk, seq``
(``fk`` = the foreign key extracted from a left value, null for a delete;
right rows carry their own key there). A null value deletes the row. The two
sides are topics of their own: their ``seq`` (offsets) do not compare.

Each micro-batch is merged with DataFrame joins over three table logs: the left
rows and the right rows by key, and the left rows by foreign key (what a right
key's updates have to reach). A batch reads the buckets of the left keys it
updates, of the foreign keys these name, and of the right keys it updates, and
writes only the joined rows of touched keys. A hot foreign key is a skewed join,
which Spark splits. An update with a smaller ``seq`` than the row in the table is
ignored.

Output: ``pk, value, left_seq, right_seq`` changelog; the current join is the
row with the greatest ``left_seq``, then ``right_seq``, per ``pk``, without null
values. Per micro-batch only the net change of each key is propagated. A retried
batch overwrites its own partitions and reads those before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import joiner_text
from keyflow.session import shared_dir
from keyflow.streaming.runner import NO_BATCH, run_batches
from keyflow.streaming.table_log import TableLog, newest_by

NO_ROW = -(1 << 62)  # below every offset
TABLE = "key string, value string, fk string, seq long"
POINTING = "fk string, key string, value string, seq long, here boolean"
LOG = "pk string, value string, left_seq long, right_seq long"


def _newest(rows: DataFrame) -> DataFrame:
    return newest_by(["key"], "seq")(rows.filter(F.col("key").isNotNull()))


def run_fk_join(updates: DataFrame, name: str, joiner: Column | None = None) -> DataFrame:
    """Run the join to the end of ``updates``; returns its changelog with ``batch_id``."""
    spark = updates.sparkSession
    base = shared_dir(spark, name)
    spark.createDataFrame([], LOG).write.parquet(f"{base}/log/batch_id={NO_BATCH}")
    left, right = (TableLog(spark, f"{base}/{side}", TABLE, ["key"], _newest) for side in ("left", "right"))
    pointing = TableLog(spark, f"{base}/pointing", POINTING, ["fk"], newest_by(["fk", "key"], "seq"))
    text = joiner_text(F.col("value"), F.col("rvalue")) if joiner is None else joiner

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession

        def kept(df: DataFrame, part: str, schema: str) -> DataFrame:
            # read again below; written once
            df.write.mode("overwrite").parquet(f"{base}/batch/{part}/batch_id={batch_id}")
            return s.read.schema(schema).parquet(f"{base}/batch/{part}/batch_id={batch_id}")

        def accepted(side: str, table: TableLog) -> DataFrame:
            new = _newest(batch.filter(F.col("side") == side).select(
                "key", F.col("value").cast("string"), F.col("fk").cast("string"), F.col("seq").cast("bigint")))
            old = table.read(s, batch_id, new).select("key", F.col("seq").alias("old_seq"), F.col("fk").alias("old_fk"))
            rows = kept(new.join(old, "key", "left").filter("old_seq is null or seq > old_seq").drop("old_seq"), side,
                        f"{TABLE}, old_fk string")
            table.append(batch_id, rows)
            return rows
        lefts, rights = accepted("L", left), accepted("R", right).select(F.col("key").alias("fk"))
        names = ["fk", "key", "value", "seq"]
        moved = lefts.filter("old_fk is not null and not (old_fk <=> fk)").select(
            F.col("old_fk").alias("fk"), "key", F.lit(None).cast("string").alias("value"), "seq", F.lit(False).alias("here"))
        pointing.append(batch_id, lefts.filter("fk is not null").select(*names, F.lit(True).alias("here")).unionByName(moved),
                        F.col("here"))
        reached = pointing.read(s, batch_id + 1, rights).filter("here").join(lefts, "key", "left_anti")
        touched = kept(lefts.select(*names).unionByName(reached.select(*names)), "touched",
                       "fk string, key string, value string, seq long")
        rvalues = right.read(s, batch_id + 1, touched.filter("fk is not null").select(F.col("fk").alias("key"))).select(
            F.col("key").alias("fk"), F.col("value").alias("rvalue"), F.col("seq").alias("rseq"))
        joined = touched.join(rvalues, "fk", "left")
        live = F.col("value").isNotNull() & F.col("rvalue").isNotNull()
        (joined.select(F.col("key").alias("pk"), F.when(live, text).alias("value"), F.col("seq").alias("left_seq"),
                       F.coalesce("rseq", F.lit(NO_ROW)).alias("right_seq"))
         .write.mode("overwrite").parquet(f"{base}/log/batch_id={batch_id}"))
    run_batches(updates, base.rsplit("/", 1)[-1], merge, f"{base}/checkpoint")
    return spark.read.schema(f"{LOG}, batch_id int").parquet(f"{base}/log")


def current_join(changelog: DataFrame) -> DataFrame:
    """Newest row per pk, deletes dropped."""
    newest = changelog.groupBy("pk").agg(
        F.max_by(F.struct("value"), F.struct("left_seq", "right_seq")).alias("r"))
    return newest.select("pk", F.col("r.value").alias("value")).filter(F.col("value").isNotNull())
