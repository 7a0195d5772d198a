"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow import session
from keyflow.session import _checkpoint_root
from keyflow.sources import load_table

__all__ = ["SPACE_WORD", "boxed", "checkpointed", "comma_sorted", "content_key", "field", "load_table", "row_id",
           "shared_folder", "ship_package", "text_of", "written"]

BATCH_ROWS = 1000
# A word is a run of anything but the six ASCII blanks.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, and their batches fit for texts.

    Spark's default of 10,000 rows in an Arrow batch is meant for narrow rows; of
    long texts it is hundreds of MB in the JVM and again in Python. A setting
    that is not the default is left alone.
    """
    session.ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, for files that other tasks read."""
    return f"{_checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    Unlike a cache or a localCheckpoint the rows outlive the executors that
    made them.
    """
    sc = df.sparkSession.sparkContext
    root = _checkpoint_root(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return df.checkpoint()


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to a fresh folder below the shared one, and read back: compressed, and with
    a size that the planner knows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def boxed(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``row``, so that no name of theirs can clash with a column that an operator adds.

    Fields are ``F.col("row")[name]``, all of them ``row.*``.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def field(name: str) -> Column:
    """A column of boxed ``docs``."""
    return F.col("row")[name]


def row_id() -> Column:
    """A number for each row of a scan.

    Only for plans that number the rows once and carry the number along; two
    scans of a frame need not agree.
    """
    return F.monotonically_increasing_id()


def content_key(*cols: Column) -> list[Column]:
    """Two 64-bit hashes that together stand for the row's content (nulls included)."""
    marks = [c.isNull() for c in cols]
    return [F.xxhash64(*cols, *marks).alias("__k1"),
            F.xxhash64(F.lit("second"), *reversed(cols), *marks).alias("__k2")]


def comma_sorted(values: Column) -> Column:
    """Distinct strings of an array, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")
