"""Queries over materialised streaming state (interactive queries, re-aimed).

The reference serves ``store.get(key)`` / ``store.all()`` over HTTP from a
running instance. Here a store is the checkpointed state of a streaming
operator, read as a batch DataFrame with the ``statestore`` source (no server).
Lookups are filters on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import store_dir


def read_state(spark: SparkSession, checkpoint: str, state_var: str | None = None,
               operator_id: int | None = None) -> DataFrame:
    """Flattened state rows: key fields, then value fields."""
    r = spark.read.format("statestore")
    if state_var:
        r = r.option("stateVarName", state_var)
    if operator_id is not None:
        r = r.option("operatorId", str(operator_id))
    raw = r.load(checkpoint)
    key_fields = raw.schema["key"].dataType.fieldNames()
    value_fields = raw.schema["value"].dataType.fieldNames()
    cols = [F.col(f"key.{f}").alias(f) for f in key_fields]
    cols += [F.col(f"value.{f}").alias(f if f not in key_fields else f"value_{f}") for f in value_fields]
    return raw.select(*cols)


def state_lookup(state: DataFrame, key: Column) -> DataFrame:
    """Point lookup; a missing key is an empty frame (the reference fails)."""
    return state.filter(key)


def open_store(spark: SparkSession, store: str, state_var: str | None = None) -> DataFrame:
    """The state that ``run_stream(..., store=...)`` keeps under a name."""
    return read_state(spark, store_dir(spark, store), state_var)
