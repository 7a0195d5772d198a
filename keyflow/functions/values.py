"""Value encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(col: Column | str) -> Column:
    """Money as exact BIGINT cents; sums over it are order-independent."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(100)).cast("bigint")
