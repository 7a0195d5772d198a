"""Sources and sinks: parquet tables, record frames, streams, Kafka wire codecs."""

from keyflow.sources.records import (
    RECORD_COLUMNS,
    event_records,
    load_table,
    to_records,
)
from keyflow.sources.stream import read_record_stream, read_table_stream

__all__ = [
    "RECORD_COLUMNS", "event_records", "load_table", "to_records",
    "read_record_stream", "read_table_stream",
]
