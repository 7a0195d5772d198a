"""keyflow — keyed event-stream operators on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function over a *record
frame* (``key, value, ms, ts, seq``) and works on batch DataFrames; the ones
that make sense on Structured Streaming frames work there too (see
``keyflow.streaming``).
"""

from keyflow.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
