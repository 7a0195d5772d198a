"""Operators over record frames (``key, value, ms, ts, seq``)."""
