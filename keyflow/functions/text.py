"""Text helpers reproducing the reference's string rules with built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output formats.
JOINER_FORMAT = "user: %s details: %s"
WINDOW_FORMAT = "%s : Window{startMs=%d, endMs=%d}"
SESSION_KEY_FORMAT = "%s - start:%s end:%s"
WORD_SEPARATOR = r"\W+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def jvm_split(text: Column | str, pattern: str = WORD_SEPARATOR) -> Column:
    """``String.split(regex)`` of the JVM as an array column.

    Spark's ``split`` keeps trailing empty tokens; the JVM drops them, keeps a
    leading empty token, returns ``[""]`` for an empty input and ``[]`` for an
    input made only of separators. With a ``+`` pattern no interior token is
    empty, so "drop empties except at index 0" plus the all-separator case is
    the whole rule.
    """
    arr = F.split(_c(text), pattern)
    kept = F.filter(arr, lambda x, i: (x != F.lit("")) | (i == 0))
    only_separators = (F.size(arr) > 1) & (F.size(F.filter(arr, lambda x: x != F.lit(""))) == 0)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(kept)


def jvm_tokens(df, text: Column, keep: list[str] | None = None, name: str = "tok"):
    """Explode ``text`` into its JVM ``split(\\W+)`` tokens, one row each.

    Same rule as :func:`jvm_split`, without lambda functions: ``posexplode``
    and one row filter. Whether a leading empty token survives is decided per
    text *before* the explode (empty text, or text with a word character), so
    exploded rows carry a boolean rather than a copy of the whole text.
    """
    lead_ok = (text == F.lit("")) | text.rlike(r"\w")
    cols = [F.col(c) for c in (keep or [])]
    x = df.select(*cols, lead_ok.alias("_lead_ok"),
                  F.posexplode(F.split(text, WORD_SEPARATOR)).alias("_pos", name))
    cond = (F.col(name) != F.lit("")) | ((F.col("_pos") == 0) & F.col("_lead_ok"))
    return x.filter(cond).drop("_lead_ok", "_pos")


def key_chars_upper(key: Column | str) -> Column:
    """One upper-cased single-character string per character of the key."""
    return F.split(F.upper(_c(key)), "")


def joiner_text(left: Column | str, right: Column | str) -> Column:
    """``String.format("user: %s details: %s", a, b)``; a missing side is ``null``."""
    return F.format_string(JOINER_FORMAT, _c(left), _c(right))


def window_text(key: Column | str, start_ms: Column | str, end_ms: Column | str) -> Column:
    """``key : Window{startMs=…, endMs=…}`` text key of a windowed result."""
    return F.format_string(WINDOW_FORMAT, _c(key), _c(start_ms), _c(end_ms))
