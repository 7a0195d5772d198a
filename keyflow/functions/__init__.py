"""Column-level helpers (all JVM-side built-ins, codegen friendly)."""

from keyflow.functions.time import epoch_ms, event_time, floor_div, iso_instant, ms_literal
from keyflow.functions.text import (
    joiner_text,
    jvm_split,
    jvm_tokens,
    key_chars_upper,
    window_text,
)
from keyflow.functions.values import cents

__all__ = [
    "epoch_ms", "event_time", "floor_div", "iso_instant", "ms_literal",
    "joiner_text", "jvm_split", "jvm_tokens", "key_chars_upper", "window_text", "cents",
]
