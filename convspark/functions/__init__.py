"""Column expressions."""

from convspark.functions.examples import fixed_width, mix, render_example, serialize_example
from convspark.functions.split import assign_split, split_label, split_value
from convspark.functions.text import (
    is_trimmed,
    normalise_id,
    preprocess_line,
    strip_brackets,
    strip_edges,
    strip_speaker,
    tokens,
    trim,
    word_count,
)

__all__ = [
    "assign_split",
    "fixed_width",
    "is_trimmed",
    "mix",
    "normalise_id",
    "preprocess_line",
    "render_example",
    "serialize_example",
    "split_label",
    "split_value",
    "strip_brackets",
    "strip_edges",
    "strip_speaker",
    "tokens",
    "trim",
    "word_count",
]
