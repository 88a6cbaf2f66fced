"""Explicit schemas of the inputs and of the example sets. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING = T.StringType()

#: The comment fields the thread builder reads; a wider table is pruned to these.
RAW_COMMENT = T.StructType(
    [T.StructField(name, _STRING) for name in ("id", "link_id", "parent_id", "body", "author", "subreddit")]
)

LINES = T.StructType(
    [T.StructField("file_id", _STRING), T.StructField("line_no", T.LongType()), T.StructField("line", _STRING)]
)

#: Flat records fill ``question``/``answer``; nested ones fill ``questions``.
QA_RECORD = T.StructType(
    [
        T.StructField("asin", _STRING),
        T.StructField("question", _STRING),
        T.StructField("answer", _STRING),
        T.StructField(
            "questions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("questionText", _STRING),
                        T.StructField(
                            "answers", T.ArrayType(T.StructType([T.StructField("answerText", _STRING)]))
                        ),
                    ]
                )
            ),
        ),
    ]
)

#: Descriptive features per kind of example set, next to ``context``, ``response`` and ``context/i``.
THREAD_FEATURES = ("subreddit", "thread_id", "context_author", "response_author")
LINE_FEATURES = ("file_id",)
QA_FEATURES = ("product_id",)


def extra_context(i: int) -> str:
    """Name of the i-th extra context, counted backwards from the one before ``context``."""
    return f"context/{i}"


def example_schema(num_extra_contexts: int, other_features: tuple[str, ...] = ()) -> T.StructType:
    """Schema of an example set: all features are strings, absent ones are null."""
    names = ["context", "response", *map(extra_context, range(num_extra_contexts)), *other_features]
    return T.StructType([T.StructField(name, _STRING) for name in names])
