"""Arrow batches of texts, cut into slices that keep a worker's memory bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of rows with about ``limit`` bytes of text."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, end
        start = end


def gather(values: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments ``values[offsets[p]:offsets[p + 1]]`` for p in ``pick``, joined, and where each ends."""
    lengths = offsets[pick + 1] - offsets[pick]
    ends = np.cumsum(lengths)
    if not len(pick) or not ends[-1]:
        return values[:0], ends
    shift = np.repeat(offsets[pick] - (ends - lengths), lengths)
    return values[np.arange(ends[-1]) + shift], ends


def ends_of(counts: np.ndarray) -> np.ndarray:
    """Offsets (one more than counts) of consecutive groups."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, with as many underscores behind it as no taken name, in any letter case, is like."""
    lower = {c.lower() for c in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish


def set_aside(docs: DataFrame, id_column: str, text_column: str, made: Sequence[str] = ()):
    """``id``, ``text`` and all other columns as one struct, so that no name of theirs meets one of an operator's own.

    Also a function that takes rows with these three back to the columns of ``docs``, without those in ``made``,
    and columns that were made meanwhile.
    """
    others = [c for c in docs.columns if c not in (id_column, text_column, *made)]
    row = F.struct(F.lit(True).alias(free_name(others, "is_row")), *[F.col(f"`{c}`") for c in others])
    narrow = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"), row.alias("row"))

    def back(rows: DataFrame, *added: Column) -> DataFrame:
        known = {id_column: F.col("id"), text_column: F.col("text")}
        kept = [c for c in docs.columns if c in known or c not in made]
        return rows.select(*[(known[c] if c in known else F.col("row")[c]).alias(c) for c in kept], *added)

    return narrow, back


def map_rows(
    df: DataFrame,
    column: str,
    extra: T.StructType,
    work: Callable[[pa.Array], list[pa.Array]],
    rows: int = 256,
    keep_input: bool = True,
) -> DataFrame:
    """All columns of ``df`` and those that ``work`` makes of one column, slice by slice.

    Texts are cut by their bytes, other values into runs of ``rows``. Input columns that ``extra``
    names are replaced; without ``keep_input`` the column that is worked on does not come back.
    """
    keep = [c for c in df.columns if c not in extra.names and (keep_input or c != column)]
    # numbers for names on the way: Spark looks the columns of a function's input up unquoted
    passed = [f"c{k}" for k in range(len(keep))]
    # the column that is worked on crosses once, also where it comes back
    at = keep.index(column) if column in keep else len(keep)
    sent = [(c, p) for c, p in zip(keep, passed, strict=True)] + ([(column, "input")] if at == len(keep) else [])
    source = df.select(*[F.col(f"`{c}`").alias(p) for c, p in sent])
    fields = [source.schema[p] for p in passed] + list(extra)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at)
            by_bytes = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
            cuts = slices(values) if by_bytes else ((a, min(a + rows, len(values))) for a in range(0, len(values), rows))
            for a, b in cuts:
                old = [batch.column(k).slice(a, b - a) for k in range(len(passed))]
                yield pa.RecordBatch.from_arrays(old + work(values.slice(a, b - a)), names)

    mapped = source.mapInArrow(run, T.StructType(fields))
    return mapped.select(*[F.col(p).alias(c) for p, c in zip(passed, keep, strict=True)], *extra.names)


def struct_of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
