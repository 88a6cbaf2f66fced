"""Ordered dialogue lines -> examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convspark.functions.text import preprocess_line
from convspark.schema import extra_context

LINES_PER_BLOCK = 100_000


def clean_lines(lines: DataFrame) -> DataFrame:
    """Clean every line and drop those that become empty, so that they do not break adjacency.

    A line without a file or a number has no neighbours, and a null line is none; they are left out.
    Unfolding a list of one or no line stands for the filter: a filter would be pushed below the
    projection and run all patterns a second time.
    """
    others = [c for c in lines.columns if c != "line"]
    known = lines.where(F.col("file_id").isNotNull() & F.col("line_no").isNotNull() & F.col("line").isNotNull())
    cleaned = known.select(*others, preprocess_line("line").alias("line"))
    return cleaned.select(*others, F.explode(F.array_remove(F.array("line"), "")).alias("line"))


def _file_key(lines: DataFrame) -> str:
    """The column that tells files apart: the path, where it is known."""
    return "path" if "path" in lines.columns else "file_id"


def _previous_lines(lines: DataFrame, cleaned: DataFrame, depth: int, lines_per_block: int) -> DataFrame:
    """The cleaned lines with ``prev_1 .. prev_depth``, the lines before them in the same file.

    A file may be arbitrarily long, so no window spans one. Windows span (file, block of line
    numbers). The first lines of a block take what they miss from ``carry``: the last lines before
    the block, built from one short row per block. Every block in that table holds at least one
    line, so the ``depth`` blocks before always suffice. Both branches read the same exchange, which
    needs the same null filters on both: :func:`clean_lines` sets them before the join would.
    """
    file = _file_key(lines)
    keys = [file, "block"]
    label = ["file_id"] if file != "file_id" else []
    in_block = Window.partitionBy(*keys).orderBy("line_no")
    blocked = cleaned.withColumn("block", F.floor(F.col("line_no") / lines_per_block)).select(
        *keys,
        *label,
        "line",
        *[F.lag("line", j).over(in_block).alias(f"prev_{j}") for j in range(1, depth + 1)],
        F.row_number().over(in_block).alias("position"),
        F.lead("line_no").over(in_block).isNull().alias("is_last"),
    )

    # Only files longer than a block need tails; without any, the branch is dropped at run time.
    long_files = lines.where(F.col("line_no") >= lines_per_block).select(file).distinct()
    tail = F.array_compact(F.array("line", *[f"prev_{j}" for j in range(1, depth)]))
    tails = blocked.where("is_last").select(*keys, *label, tail.alias("tail")).join(long_files, file, "left_semi")
    over_blocks = Window.partitionBy(file).orderBy("block")
    earlier = F.array_compact(F.array(*[F.lag("tail", j).over(over_blocks) for j in range(1, depth + 1)]))
    # the label goes both ways, so that both branches want the same columns of the exchange
    named = [F.col(c).alias("_label") for c in label]
    carry = tails.select(*keys, *named, F.slice(F.flatten(earlier), 1, depth).alias("carry")).where(F.size("carry") > 0)

    return blocked.join(carry, keys, "left").select(
        F.coalesce("_label", "file_id").alias("file_id") if label else "file_id",
        "line",
        *[
            F.coalesce(f"prev_{j}", F.get("carry", F.lit(j) - F.col("position"))).alias(f"prev_{j}")
            for j in range(1, depth + 1)
        ],
    )


def line_examples(
    lines: DataFrame,
    num_extra_contexts: int = 10,
    min_length: int = 9,
    max_length: int = 127,
    lines_per_block: int = LINES_PER_BLOCK,
) -> DataFrame:
    """One example per pair of consecutive non-empty lines whose lengths are both in range.

    Lines out of range form no pair, but stay visible as extra contexts of later pairs; hence the
    length filter sits above the windows.
    """

    def in_range(c: str) -> Column:
        return F.length(c).between(min_length, max_length)

    paired = _previous_lines(lines, clean_lines(lines), num_extra_contexts + 1, lines_per_block)
    return paired.where(in_range("line") & in_range("prev_1")).select(
        "file_id",
        F.col("prev_1").alias("context"),
        F.col("line").alias("response"),
        *[F.col(f"prev_{i + 2}").alias(extra_context(i)) for i in range(num_extra_contexts)],
    )
