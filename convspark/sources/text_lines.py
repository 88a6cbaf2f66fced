"""Text files as ordered, numbered lines, and the lines that cannot be read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convspark.workspace import broadcast_if_small, materialise, materialise_counting

BAD_TEXT = "not valid UTF-8"


class Lines(NamedTuple):
    """What :func:`read_lines` found; all numbers come from the job that read the files."""

    lines: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def read_lines(spark: SparkSession, pattern: str) -> Lines:
    """Lines of the matching files, the lines that are not UTF-8, and how many lines, files and rejects there are.

    ``lines``: (``path``, ``file_id``, ``line_no``, ``line``); line_no is dense from 0 and counts rejected lines,
    too, so it is the place in the file. ``path`` tells files apart; ``file_id``, the last part of it as it is on
    disk, is the label of the examples and may be the same in several folders. ``rejects``: the first three,
    ``reason`` and the bytes as ``raw``.

    Files stay splittable. Within one split the reader numbers rows consecutively, so a line's
    number is its distance from the first row of the split plus the lines of the splits before it:
    no row is shuffled or sorted. The scan is pinned as a table first, because split boundaries may
    change between two scans when the cluster grows or shrinks.

    Lines end at ``\\n`` only. Raises when nothing matches.
    """
    raw = spark.read.option("lineSep", "\n").text(pattern)
    fine = F.is_valid_utf8("value")
    pinned, n_rejects = materialise_counting(
        raw.select(
            F.col("_metadata.file_path").alias("path"),
            # file names come URL-encoded, but for the plus sign
            F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file_id"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
            F.when(fine, F.col("value")).alias("line"),
            F.when(~fine, F.col("value").cast("binary")).alias("raw"),
        ),
        "lines",
        F.col("raw").isNotNull(),
        compression="zstd",  # all texts once more, as long as the job runs
    )
    splits = pinned.groupBy("path", "start").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    offsets = splits.select("path", "start", "first", "n", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    offsets, n = materialise_counting(offsets, "offsets")
    inputs, groups = offsets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("path")).first()
    numbered = pinned.join(broadcast_if_small(offsets.drop("n"), n), ["path", "start"]).select(
        "path", "file_id", (F.col("row") - F.col("first") + F.col("offset")).alias("line_no"), "line", "raw"
    )
    return Lines(
        numbered.where("raw IS NULL").drop("raw"),
        numbered.where("raw IS NOT NULL").select("path", "file_id", "line_no", F.lit(BAD_TEXT).alias("reason"), "raw"),
        {"inputs": inputs, "groups": groups, "rejects": n_rejects},
    )


def numbered_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """The lines of :func:`read_lines`; one that is not UTF-8 is an error that names its file and place."""
    found = read_lines(spark, pattern)
    if found.counts["rejects"]:
        first = found.rejects.orderBy("path", "line_no").first()
        raise ValueError(f"{found.counts['rejects']} lines are {BAD_TEXT}, such as line {first['line_no']} of {first['path']}")
    return found.lines
