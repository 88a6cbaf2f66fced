"""Threaded comments -> examples.

No step gathers a thread. The reply forest is an edge table keyed by (thread, comment), and every
step is an equi-join on that pair; a hot parent only skews the streamed side of a join, which
adaptive execution splits.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from convspark.functions.examples import extra_context_columns
from convspark.functions.text import is_trimmed, normalise_id, trim
from convspark.params import check_positive
from convspark.schema import RAW_COMMENT
from convspark.workspace import materialise, materialise_counting

# Bodies that stand for a comment taken away.
DELETED_BODIES = ("[deleted]", "[removed]")

NODE = ["thread_id", "id"]


def normalise_comments(raw: DataFrame, max_length: int = 127) -> DataFrame:
    """Prune to the used fields, strip id prefixes and trim bodies, before anything is shuffled.

    Rows without an id, thread, parent or body carry no usable text and are dropped.
    """
    needed = [f.name for f in RAW_COMMENT if f.name not in ("author", "subreddit")]
    return raw.dropna(subset=needed).select(
        "id",
        normalise_id("link_id").alias("thread_id"),
        normalise_id("parent_id").alias("parent_id"),
        trim("body", max_length).alias("body"),
        is_trimmed("body", max_length).alias("body_is_trimmed"),
        "author",
        "subreddit",
    )


def unique_comments(comments: DataFrame) -> DataFrame:
    """One row per (thread, id), chosen by content; surplus copies are dropped before the shuffle."""
    order = Window.partitionBy(*NODE).orderBy("body", "author", "parent_id", "subreddit", "body_is_trimmed")
    return comments.withColumn("copy", F.row_number().over(order)).where("copy = 1").drop("copy")


def usable(min_length: int = 9) -> Column:
    """Whether a normalised comment may be a context or a response."""
    return (
        ~F.col("body_is_trimmed") & ~F.col("body").isin(*DELETED_BODIES) & (F.length("body") >= min_length)
    )


def _as_parent(comments: DataFrame, **columns: str) -> DataFrame:
    """The columns asked for, renamed, keyed so that a child finds its parent."""
    return comments.select(
        "thread_id", F.col("id").alias("parent_id"), *[F.col(c).alias(new) for new, c in columns.items()]
    )


def with_parent(comments: DataFrame, **columns: str) -> DataFrame:
    """Comments whose parent is in the same thread, with the parent's columns under new names."""
    return comments.join(_as_parent(comments, **columns), ["thread_id", "parent_id"])


def roots(comments: DataFrame) -> DataFrame:
    """Comments whose parent is not in the thread: top level or stranded."""
    return comments.join(_as_parent(comments), ["thread_id", "parent_id"], "left_anti")


def _unreachable(unresolved: DataFrame, remaining: int) -> tuple[DataFrame, int]:
    """Nodes on a loop or hanging off one, from (thread, id, ptr) with ``ptr`` a far ancestor, and
    their number.

    Each round keeps the nodes whose pointer is itself unresolved and doubles the pointer. A node
    that has a root above it drops out after a logarithmic number of rounds; when a round drops
    nothing, only loops are left.
    """
    while remaining:
        targets = unresolved.select("thread_id", F.col("id").alias("ptr"), F.col("ptr").alias("next"))
        following = unresolved.join(targets, ["thread_id", "ptr"]).select(*NODE, F.col("next").alias("ptr"))
        before = remaining
        unresolved, remaining = materialise_counting(following, "loops")
        if before == remaining:
            break
    return unresolved, remaining


def linear_paths(comments: DataFrame, parent_depth: int = 10) -> DataFrame:
    """``(thread_id, id, ancestors)`` for every reply that hangs below a root.

    ``ancestors`` holds up to ``parent_depth`` ids, the parent first. Pointer doubling: before round
    r an open node knows 2**r ancestors and points to the last of them. When that one is in the
    thread, the node takes over its list and its pointer; when it is not, the last id is struck off
    and the node is finished. A round reads all nodes, but writes only those that were open. Each
    round is one join of two exchanges, so a hot ancestor can be split at run time. What is still
    open after the arrays are full is checked for loops, and loops yield nothing.
    """
    check_positive(parent_depth=parent_depth)
    none = F.array().cast("array<string>")
    is_open = F.col("ptr").isNotNull()
    known = F.when(F.col("parent_id").isNull(), none).otherwise(F.array("parent_id"))
    edges = materialise(comments.select(*NODE, "parent_id"), "edges")
    current = edges.select(*NODE, F.col("parent_id").alias("ptr"), known.alias("ancestors"))
    finished: list[DataFrame] = []

    for r in range(math.floor(math.log2(parent_depth)) + 1):
        finished.append(current.where(~is_open))
        everyone = reduce(DataFrame.unionByName, finished, current.where(is_open))
        targets = everyone.select(
            "thread_id", F.col("id").alias("ptr"), F.col("ancestors").alias("more"), F.col("ptr").alias("next")
        )
        found = F.col("more").isNotNull()
        # the pointer is the last id of a list of 2**r, unless the list was cut off before it
        struck = F.slice("ancestors", 1, 2**r - 1) if 2**r <= parent_depth else F.col("ancestors")
        doubled = (
            current.where(is_open)
            .join(targets, ["thread_id", "ptr"], "left")
            .select(
                *NODE,
                F.col("next").alias("ptr"),
                F.when(found, F.slice(F.concat("ancestors", "more"), 1, parent_depth)).otherwise(struck).alias("ancestors"),
            )
        )
        current, n_open = materialise_counting(doubled, "paths", is_open)
        if not n_open:
            break

    everyone = reduce(DataFrame.unionByName, finished, current)
    paths = everyone.where(F.size("ancestors") > 0).select(*NODE, "ancestors")
    looped, n_looped = _unreachable(current.where(is_open).select(*NODE, "ptr"), n_open)
    return paths.join(looped, NODE, "left_anti") if n_looped else paths


def thread_examples(
    raw: DataFrame,
    parent_depth: int = 10,
    min_length: int = 9,
    max_length: int = 127,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """One example per reply where the reply and its parent are both usable.

    Extra contexts are the further ancestors, trimmed but never filtered. The pair filter runs
    before the ancestors' bodies are fetched, so only surviving examples pay for that join. ``raw`` is
    read once; ``counts``, when given, gets the number of its rows as ``inputs``, from the same job, and that of
    its threads with a readable comment as ``groups``, from one column of the table that job writes.
    """
    num_extra_contexts = parent_depth - 1
    read = Observation()
    seen = raw if counts is None else raw.observe(read, F.count(F.lit(1)).alias("inputs"))
    comments = materialise(unique_comments(normalise_comments(seen, max_length)), "comments")
    if counts is not None:
        counts |= {"inputs": read.get.get("inputs", 0), "groups": comments.agg(F.count_distinct("thread_id")).first()[0]}
    paths = linear_paths(comments, parent_depth)

    candidates = comments.where(usable(min_length))
    pairs = with_parent(candidates, context="body", context_author="author").select(
        "thread_id",
        "id",
        "subreddit",
        "context_author",
        F.col("author").alias("response_author"),
        "context",
        F.col("body").alias("response"),
    )
    # written, as both the texts and the further ancestors come from these pairs
    pairs = materialise(pairs.join(paths, NODE), "pairs")

    further = pairs.where(F.size("ancestors") > 1).select(
        *NODE, F.posexplode(F.slice("ancestors", 2, parent_depth)).alias("i", "ancestor")
    )
    bodies = comments.select("thread_id", F.col("id").alias("ancestor"), F.col("body").alias("text"))
    contexts = (
        further.join(bodies, ["thread_id", "ancestor"])
        .groupBy(*NODE)
        .agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("found"))
        .select(*NODE, F.col("found.text").alias("contexts"))
    )
    return pairs.join(contexts, NODE, "left").select(
        "subreddit",
        "thread_id",
        "context_author",
        "response_author",
        "context",
        "response",
        *extra_context_columns(F.col("contexts"), num_extra_contexts),
    )
