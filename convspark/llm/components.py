"""Connected components of edge tables, and spanning forests of blocks of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convspark.workspace import materialise, materialise_counting


def components(edges: DataFrame, label: str) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (``a``, ``b``, of one orderable type): (``node``, ``root``).

    Every round each node follows its smallest neighbour, and the edges are contracted to what the
    nodes follow; loops and repeated edges vanish. A node with many edges is only a key of a minimum,
    which is taken before the shuffle, and of joins with one row per node on the other side, which
    adaptive execution may split. Each round is written to the shared folder. Rows with a null end are
    ignored; nodes without an edge to another node need not appear. ``edges`` is read twice: it should be
    a table.
    """
    given = edges.where("a IS NOT NULL AND b IS NOT NULL")
    roots = materialise(
        given.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")),
        f"{label}-roots",
    )
    now, n = materialise_counting(_plain(given), f"{label}-edges")
    while n:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        follow = materialise(
            both.groupBy("a").agg(F.min("b").alias("_to")).select("a", F.least("a", "_to").alias("_to")), f"{label}-follow"
        )
        # one jump more: whom the followed node follows
        second = follow.select(F.col("a").alias("_to"), F.col("_to").alias("_far"))
        follow = materialise(
            follow.join(second, "_to").select("a", F.least("_to", "_far").alias("_to")), f"{label}-jump"
        )
        roots = materialise(
            roots.join(follow.withColumnRenamed("a", "root"), "root", "left").select(
                "node", F.coalesce("_to", "root").alias("root")
            ),
            f"{label}-roots",
        )
        there = now.join(follow, "a").select(F.col("_to").alias("_a"), "b")
        moved = there.join(follow.withColumnRenamed("a", "b"), "b").select(F.col("_a").alias("a"), F.col("_to").alias("b"))
        now, n = materialise_counting(_plain(moved), f"{label}-edges")
    return roots


def _plain(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, column) that connect what the true cells of a block connect, fewer than rows + columns.

    Rows and columns are different nodes. Labels spread from the smallest connected node until
    nothing changes; a node then hangs on the first one it has a link with that got the label earlier.
    """
    rows, columns = links.shape
    chosen_rows, chosen_columns = [], []
    seen_rows, seen_columns = np.zeros(rows, bool), np.zeros(columns, bool)
    for start in np.flatnonzero(links.any(axis=1)):
        if seen_rows[start]:
            continue
        seen_rows[start] = True
        front = np.array([start])
        while len(front):
            # columns that the front reaches, each by the first row that does
            reach = links[front] & ~seen_columns
            hit = np.flatnonzero(reach.any(axis=0))
            chosen_rows.append(front[reach[:, hit].argmax(axis=0)])
            chosen_columns.append(hit)
            seen_columns[hit] = True
            back = links[:, hit] & ~seen_rows[:, None]
            front = np.flatnonzero(back.any(axis=1))
            chosen_rows.append(front)
            chosen_columns.append(hit[back[front].argmax(axis=1)] if len(hit) else front)
            seen_rows[front] = True
    if not chosen_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(chosen_rows), np.concatenate(chosen_columns)
