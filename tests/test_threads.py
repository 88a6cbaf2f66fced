import random

import pytest
from pyspark.sql import functions as F

from convspark.functions.split import assign_split
from convspark.operators.threads import (
    linear_paths,
    normalise_comments,
    roots,
    thread_examples,
    unique_comments,
    usable,
    with_parent,
)
from convspark.schema import RAW_COMMENT

EDGES = "thread_id string, id string, parent_id string"

# A golden case that the published results must agree with.
SIMPLE = [
    ("id-A", "top-level", "AAAA", "author-A"),
    ("id-B", "t2_id-A", "BBBB", "author-B"),
    ("id-C", "t2_id-B", "CCCC", "author-C"),
    ("id-D", "t2_id-B", "DDDD", "author-D"),
    ("id-E", "t2_id-D", "EEEE", "author-E"),
    ("id-too-long", "t2_id-D", "too long to create an example", "author-too-long"),
    ("id-too-short", "t2_id-D", "123", "author-too-short"),
    ("id-no-replies", "top-level", "FFFF", "author-too-short"),
]


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_COMMENT)


def simple(spark, *threads):
    return raw(spark, [(i, t, p, b, a, "subreddit-A") for t in threads for i, p, b, a in SIMPLE])


def edges(spark, pairs, thread="t"):
    return spark.createDataFrame([(thread, str(i), str(p)) for i, p in pairs], EDGES)


def paths(df, depth=10):
    """Root side first, as (…, parent, id)."""
    return sorted((*reversed(r.ancestors), r.id) for r in linear_paths(df, depth).collect())


def test_golden_simple_thread(spark, dicts):
    found = assign_split(
        thread_examples(simple(spark, "t3_thread-A", "t3_testthread"), min_length=4, max_length=5), "thread_id", 0.5
    )

    def example(thread, split, context, response, **extras):
        return {
            "subreddit": "subreddit-A", "thread_id": thread, "split": split,
            "context": context * 4, "context_author": f"author-{context}",
            "response": response * 4, "response_author": f"author-{response}",
            **{f"context/{k[1:]}": v for k, v in extras.items()},
        }

    wanted = [
        e
        for thread, split in (("thread-A", "train"), ("testthread", "test"))
        for e in (
            example(thread, split, "A", "B"),
            example(thread, split, "B", "C", _0="AAAA"),
            example(thread, split, "B", "D", _0="AAAA"),
            example(thread, split, "D", "E", _0="BBBB", _1="AAAA"),
        )
    ]
    assert dicts(found) == sorted(wanted, key=lambda r: sorted(r.items()))


def test_normalise_comment(spark):
    df = raw(spark, [("n1", "t3_th", "t1_up", "what a long, long comment", None, "sub")])
    assert normalise_comments(df, 12).first().asDict() == {
        "id": "n1", "thread_id": "th", "parent_id": "up", "body": "what a long", "body_is_trimmed": True, "author": None,
        "subreddit": "sub",
    }
    assert normalise_comments(df).first().body_is_trimmed is False


def test_rows_without_text_are_dropped(spark):
    df = raw(spark, [("a", "t", "p", None, "x", "s"), (None, "t", "p", "body", "x", "s"), ("b", "t", "p", "body", None, "s")])
    assert [r.id for r in normalise_comments(df).collect()] == ["b"]


def test_self_loop_gives_nothing(spark):
    assert paths(edges(spark, [(1, 1)])) == []


def test_same_ids_in_two_threads_do_not_meet(spark):
    df = edges(spark, [(1, "x"), (2, 1)], "t").union(edges(spark, [(2, 1), (3, 2)], "u"))
    assert paths(df) == [("1", "2"), ("2", "3")]


def test_long_chain_next_to_a_loop(spark):
    chain = [(i, i - 1) for i in range(2000)]
    found = paths(edges(spark, [*chain, ("a", "b"), ("b", "a"), ("c", "b")]))
    wanted = sorted(tuple(str(n) for n in range(max(i - 11, 0), i)) for i in range(2, 2001))
    assert found == wanted


def paths_by_walking(pairs, depth):
    parent = dict(pairs)
    out = []
    for node in parent:
        chain, at = [node], parent[node]
        while at in parent and at not in chain:
            chain.append(at)
            at = parent[at]
        if at not in parent and len(chain) > 1:
            out.append(tuple(reversed(chain[: depth + 1])))
    return sorted(out)


@pytest.mark.parametrize("depth", [1, 2, 3, 10])
def test_random_graphs_against_walking(spark, depth):
    rng = random.Random(depth)
    rows, wanted = [], []
    for thread in range(40):
        n = rng.randint(1, 40)
        # one in five comments answers a later or an unseen one: loops, and trees that hang off them or off nothing
        pairs = [(str(i), str(rng.randint(max(0, i - 3), n + 1) if rng.random() < 0.2 else i - 1)) for i in range(n)]
        rows += [(f"t{thread}", i, p) for i, p in pairs]
        wanted += [(f"t{thread}", *p) for p in paths_by_walking(pairs, depth)]
    graph = spark.createDataFrame(rows, EDGES)
    found = linear_paths(graph, depth).collect()
    assert sorted((r.thread_id, *reversed(r.ancestors), r.id) for r in found) == sorted(wanted)
    # a thread starts at a comment whose parent nobody has
    known = {(t, i) for t, i, _ in rows}
    assert sorted((r.thread_id, r.id) for r in roots(graph).collect()) == sorted((t, i) for t, i, p in rows if (t, p) not in known)


def test_extra_contexts_are_trimmed_but_not_filtered(spark):
    rows = [
        ("1", "t", "none", "[deleted]", "a", "s"),
        ("2", "t", "1", "unbroken" * 4, "b", "s"),
        ("3", "t", "2", "context text", "c", "s"),
        ("4", "t", "3", "response text", None, "s"),
    ]
    found = thread_examples(raw(spark, rows), min_length=5, max_length=15).collect()
    assert [(r.context, r.response, r["context/0"], r["context/1"], r["context/2"], r.response_author) for r in found] == [
        ("context text", "response text", "", "[deleted]", None, None)
    ]


def test_number_of_extra_contexts_follows_the_depth(spark):
    rows = [(str(i), "t", str(i - 1), f"comment number {i}", "a", "s") for i in range(30)]
    for depth in (1, 4):
        found = thread_examples(raw(spark, rows), parent_depth=depth)
        extras = [c for c in found.columns if c.startswith("context/")]
        assert extras == [f"context/{i}" for i in range(depth - 1)]
        last = found.where("response = 'comment number 29'").first()
        assert [last[c] for c in extras] == [f"comment number {27 - i}" for i in range(depth - 1)]


def test_copies_of_a_comment_count_once(spark):
    df = simple(spark, "t3_thread-A")
    again = df.union(df).union(df)
    assert unique_comments(normalise_comments(again)).count() == len(SIMPLE)
    assert thread_examples(again, min_length=4, max_length=5).count() == 4
    plan = unique_comments(normalise_comments(again))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") >= 2  # also before the shuffle


def test_usable_and_parents(spark):
    c = normalise_comments(simple(spark, "t3_thread-A"), 5)
    assert sorted(r.id for r in c.where(~usable(4)).collect()) == ["id-too-long", "id-too-short"]
    joined = with_parent(c, parent_body="body").select("id", "parent_body").collect()
    assert ("id-C", "BBBB") in [tuple(r) for r in joined] and len(joined) == 6


def test_hot_parent(spark):
    replies = spark.range(20000).select(
        F.concat(F.lit("r"), F.col("id")).alias("id"), F.lit("t").alias("link_id"),
        F.lit("root").alias("parent_id"), F.concat(F.lit("a reply, number "), F.col("id")).alias("body"),
        F.lit("x").alias("author"), F.lit("s").alias("subreddit"),
    )
    root = raw(spark, [("root", "t", "none", "the root comment", "y", "s")])
    found = thread_examples(replies.unionByName(root))
    assert found.agg(F.count_distinct("response"), F.count("*")).first() == (20000, 20000)


def test_depth_is_checked(spark):
    with pytest.raises(ValueError):
        linear_paths(edges(spark, [(1, 2)]), 0)
