"""Jaccard join, components and vector index against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from convspark.llm import jaccard_join
from convspark.llm.components import components, forest
from convspark.llm.multi_index import IndexOptions, multi_sequence, near_vectors
from tests.llm import brute


def near_copies(seed, n):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    bases = [[rnd.choice(words) for _ in range(size)] for size in (4, 12, 13, 40, 60, 61, 150, 300)]
    rows = []
    for i in range(n):
        text = list(rnd.choice(bases))
        for _ in range(rnd.choice((0, 0, 1, 1, 2, 4, 9))):
            kind, at = rnd.randrange(3), rnd.randrange(len(text))
            if kind == 0:
                text[at] = rnd.choice(words)
            elif kind == 1 and len(text) > 2:
                del text[at]
            else:
                text.insert(at, rnd.choice(words))
        rows.append((i, " ".join(text)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "Two words"), (n + 4, "two\tWORDS"), (n + 5, "word " * 40_000)]


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 100)])
def test_jaccard_agrees_with_brute_force(spark, width, percent):
    rows = near_copies(width, 160)
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, n int, node string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, width, percent).collect()}
    assert found == brute.jaccard_components(rows, width, percent)


def test_pieces_of_large_clusters_and_the_smallest_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_MEMBERS", 7)
    monkeypatch.setattr(jaccard_join, "_SHORT_MEMBERS", 11)
    monkeypatch.setattr(jaccard_join, "_BLOCK", 500)
    rows = near_copies(9, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 80).collect()}
    assert found == brute.jaccard_components(rows, 3, 80)


@pytest.mark.parametrize("population", [0.0, 1e4, 1e12])
@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_always_share_a_signature(percent, population):
    random_sets = np.random.default_rng(percent)
    bands = jaccard_join.Bands(400, percent, {k: population for k in range(60)})
    assert population < 1e9 or any(s.deleted for s in bands.schemes)
    for _ in range(300):
        a = random_sets.integers(1 << 40, size=random_sets.integers(1, 200)).astype(np.uint64)
        b = a.copy()
        for _ in range(random_sets.integers(0, 1 + len(a) // 4)):
            if random_sets.random() < 0.5 and len(b) > 1:
                b = np.delete(b, random_sets.integers(len(b)))
            else:
                b = np.append(b, random_sets.integers(1 << 40)).astype(np.uint64)
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= percent * (len(a) + len(b) - shared):
            keys, of = jaccard_join.signatures([a, b], bands)
            mine, theirs = ({int(k) >> 1: None for k in keys[of == i]} for i in (0, 1))
            whole = {int(k) >> 1 for k in keys[(keys & np.uint64(1)) == 0]}
            assert mine.keys() & theirs.keys() & whole
            assert jaccard_join.linked([a], [b], percent)[0, 0]


@pytest.mark.parametrize("percent", range(80, 101, 5))
@pytest.mark.parametrize("common", [0.0, 0.001, 0.05])
def test_credit_is_never_short(percent, common):
    """Exact and deleted segments together outnumber the largest difference, slack included, for any number of sets."""
    for population in (0.0, 3.0, 8.0, 100.0, 1e4, 1e6, 1e9, 1e12):
        bands = jaccard_join.Bands(3000, percent, {k: population for k in range(60)}, common)
        for s in bands.schemes:
            furthest = int(jaccard_join.largest_difference(2 * s.high, percent))
            assert s.exact + 2 * s.deleted >= furthest + 1 + s.slack and s.segments <= 4 * (furthest + 1) + 8
        assert [s.low for s in bands.schemes[1:]] == [s.high + 1 for s in bands.schemes[:-1]]


def test_sets_that_need_empty_segments(spark):
    """Texts of a few shingles, where most segments are empty."""
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 14)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 80).collect()}
    assert found == brute.jaccard_components(rows, 3, 80)


def test_short_shingles_lose_no_link():
    """Elements that fall together count in favour of a link."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = rng.choice(200, 40, replace=False).astype(np.uint64)
        b = np.unique(np.concatenate([a[: rng.integers(30, 41)], rng.choice(200, 4).astype(np.uint64)]))
        kinds = np.uint64(rng.choice([64, 97]))
        short = [[np.unique(x % kinds)] for x in (a, b)]
        sizes = tuple(np.array([len(x)]) for x in (a, b))
        for many in (1, 5):  # one by one, and all at once
            sides = [x * many for x in short]
            found = jaccard_join.linked(*sides, 80, tuple(np.repeat(n, many) for n in sizes))
            assert found.all() or not jaccard_join.linked([a], [b], 80)[0, 0]
    one = [np.array([1, 2, 3, 4, 5], np.uint64)]
    assert jaccard_join.linked(one, one, 100, (np.array([5]), np.array([5]))).all()
    assert not jaccard_join.linked(one, one, 100, (np.array([6]), np.array([7]))).any()


def test_overlap_of_unrelated_sets():
    words = np.arange(1, 2001, dtype=np.uint64)
    sets = [words[k * 100 : k * 100 + 102] for k in range(19)] + [words[:101], np.empty(0, np.uint64)]
    shared = jaccard_join.shared_by_unrelated(sets)
    plain = [len(np.intersect1d(a, b)) / min(len(a), len(b)) for i, a in enumerate(sets[:20]) for b in sets[i + 1 : 20]]
    assert shared == pytest.approx(np.mean([x for x in plain if x < 0.5]))
    assert jaccard_join.shared_by_unrelated([]) == jaccard_join.shared_by_unrelated(sets[:1]) == jaccard_join._COMMON


def test_repeated_rows_and_ids(spark):
    long = " ".join(f"w{k}" for k in range(50))
    rows = [(5, long), (5, long), (7, long + " end"), (None, long), (2, "x y z"), (2, "p q r"), (None, None), (9, None), (9, None)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, extra int")
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 80).collect())
    assert found == sorted([("5", 48, 5), ("5", 48, 5), ("7", 49, 5), ("None", 48, 5), ("2", 1, 2), ("2", 1, 2), ("None", 0, None), ("9", 0, 9), ("9", 0, 9)])
    kept = jaccard_join.drop_near_copies(docs, 3, 80)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        [("5", long), ("2", "x y z"), ("2", "p q r"), ("None", ""), ("9", ""), ("9", "")]
    )
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.jaccard_components(docs, 3, 50)


def test_components_of_paths_stars_and_loops(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(70)]
    rnd.shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    plain = [(a, b) for a, b in edges if a is not None]
    assert found == brute.components({x for e in plain for x in e}, plain)


def test_forest_spans():
    random_links = np.random.default_rng(3)
    for _ in range(50):
        links = random_links.random((random_links.integers(1, 12), random_links.integers(1, 12))) < 0.15
        rows, columns = links.shape
        every = [(int(a), int(rows + b)) for a, b in zip(*np.nonzero(links), strict=True)]
        a, b = forest(links)
        assert all(links[x, y] for x, y in zip(a, b, strict=True)) and len(a) <= rows + columns
        nodes = range(rows + columns)
        assert brute.components(nodes, [(int(x), int(rows + y)) for x, y in zip(a, b, strict=True)]) == brute.components(nodes, every)


def test_multi_sequence_is_in_order_and_complete():
    first, second = [0.0, 0.1, 0.5, 0.5, 2.0], [0.0, 0.2, 0.2, 1.0]
    seen = list(multi_sequence(first, second, 1.0))
    sums = [first[i] + second[j] for i, j in seen]
    assert sums == sorted(sums) and len(set(seen)) == len(seen)
    assert set(seen) == {(i, j) for i, a in enumerate(first) for j, b in enumerate(second) if a + b <= 1.0}
    assert list(multi_sequence([], [1.0], 9)) == []


def vectors(n=1500, dimension=16):
    random_rows = np.random.default_rng(5)
    centres = random_rows.normal(size=(n // 5, dimension))
    rows = []
    for i in range(n):
        v = centres[random_rows.integers(len(centres))] + random_rows.normal(size=dimension) * random_rows.choice([0.05, 0.2, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3) if i % 50 else None, i))
    same = rows[1][1]
    odd = [(n, None, 1), (n + 1, [0.0] * dimension, 1), (n + 2, [float("nan")] * dimension, 1), (n + 3, [None] + [1.0] * (dimension - 1), 1), (n + 4, [], 1), (n + 5, [1.0] * 4, 1), (n + 6, same, 1), (n + 7, same, 1), (n + 7, same, 1), (n + 8, [float("inf")] * dimension, 1)]
    return rows + [(*r, 0) for r in odd]


def brute_vectors(rows, limit):
    fine = {}
    for k, (_, v, label, _) in enumerate(rows):
        if label is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v):
            fine[k] = np.asarray(v, np.float32).astype(float)
    keys = list(fine)
    matrix = np.array([fine[k] for k in keys])
    norm = np.linalg.norm(matrix, axis=1)
    cosine = matrix @ matrix.T / norm[:, None] / norm
    links = [(keys[a], keys[b]) for a, b in zip(*np.nonzero(np.triu(cosine >= limit, 1)), strict=True) if rows[keys[a]][2] == rows[keys[b]][2]]
    return links


def test_vector_recall_and_no_false_link(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int").repartition(4)
    options = IndexOptions(codewords=8)
    found = near_vectors(table, options).collect()
    links = brute_vectors(rows, options.min_cosine)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    wanted = sorted((rows[k][0], int(d)) for k, d in enumerate(degree))
    mine = sorted((r.vec_id, r.n_links) for r in found)
    assert [i for i, _ in mine] == [i for i, _ in wanted]
    assert all(a <= b for (_, a), (_, b) in zip(mine, wanted, strict=True))
    recall = sum(n for _, n in mine) / sum(n for _, n in wanted)
    print("recall", recall)
    assert recall >= 0.99
    group = brute.components(range(len(rows)), links)
    least = {}
    for k, g in group.items():
        least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    right = sum(r.component_id == least[group[k]] for k, r in ((k, r) for r in found for k in [next(j for j, x in enumerate(rows) if x[0] == r.vec_id)]))
    assert right / len(rows) > 0.98 and all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert near_vectors(table.limit(0)).count() == 0


def test_pieces_of_hot_cells(spark, monkeypatch):
    from convspark.llm import multi_index

    monkeypatch.setattr(multi_index, "_MEMBERS", 16)
    rows = vectors(400)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    found = near_vectors(table, IndexOptions(codewords=2, target_recall=1.0)).collect()
    degree = np.bincount(np.array(brute_vectors(rows, 0.93)).ravel(), minlength=len(rows))
    assert sum(r.n_links for r in found) >= 0.99 * degree.sum()


def cosine_links(rows, least=0.93):
    """Pairs of places whose vectors have one label, one dimension and a cosine in double precision of ``least``."""
    out = []
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows[:i]):
            if None in (a, b, x, y) or x != y or len(a) != len(b) or None in a or None in b:
                continue
            u, v = np.array(a, np.longdouble), np.array(b, np.longdouble)
            if np.isfinite(u).all() and np.isfinite(v).all() and u.any() and v.any():
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= least:
                    out.append((j, i))
    return out


def test_vectors_of_all_dimensions_and_sizes(spark):
    rng = np.random.default_rng(4)
    rows = []
    for d in (1, 2, 3, 3, 8, 17):
        for _ in range(30):
            base = rng.normal(size=d)
            rows += [(base * s + 0.1 * rng.normal(size=d) * s).tolist() for s in (1.0, -2.0, 1e-200, 1e200, 3e38)]
    rows = [(i, v, ("x", "y")[i % 7 == 0]) for i, v in enumerate(rows)]
    n = len(rows)
    odd = [[1.0, 0.0], [1.0, 0.0], [1.0, 0.0, 0.0], [2.0], [3.0], [-1.0], [], None, [0.0], [0.0, 0.0], [None, 1.0], [float("nan")], [float("inf"), 1.0], [5e-324]]
    rows += [(n + i, v, "x") for i, v in enumerate(odd)] + [(n + 50, [1.0, 0.0], None), (n + 51, [2.0], "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    links = cosine_links(rows)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    group = brute.components(range(len(rows)), links)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(table, IndexOptions(codewords=1)).collect()}
    assert found == {
        rows[k][0]: (degree[k], rows[group[k]][0], group[k] == k) for k in range(len(rows))
    } and degree.sum() > 1000


def test_doubles_are_not_rounded_to_floats(spark):
    """Two pairs on either side of the threshold by less than a float can tell."""
    angle = np.arccos(0.93)
    rows = [(0, [1.0, 0.0], "a"), (1, [float(np.cos(angle - 1e-10)), float(np.sin(angle - 1e-10))], "a")]
    rows += [(2, [1.0, 0.0], "b"), (3, [float(np.cos(angle + 1e-10)), float(np.sin(angle + 1e-10))], "b")]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted((r.vec_id, r.n_links) for r in found.collect()) == [(0, 1), (1, 1), (2, 0), (3, 0)]


def test_one_repeated_vector_fills_no_sample(spark):
    rows = spark.range(30_000).selectExpr("id vec_id", "array(1.0D, cast(if(id < 29000, 0, id) as double)) embedding", "'l' label")
    found = near_vectors(rows, IndexOptions(sample=100))
    assert found.where("vec_id < 29000").agg({"n_links": "min"}).first()[0] == 28_999


def test_comparison_and_edges_hold_little_besides_their_input(monkeypatch):
    """Ranges of values agree with one range, and memory beyond input and result is that of a range."""
    rng = np.random.default_rng(4)
    bases = [rng.integers(1 << 32, size=500, dtype=np.uint32) for _ in range(60)]

    def some(n):
        return [np.unique(np.concatenate([bases[rng.integers(60)][rng.integers(90) :], rng.integers(1 << 32, size=20, dtype=np.uint32)])) for _ in range(n)]

    left, right = some(600), some(500)
    monkeypatch.setattr(jaccard_join, "_RANGE", 10_000_000)
    whole = [jaccard_join.shared_elements(left, x) for x in (right, left)]
    plain = [[len(np.intersect1d(a, b)) for b in right[:50]] for a in left[:50]]
    assert (whole[0][:50, :50] == plain).all()
    monkeypatch.setattr(jaccard_join, "_RANGE", 20_000)
    tracemalloc.start()
    cut = [jaccard_join.shared_elements(left, x) for x in (right, left)]
    links = jaccard_join.linked(left, right, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True)) and links.any() and not links.all()
    assert peak < 10_000_000  # 24 million before


def test_sets_that_meet_by_accident_form_no_large_cluster(spark, monkeypatch):
    """Texts that only share some shingles are not compared with each other, and copies are still found."""
    rnd = random.Random(31)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(25, 60)))) for i in range(600)]
    rows += [(2000 + i, f"{rows[i][1]} {rows[i][1][0]}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = brute.jaccard_components(rows, 3, 80)
    sizes = {}
    count = jaccard_join.materialise_counting

    def spy(df, label, condition=None):
        table, n = count(df, label, condition)
        if label == "jaccard-chosen":
            sizes[label] = n, table.groupBy("root").count().agg({"count": "max"}).first()[0]
        return table, n

    monkeypatch.setattr(jaccard_join, "materialise_counting", spy)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 80).collect()} == wanted
    linked = [k for k in wanted if sum(c == wanted[k][1] for _, c in wanted.values()) > 1]
    # 531 texts, 502 of them in one cluster, when all that met were joined
    assert len(linked) <= sizes["jaccard-chosen"][0] < 250 and sizes["jaccard-chosen"][1] < 150


def test_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(12)
    left, right = [], []
    for n in (1, 3, 40, 63, 64, 65, 500, 1030, 70_000):
        for share in (0.0, 0.1, 0.3, 1.0):
            a = np.unique(rng.integers(1 << 63, size=n, dtype=np.uint64))
            left.append(a)
            right.append(np.unique(np.concatenate([a[rng.random(len(a)) >= share], rng.integers(1 << 63, size=1 + int(share * n / 2), dtype=np.uint64)])))
    found = jaccard_join.least_difference(*(pa.array(jaccard_join.sketches(side), pa.binary()) for side in (left, right)))
    apart = np.array([len(np.setxor1d(a, b)) for a, b in zip(left, right, strict=True)])
    assert (found <= apart).all()
    total = np.array([len(a) + len(b) for a, b in zip(left, right, strict=True)])
    far = (apart >= 0.9 * total) & (total > 200) & (total < 50_000)
    assert far.any() and (found[far] > jaccard_join.largest_difference(total[far], 80)).all()


def test_pairs_and_edges_join_what_shares_a_signature():
    """Tasks hand on enough of a frequent signature; one that only has deleted entries, and few, joins nothing."""
    rng = np.random.default_rng(3)
    keys = rng.integers(60, size=900).astype(np.uint64) << np.uint64(1)
    keys[rng.random(900) < 0.3] |= np.uint64(1)
    keys = np.concatenate([keys, np.full(50, 400, np.uint64), np.array([501, 501, 601, 600, 601], np.uint64)])
    nodes = np.concatenate([rng.integers(300, size=900), 1000 + np.arange(50), [2000, 2001, 2002, 2003, 2004]])
    task = rng.integers(3, size=len(keys))
    edges, handed = [], []
    for t in range(3):
        mine = np.flatnonzero(task == t)
        star, _, kept = jaccard_join.meetings(keys[mine], nodes[mine], 4)
        edges.append(star)
        handed.append(mine[kept])
    handed = np.concatenate(handed)
    star, pairs, _ = jaccard_join.meetings(keys[handed], nodes[handed], 4)
    assert sum(keys[handed] == 400) == 15
    found = {frozenset(p) for p in np.concatenate([*edges, star, pairs], axis=1).T.tolist()}
    joined = brute.components({x for p in found for x in p}, [tuple(p) for p in found])
    for bucket in np.unique(keys >> np.uint64(1)):
        mine = {(int(n), int(k) & 1) for k, n in zip(keys, nodes, strict=True) if k >> np.uint64(1) == bucket}
        for a, d in mine:
            for b, _ in mine:
                if not d and a != b:
                    assert joined[a] == joined[b]
    assert 2000 not in joined and frozenset((2002, 2004)) not in found and {frozenset((2002, 2003)), frozenset((2003, 2004))} <= found
