"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convspark.llm.components import components, forest
from convspark.workspace import materialise, materialise_counting

#: Vectors of one side of a comparison.
_MEMBERS = 1024
#: Codewords of one half at most, and bytes of the sample that all codebooks are fitted on.
_CODEWORDS, _SAMPLE_BYTES = 4096, 1 << 26


@dataclass(frozen=True)
class IndexOptions:
    """``sample`` bounds the rows that codebooks are fitted on; all rows are indexed and searched.

    ``target_recall`` is the share of links at the very threshold that traversal must find; closer
    pairs are found more often. ``codewords`` per half: None takes one cell for about ``cell_size`` rows.
    """

    min_cosine: float = 0.93
    target_recall: float = 0.995
    sample: int = 20_000
    cell_size: int = 64
    codewords: int | None = None
    iterations: int = 12
    seed: int = 10


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves of unit vectors, and how far beyond the nearest cell traversal goes."""

    books: tuple[np.ndarray, np.ndarray]
    beyond: float

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.books[0].shape[1]
        return tuple(
            np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)
            for x, book in zip((units[:, :half], units[:, half:]), self.books, strict=True)
        )

    def cells(self, units: np.ndarray) -> np.ndarray:
        first, second = self.distances(units)
        return first.argmin(1) * len(self.books[1]) + second.argmin(1)

    def visits(self, units: np.ndarray) -> Iterator[list[int]]:
        """For each vector the cells that traversal reaches, nearest first."""
        first, second = self.distances(units)
        order = [np.argsort(d, axis=1, kind="stable") for d in (first, second)]
        ranked = [np.take_along_axis(d, o, 1) for d, o in zip((first, second), order, strict=True)]
        width = len(self.books[1])
        for (oa, ob), (da, db) in zip(zip(*order, strict=True), zip(*ranked, strict=True), strict=True):
            limit = da[0] + db[0] + self.beyond
            ra, rb = da[: np.searchsorted(da, limit - db[0], "right")].tolist(), db[: np.searchsorted(db, limit - da[0], "right")].tolist()
            yield [int(oa[i]) * width + int(ob[j]) for i, j in multi_sequence(ra, rb, limit)]


def multi_sequence(first: list[float], second: list[float], limit: float) -> Iterator[tuple[int, int]]:
    """Pairs of places of two ascending lists in order of the sum, as long as it is within ``limit``.

    A pair enters the queue when both pairs before it, in either list, have been visited.
    """
    if not first or not second:
        return
    queue = [(first[0] + second[0], 0, 0)]
    done = [0] * len(first)  # how many places of the second list were visited with each of the first
    while queue:
        total, i, j = heapq.heappop(queue)
        if total > limit:
            return
        yield i, j
        done[i] = j + 1
        if i + 1 < len(first) and done[i + 1] == j:
            heapq.heappush(queue, (first[i + 1] + second[j], i + 1, j))
        if j + 1 < len(second) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(queue, (first[i] + second[j + 1], i, j + 1))


def _codebook(rows: np.ndarray, k: int, iterations: int, random: np.random.Generator) -> np.ndarray:
    book = rows[random.permutation(len(rows))[:k]].copy()
    for _ in range(iterations):
        near = ((book * book).sum(1) - 2 * rows @ book.T).argmin(1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(book)
        np.add.at(sums, near, rows)
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def fit_index(units: np.ndarray, total: int, options: IndexOptions) -> MultiIndex:
    """Fit both codebooks on unit vectors and set how far traversal goes.

    For each sampled vector a partner at exactly the threshold cosine is drawn in a random direction.
    Traversal from the vector must reach the partner's cell, which costs so much more than the nearest
    cell; the ``target_recall`` quantile of that excess is the limit.
    """
    random = np.random.default_rng(options.seed)
    half = units.shape[1] // 2
    k = options.codewords or int(np.clip(np.sqrt(total / options.cell_size), 1, _CODEWORDS))
    k = max(1, min(k, len(units)))
    books = tuple(_codebook(x, k, options.iterations, random) for x in (units[:, :half], units[:, half:]))
    index = MultiIndex(books, 0.0)
    aside = random.normal(size=units.shape)
    aside -= (aside * units).sum(1)[:, None] * units
    norm = np.linalg.norm(aside, axis=1)
    c = options.min_cosine
    partner = c * units + np.sqrt(max(0.0, 1 - c * c)) * aside / np.where(norm > 0, norm, 1)[:, None]
    mine, theirs = index.distances(units), index.distances(partner)
    row = np.arange(len(units))
    excess = sum(d[row, t.argmin(1)] - d.min(1) for d, t in zip(mine, theirs, strict=True))
    return MultiIndex(books, float(np.quantile(excess, options.target_recall)) if len(units) else 0.0)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square overflows or vanishes; cosines stay what they are."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return _scaled(np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _links(a: np.ndarray, b: np.ndarray, min_cosine: float) -> np.ndarray:
    cosine = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)
    return cosine >= min_cosine


def _verify(min_cosine: float):
    """Per task, of one label and dimension: links between side 0 and side 1, or inside side 0; counts of links and spanning edges."""

    def run(table: pa.Table) -> pa.Table:
        task, side, node, copies = (table.column(c).to_numpy() for c in ("task", "side", "node", "copies"))
        vectors = table.column("vector").combine_chunks()
        a, b, n = [], [], []
        order = np.argsort(task, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(task[order])) + 1) if len(order) else []:
            sides = [rows[side[rows] == k] for k in (0, 1)]
            within = not len(sides[1])
            if not len(sides[0]) or (within and len(sides[0]) < 2):
                continue
            left = _matrix(vectors.take(pa.array(sides[0])))
            right = left if within else _matrix(vectors.take(pa.array(sides[1])))
            links = _links(left, right, min_cosine)
            if within:
                np.fill_diagonal(links, False)
                sides[1] = sides[0]
            counts = [(sides[0], links @ copies[sides[1]])]
            if not within:
                counts.append((sides[1], links.T @ copies[sides[0]]))
            for who, found in counts:
                hit = found > 0
                a.append(node[who[hit]])
                b.append(np.full(int(hit.sum()), -1))
                n.append(found[hit])
            x, y = forest(links)
            a.append(node[sides[0][x]])
            b.append(node[sides[1][y]])
            n.append(np.full(len(x), -1))
        join = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64)
        a, b, n = join(a), join(b), join(n)
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=n >= 0), "n": pa.array(n, mask=n < 0)})

    return run


def _fit_all(distinct: DataFrame, options: IndexOptions) -> dict[int, MultiIndex]:
    """An index per dimension, fitted on a sample of distinct vectors that is shared out by their numbers.

    The sample has ``options.sample`` rows and 64 MB at most; a dimension without a row in it is one cell.
    """
    counts = distinct.groupBy(F.size("_vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    mean = sum(r["n"] * r["size"] for r in counts) / max(total, 1)
    share = min(1.0, min(options.sample, _SAMPLE_BYTES / (8 * max(mean, 1))) / max(total, 1))
    chosen = F.pmod(F.xxhash64("node", F.lit(options.seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    drawn = distinct.where(chosen).select("node", "_vector").toArrow().sort_by("node").column("_vector").to_pylist()
    indexes = {}
    for r in counts:
        rows = [x for x in drawn if len(x) == r["size"]]
        if rows and r["size"] > 1:
            indexes[r["size"]] = fit_index(_unit(_scaled(np.array(rows, np.float64))), r["n"], options)
        else:
            half = r["size"] // 2
            indexes[r["size"]] = MultiIndex((np.zeros((1, half)), np.zeros((1, r["size"] - half))), 0.0)
    return indexes


def near_vectors(
    vectors: DataFrame,
    options: IndexOptions | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Links and components of vectors of one label with a cosine of ``min_cosine`` or more.

    Unit vectors are cut into halves, each with a codebook; the product of the codebooks is a grid of
    cells, and every row is indexed in the cell of its nearest codewords. From each vector the
    multi-sequence traversal visits cells by their distance until ``target_recall`` is met (see
    :func:`fit_index`); of two cells the one with the smaller number visits the other, so a pair is
    seen once. Candidates are verified by the cosine of the given vectors in double precision, so no link is
    below the threshold.

    Equal vectors of a label are one row with a number of copies until the end. Members of a cell and
    its visitors are compared in pieces of about a thousand each, so a cell that holds a third of all
    rows is many tasks; a piece returns counts per vector and spanning edges, never pairs.

    Result: one row per input row: id, ``n_links`` (other rows linked directly), ``component_id`` (the smallest
    id reachable), ``kept`` (id = component_id). Null labels, null or empty vectors, zero ones and those with
    null or non-finite components link with nothing. Vectors of another dimension are another label: each dimension
    has codebooks and cells of its own; of one component only the sign counts. Repeated rows are linked copies. An
    empty table gives an empty table.
    """
    options = options or IndexOptions()
    spark = vectors.sparkSession
    value = F.col(vector_column)
    broken = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists(value, lambda x: x != 0)
    fine = F.col(label_column).isNotNull() & value.isNotNull() & (F.size(value) > 0) & ~broken & nonzero
    # one component: all that a cosine sees is its sign
    given = value.cast("array<double>")
    seen = F.when(F.size(value) == 1, F.transform(given, F.signum)).otherwise(given)
    rows = materialise(
        vectors.select(
            F.col(id_column).alias("_id"),
            F.concat_ws("/", F.size(value), F.col(label_column).cast("string")).alias("_label"),
            F.when(F.coalesce(fine, F.lit(False)), seen).alias("_vector"),
        ).withColumn("node", F.when(F.col("_vector").isNotNull(), F.xxhash64("_label", "_vector"))),
        "vectors",
    )
    distinct = materialise(
        rows.where("node IS NOT NULL")
        .groupBy("node", "_label")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("_vector").alias("_vector")),
        "distinct-vectors",
    )
    shared = spark.sparkContext.broadcast(_fit_all(distinct, options))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = [np.array(x, np.float64) for x in part.column(3).to_pylist()]
                sizes = np.array([len(x) for x in lists])
                own, others = np.zeros(len(lists), np.int64), [[]] * len(lists)
                for dimension in np.unique(sizes).tolist():
                    where = np.flatnonzero(sizes == dimension)
                    units = _unit(_scaled(np.stack([lists[i] for i in where])))
                    index = shared.value[dimension]
                    own[where] = index.cells(units)
                    for i, cells in zip(where.tolist(), index.visits(units), strict=True):
                        others[i] = [c for c in cells if c > own[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), part.column(2),
                        pa.array([x.tobytes() for x in lists], pa.binary()),
                        pa.array(own, pa.int64()), pa.array(others, pa.list_(pa.int64())),
                    ],
                    ["node", "_label", "copies", "vector", "cell", "others"],
                )

    placed = materialise(
        distinct.mapInArrow(
            place, "node long, _label string, copies long, vector binary, cell long, others array<long>"
        ),
        "placed",
    )
    members = placed.groupBy("_label", "cell").agg(F.ceil(F.count(F.lit(1)) / _MEMBERS).alias("_parts"))
    goes = placed.select("_label", F.explode("others").alias("cell")).groupBy("_label", "cell").agg(
        F.ceil(F.count(F.lit(1)) / _MEMBERS).alias("_groups")
    )
    grid, n_cells = materialise_counting(
        members.join(goes, ["_label", "cell"], "left").fillna(0, ["_groups"]), "grid"
    )

    def part(n: str):
        return F.pmod(F.xxhash64("node", F.lit(3)), F.col(n))

    held = placed.join(grid, ["_label", "cell"]).withColumn("_part", part("_parts"))
    columns = ["node", "copies", "vector"]

    def rows_of(df: DataFrame, kind: int, side, low, high) -> DataFrame:
        return df.select(F.xxhash64("_label", "cell", F.lit(kind), low, high).alias("task"), side.alias("side"), *columns)

    # members with members: each pair of parts p <= q once
    q = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other")
    inner = held.select("_label", "cell", "_part", q, *columns)
    low, high = F.least("_part", "_other"), F.greatest("_part", "_other")
    inner = rows_of(inner, 0, (F.col("_part") > F.col("_other")).cast("int"), low, high)
    # members with visitors
    seats = held.where("_groups > 0").select(
        "_label", "cell", "_part", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group"), *columns
    )
    seats = rows_of(seats, 1, F.lit(0), F.col("_part"), F.col("_group"))
    visits = placed.select("_label", F.explode("others").alias("cell"), *columns).join(grid, ["_label", "cell"])
    visits = visits.select(
        "_label", "cell", part("_groups").alias("_group"),
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), *columns,
    )
    visits = rows_of(visits, 1, F.lit(1), F.col("_part"), F.col("_group"))
    packs = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_cells // 16)
    found = materialise(
        inner.unionByName(seats).unionByName(visits)
        .groupBy(F.pmod(F.xxhash64("task"), F.lit(packs)).alias("pack"))
        .applyInArrow(_verify(options.min_cosine), "a long, b long, n long"),
        "vector-links",
    )
    degree = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("_links")).withColumnRenamed("a", "node")
    roots = components(found.where("b IS NOT NULL").select("a", "b"), "vector-components")
    classes = (
        distinct.select("node", "copies")
        .join(degree, "node", "left")
        .join(roots, "node", "left")
        .select("node", "copies", F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("root", "node").alias("_root"))
    )
    named = rows.select("_id", "node").join(classes, "node", "left")
    smallest = named.where("_root IS NOT NULL").groupBy("_root").agg(F.min("_id").alias("_least"))
    component = F.coalesce("_least", "_id")
    return named.join(smallest, "_root", "left").select(
        F.col("_id").alias(id_column),
        F.coalesce(F.col("copies") - 1 + F.col("_links"), F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
    )
