"""Exact n-gram Jaccard join by partitioning the universe of shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp, floor, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import ends_of, map_rows, set_aside, slices, struct_of
from convspark.llm.components import components, forest
from convspark.llm.shingles import digest, mix, shingle_sets
from convspark.workspace import broadcast_if_small, materialise, materialise_counting

#: Sizes of a band: the largest is this many times the smallest.
_BAND = 1.25
#: Entries that a task holds before it hands them on, and entries of one block of the index.
_FLUSH, _BLOCK = 1_000_000, 2_000_000
#: Sets that meet in a signature up to which all their pairs are listed; more are joined by star edges.
_PAIRED = 16
#: Pairs that have stood the test of sketches, of which a task hands on a spanning forest.
_SPANNED = 1_000_000
#: Bits of the least and of the largest sketch of a set.
_SKETCHES = 64, 1 << 15
#: Members and shingles of one side of a comparison, and of one of shingles cut to 32 bits.
_MEMBERS, _SHINGLES = 1024, 1_000_000
_SHORT_MEMBERS, _SHORT_SHINGLES = 2048, 4_000_000
#: Elements of both sides that a comparison sorts at once, and rows of its result that are decided at once.
_RANGE, _ROWS = 500_000, 256
#: The cost of a candidate in index entries.
_VERIFY = 20.0
#: Documents of the sample that tells how much unrelated sets share, their bytes at most, and the share without a sample.
_SAMPLE, _SAMPLE_BYTES, _COMMON = 200, 100_000, 0.0005


@dataclass(frozen=True)
class Scheme:
    """How sets of one size band are cut: ``exact`` segments (credit 1), then ``deleted`` ones (credit 2)."""

    low: int
    high: int
    exact: int
    deleted: int
    slack: int

    @property
    def segments(self) -> int:
        return self.exact + self.deleted


def largest_difference(total, percent: int):
    """Most elements in only one of two linked sets whose sizes add up to ``total`` or less (a number or an array).

    A difference is as odd or even as the sum of sizes, so the sum one less may allow more.
    """

    def exactly(total):
        return total - 2 * -(-percent * total // (100 + percent))

    return np.maximum(exactly(total), exactly(total - 1))


def _cut(bound: int, share: float, smallest: int) -> tuple[int, int, int]:
    """Exact and deleted segments, and slack, for a largest difference of ``bound - 1``: exact + 2 deleted = bound + slack.

    Slack makes up for as many empty segments as a set usually has; where more segments for that only mean more
    empty ones, as for the smallest sets, there is none, and empty segments are indexed like others.
    """
    slack = 0
    for _ in range(64):
        deleted = int(share * (bound + slack)) // 2
        exact = bound + slack - 2 * deleted
        empty = exact * exp(-smallest / (exact + deleted))
        wanted = ceil(empty + 3 * sqrt(empty)) if empty > 0.01 else 0
        if wanted <= slack:
            return exact, deleted, slack
        slack = wanted
    deleted = int(share * bound) // 2
    return bound - 2 * deleted, deleted, 0


def _scheme(low: int, high: int, percent: int, sets: float, common: float) -> Scheme:
    """The cheapest split of a band's credit into exact segments and segments with one deletion.

    By the pigeonhole principle two linked sets agree, up to one element in ``deleted`` segments, in
    segments with more credit together than ``slack`` when all credit is ``H + 1 + slack``, H the
    largest difference. Agreeing empty segments say nothing; ``slack`` makes up for as many as a set
    usually has. Cost: entries of the index, plus expected accidental candidates among ``sets`` sets that share
    ``common`` of their elements.
    """
    bound = int(largest_difference(2 * high, percent)) + 1
    smallest = max(1, ceil(percent * low / 100))
    mean = sqrt(low * high)
    best = None
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        exact, deleted, slack = _cut(bound, share, smallest)
        held = mean / (exact + deleted)
        entries = exact + deleted * (1 + held)
        apart = 2 * held * (1 - common)
        chance = exp(-apart) * (exact * (1 - exp(-held * common)) + deleted * (1 + apart))
        if not slack:
            chance += exact * exp(-2 * smallest / (exact + deleted))  # both empty
        cost = entries + _VERIFY * chance * sets / 2
        if best is None or cost < best[0]:
            best = (cost, Scheme(low, high, exact, deleted, slack))
    return best[1]


def shared_by_unrelated(sets: list[np.ndarray]) -> float:
    """Mean share of the smaller set that two sets have in common, over pairs that have less than half of it."""
    sets = [s for s in sets if len(s)]
    if len(sets) < 2:
        return _COMMON
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    counts = np.diff(np.append(start, len(value)))
    shared = np.zeros((len(sets), len(sets)))
    for a, n in zip(start[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True):
        mine = owner[a : a + n]
        shared[mine[:, None], mine] += 1
    sizes = np.array([len(s) for s in sets])
    share = (shared / np.minimum(sizes[:, None], sizes))[np.triu_indices(len(sets), 1)]
    unrelated = share[share < 0.5]
    return float(unrelated.mean()) if len(unrelated) else _COMMON


class Bands:
    """Schemes for all sizes up to a largest one."""

    def __init__(
        self, largest: int, percent: int, sets_by_band: dict[int, float] | None = None, common: float = _COMMON
    ) -> None:
        self.percent = percent
        self.schemes: list[Scheme] = []
        low = 1
        while low <= largest or not self.schemes:
            high = max(low, floor(low * _BAND))
            self.schemes.append(_scheme(low, high, percent, (sets_by_band or {}).get(len(self.schemes), 0.0), common))
            low = high + 1
        self.lows = np.array([s.low for s in self.schemes])

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1

    def reaches(self, size: int, band: int) -> bool:
        """Whether a set of this size can be linked with a larger one of the band."""
        return band < len(self.schemes) and 100 * size >= self.percent * int(self.lows[band])


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of some sets: signatures, and the place of the set that each belongs to.

    A set is cut by the scheme of its own band, and of the bands above in which it can have partners;
    in each it uses only the segments that its own largest difference calls for. An entry names a
    segment and the subset in it; its lowest bit is 1 if one element has been deleted.
    """
    out_keys, out_sets = [], []
    sizes = np.array([len(s) for s in sets], np.int64)
    own = bands.band(np.maximum(sizes, 1))
    step = 0
    live = np.flatnonzero(sizes > 0)
    with np.errstate(over="ignore"):
        while len(live):
            live = np.array([i for i in live if step == 0 or bands.reaches(int(sizes[i]), int(own[i]) + step)], np.int64)
            if not len(live):
                break
            schemes = [bands.schemes[b] for b in (own[live] + step)]
            exact = np.array([s.exact for s in schemes])
            segments = np.array([s.segments for s in schemes])
            slack = np.array([s.slack for s in schemes])
            partner = np.minimum([s.high for s in schemes], 100 * sizes[live] // bands.percent)
            credit = largest_difference(sizes[live] + partner, bands.percent) + 1 + slack
            used = np.minimum(np.where(credit <= exact, credit, exact + -(-(credit - exact) // 2)), segments)
            first = np.concatenate([[0], np.cumsum(segments)])
            token = np.concatenate([sets[i] for i in live])
            of = np.repeat(np.arange(len(live)), sizes[live])
            salt = mix((own[live] + step).astype(np.uint64) + np.uint64(0x51ED27))
            spread = mix(token ^ salt[of])
            segment = (spread % segments[of].astype(np.uint64)).astype(np.int64)
            place = first[of] + segment
            part = mix(token + salt[of] * np.uint64(3))
            sums = np.zeros(first[-1], np.uint64)
            np.add.at(sums, place, part)
            counts = np.bincount(place, minlength=first[-1])
            which = np.repeat(np.arange(len(live)), segments)
            number = np.arange(first[-1]) - first[which]
            name = mix(salt[which] + number.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
            inside = number < used[which]
            blank = inside & (counts == 0) & (number < exact[which])
            blanks = np.bincount(which[blank], minlength=len(live))
            emit = inside & ~(blank & (blanks <= slack)[which])
            out_keys.append(mix(sums[emit] + name[emit]) & ~np.uint64(1))
            out_sets.append(live[which[emit]])
            dropped = (segment >= exact[of]) & (segment < used[of])
            if dropped.any():
                at = place[dropped]
                out_keys.append(mix(sums[at] - part[dropped] + name[at]) | np.uint64(1))
                out_sets.append(live[of[dropped]])
            step += 1
    if not out_keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_keys), np.concatenate(out_sets)


def _apart(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones among pairs of two different nodes, the smaller node first."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)] & (a != b)
    return a[new], b[new]


def meetings(keys: np.ndarray, nodes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What meets by signature: star edges, pairs (both with two rows), and the places of the entries to hand on.

    Entries that differ only in the lowest bit have one signature. Up to ``most`` nodes of one signature give all
    their pairs but those that met as deleted ones on both sides: linked sets also meet otherwise. More nodes give edges
    from the first of them, the undeleted ones first; then one more than ``most`` are handed on, so that their signature
    has too many to list wherever it is met again.
    """
    order = np.argsort(keys, kind="stable")
    bucket = keys[order] >> np.uint64(1)
    equal = bucket[1:] == bucket[:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= equal
    shared[:-1] |= equal
    alone, order = order[~shared], order[shared]
    del bucket, equal, shared
    none = np.empty((2, 0), nodes.dtype)
    if not len(order):
        return none, none, alone
    # a node is in a signature once, undeleted if it can be
    order = order[np.lexsort((keys[order], nodes[order], keys[order] >> np.uint64(1)))]
    bucket, node = keys[order] >> np.uint64(1), nodes[order]
    order = order[np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1])])]
    order = order[np.lexsort((nodes[order], keys[order]))]
    key, node = keys[order], nodes[order]
    bucket = key >> np.uint64(1)
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    lengths = np.diff(np.append(start, len(bucket)))
    many = np.repeat(lengths > most, lengths)
    hub = np.repeat(node[start], lengths)
    left = np.repeat(start + lengths, lengths) - np.arange(len(bucket)) - 1  # entries behind this one
    pairs = []
    for step in range(1, min(most, int(lengths.max()))):
        one = np.flatnonzero(~many & (left >= step) & ((key & np.uint64(1)) == 0))
        pairs.append(np.stack([node[one], node[one + step]]))
    listed = np.concatenate([none, *pairs], axis=1)
    handed = ~many | (np.arange(len(bucket)) - np.repeat(start, lengths) <= most)
    return spanning(hub[many], node[many]), np.stack(_apart(*listed)), np.concatenate([alone, order[handed]])


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges, fewer than nodes, that connect what the given ones do: from each node to the smallest it is connected with."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    led = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[root[led]], nodes[led]])


def sketches(sets: list[np.ndarray]) -> list[bytes]:
    """For each set the parities of how many elements end in the same bits: as many of them as it has elements, or more.

    Sketches are as long as a power of two; the two halves of one, taken together, are the sketch of half the length.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    wide = np.clip(2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), *_SKETCHES)
    ends = ends_of(wide)
    token = np.concatenate([*sets, np.empty(0, np.uint64)])
    place = np.repeat(ends[:-1], sizes) + (token & np.repeat((wide - 1).astype(np.uint64), sizes)).astype(np.int64)
    packed = np.packbits((np.bincount(place, minlength=ends[-1]) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def least_difference(left: pa.Array, right: pa.Array) -> np.ndarray:
    """For pairs of sketches, how many elements at least are in only one of the two sets."""
    found = np.zeros(len(left), np.int64)
    lengths = [pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (left, right)]
    name = lengths[0] * (_SKETCHES[1] + 1) + lengths[1]
    for kind in np.unique(name):
        at = np.flatnonzero(name == kind)
        sides = [np.frombuffer(b"".join(x.take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -1) for x in (left, right)]
        words = min(x.shape[1] for x in sides)
        one, two = (np.bitwise_xor.reduce(x.reshape(len(at), -1, words), axis=1) for x in sides)
        found[at] = np.bitwise_count(one ^ two).sum(axis=1)
    return found


_MET = "kind byte, _id long, own long, n long, node long, other long, sketch binary"
_INDEX = f"{_MET}, block int, keys binary, nodes binary, places binary"


def _index(bands: Bands, width: int, blocks: int):
    """Documents to three kinds of rows: 0 document, size, set and sketch; 1 candidate edge; 2 entries of a block."""

    def columns(kind: int, rows: int, **given) -> pa.RecordBatch:
        kinds = {"_id": pa.int64(), "own": pa.int64(), "n": pa.int64(), "node": pa.int64(), "other": pa.int64(), "sketch": pa.binary(), "block": pa.int32(), "keys": pa.binary(), "nodes": pa.binary(), "places": pa.binary()}
        arrays = [pa.array(np.full(rows, kind, np.int8))]
        arrays += [pa.array(given[c], t) if c in given else pa.nulls(rows, t) for c, t in kinds.items()]
        return pa.RecordBatch.from_arrays(arrays, ["kind", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_keys: list[np.ndarray] = []
        kept_nodes: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, nodes = np.concatenate(kept_keys), np.concatenate(kept_nodes)
            kept_keys.clear()
            kept_nodes.clear()
            # what meets often inside the task is joined here: few entries per signature leave it
            (a, b), _, rest = meetings(keys, nodes, _PAIRED)
            if len(a):
                yield columns(1, len(a), node=a, other=b, block=_aside(len(a), blocks))
            keys, nodes = keys[rest], nodes[rest]
            block = ((keys >> np.uint64(1)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            keys, nodes, block = _short(keys[order]), nodes[order], block[order]
            start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            ends = np.append(start[1:], len(block))
            for a in range(0, len(start), 64):
                cut = list(zip(start[a : a + 64].tolist(), ends[a : a + 64].tolist(), strict=True))
                named = [_named(nodes[x:y]) for x, y in cut]
                yield columns(
                    2, len(cut), block=block[start[a : a + 64]].astype(np.int32),
                    keys=[keys[x:y].tobytes() for x, y in cut], nodes=[n for n, _ in named], places=[p for _, p in named],
                )

        for batch in batches:
            ids, texts, own = batch.column(0), batch.column(1), batch.column(2)
            for a, b in slices(texts):
                sets = shingle_sets(texts.slice(a, b - a).to_pylist(), width)
                nodes = np.array([digest(s) if len(s) else 0 for s in sets], np.int64)
                yield columns(
                    0, b - a, _id=ids.slice(a, b - a), own=own.slice(a, b - a), n=np.array([len(s) for s in sets], np.int64),
                    node=pa.array(nodes, mask=np.array([not len(s) for s in sets])), sketch=sketches(sets), block=_aside(b - a, blocks),
                )
                # equal sets of a slice are indexed once
                first = np.sort(np.unique(nodes, return_index=True)[1])
                keys, of = signatures([sets[i] for i in first], bands)
                if len(keys):
                    kept_keys.append(keys)
                    kept_nodes.append(nodes[first][of])
                    held += len(keys)
                if held >= _FLUSH:
                    held = 0
                    yield from flush()
        if kept_keys:
            yield from flush()

    return run


def _short(keys: np.ndarray) -> np.ndarray:
    """32 bits of signatures that are in one block; what meets by those alone is a candidate more."""
    return ((keys >> np.uint64(32)) & ~np.uint64(1) | keys & np.uint64(1)).astype(np.uint32)


def _named(nodes: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct nodes, and for each entry the place of its node among them in as few bytes as will do."""
    distinct, places = np.unique(nodes, return_inverse=True)
    return distinct.tobytes(), places.astype(np.uint16 if len(distinct) <= 1 << 16 else np.uint32).tobytes()


def _nodes(distinct: bytes, places: bytes, entries: int) -> np.ndarray:
    return np.frombuffer(distinct, np.int64)[np.frombuffer(places, np.uint16 if len(places) == 2 * entries else np.uint32)]


def _aside(rows: int, blocks: int) -> np.ndarray:
    """Negative blocks for rows that only pass through, spread evenly."""
    return -1 - (np.arange(rows) % blocks).astype(np.int32)


def _join_block(table: pa.Table) -> pa.Table:
    """Star edges (kind 1) and pairs (3) of a block of entries; rows of documents and edges as they are."""
    narrow = ["kind", "_id", "own", "n", "node", "other", "sketch"]
    if table.column("block")[0].as_py() < 0:
        return table.select(narrow)
    keys = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]).astype(np.uint64)
    packed = zip(*(table.column(c).to_pylist() for c in ("nodes", "places", "keys")), strict=True)
    nodes = np.concatenate([_nodes(n, p, len(k) // 4) for n, p, k in packed])
    edges, pairs, _ = meetings(keys, nodes, _PAIRED)
    kinds = np.repeat(np.array([1, 3], np.int8), [edges.shape[1], pairs.shape[1]])
    a, b = np.concatenate([edges, pairs], axis=1)
    none = pa.nulls(len(a), pa.int64())
    return pa.table([pa.array(kinds), none, none, none, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.binary())], narrow)


def _near(index: DataFrame, percent: int) -> DataFrame:
    """Edges that span, task by task, the pairs whose sketches differ in no more than linked sets may: (``a``, ``b``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty((2, 0), np.int64)]

        def flush() -> pa.RecordBatch:
            a, b = spanning(*np.concatenate(held, axis=1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            a, b, n, m = (batch.column(k).to_numpy() for k in (0, 1, 2, 4))
            fine = least_difference(batch.column(3), batch.column(5)) <= largest_difference(n + m, percent)
            fine &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            held.append(np.stack([a[fine], b[fine]]))
            if sum(x.shape[1] for x in held) >= _SPANNED:
                yield flush()
                held = held[:1]
        yield flush()

    pairs = index.where("kind = 3").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    one = materialise(index.where("kind = 0 AND node IS NOT NULL").select("node", "n", "sketch").dropDuplicates(["node"]), "jaccard-sketches")
    two = one.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    both = pairs.join(one.withColumnRenamed("node", "a"), "a").join(two, "b").select("a", "b", "n", "sketch", "m", "other")
    return both.mapInArrow(run, "a long, b long")


def _ranges(sets: list[np.ndarray], edges: np.ndarray) -> np.ndarray:
    """For each ascending set where each range of values begins, and where the last one ends."""
    cuts = np.zeros((len(sets), len(edges) + 2), np.int64)
    for i, s in enumerate(sets):
        cuts[i, 1:-1] = np.searchsorted(s, edges)
        cuts[i, -1] = len(s)
    return cuts


def shared_elements(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of one list shares with each of the other; sets are ascending.

    Values are taken range by range, so that besides the sets and the result only a range is held.
    """
    shared = np.zeros((len(left), len(right)), np.int32)
    held = sum(map(len, left)) + sum(map(len, right))
    if not held:
        return shared
    kind = np.result_type(*{s.dtype for s in left + right})
    n = ceil(held / _RANGE)
    edges = np.array([np.iinfo(kind).max // n * k for k in range(1, n)], kind)
    cuts = [_ranges(left, edges)]
    cuts.append(cuts[0] if right is left else _ranges(right, edges))

    def sorted_range(sets: list[np.ndarray], cut: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        value = np.concatenate([s[x:y] for s, x, y in zip(sets, cut[:, k].tolist(), cut[:, k + 1].tolist(), strict=True)])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), cut[:, k + 1] - cut[:, k])
        order = np.argsort(value, kind="stable")
        return value[order], owner[order]

    for k in range(n):
        one = sorted_range(left, cuts[0], k)
        two = one if right is left else sorted_range(right, cuts[1], k)
        common = np.intersect1d(one[0], two[0])
        span = [(np.searchsorted(v, common, "left"), np.searchsorted(v, common, "right")) for v, _ in (one, two)]
        wide = [hi - lo for lo, hi in span]
        alone = (wide[0] == 1) & (wide[1] == 1)
        np.add.at(shared, (one[1][span[0][0][alone]], two[1][span[1][0][alone]]), 1)
        for j in np.flatnonzero(~alone):
            rows = one[1][span[0][0][j] : span[0][1][j]]
            shared[rows[:, None], two[1][span[1][0][j] : span[1][1][j]]] += 1
    return shared


def linked(
    left: list[np.ndarray], right: list[np.ndarray], percent: int, given: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Which sets of two lists are linked: 100 * shared >= percent * united, by counting shared elements.

    ``given`` are the sizes of the sets that these stand for, where elements that fell together are listed once. At most
    so many as either side has lost are shared besides; then all links are among those found, and seldom others.
    """
    sizes = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
    whole = sizes if given is None else given
    if min(len(left), len(right)) <= 4:
        shared = np.zeros((len(left), len(right)), np.int32)
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                if 100 * min(whole[0][i], whole[1][j]) >= percent * max(whole[0][i], whole[1][j]):
                    shared[i, j] = len(np.intersect1d(a, b, assume_unique=True))
    else:
        shared = shared_elements(left, right)
    links = np.empty(shared.shape, bool)
    lost = [w - n for w, n in zip(whole, sizes, strict=True)]
    for a in range(0, len(left), _ROWS):
        some = shared[a : a + _ROWS].astype(np.int64)
        if given is not None:
            some += np.minimum(lost[0][a : a + _ROWS, None], lost[1])
        links[a : a + _ROWS] = 100 * some >= percent * (whole[0][a : a + _ROWS, None] + whole[1] - some)
    return links


def _views(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists of signed numbers as arrays of unsigned ones, not copied."""
    raw, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    values = raw.view(np.uint32 if raw.dtype == np.int32 else np.uint64)
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _compare(percent: int):
    """Spanning edges of the links inside each group (side 0 only), or between its two sides."""

    def run(table: pa.Table) -> pa.Table:
        group, side = (table.column(c).to_numpy() for c in ("group", "side"))
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        sets = [s for lists in table.column("shingles").chunks for s in _views(lists)]
        out = [np.empty((2, 0), np.int64)]
        for name in np.unique(group):
            sides = [np.flatnonzero((group == name) & (side == k)) for k in (0, 1)]
            within = not len(sides[1])
            left = [sets[i] for i in sides[0]]
            right = left if within else [sets[i] for i in sides[1]]
            links = linked(left, right, percent, (n[sides[0]], n[sides[0] if within else sides[1]]))
            if within:
                np.fill_diagonal(links, False)
            a, b = forest(links)
            out.append(np.stack([nodes[sides[0]][a], nodes[sides[0] if within else sides[1]][b]]))
        edges = np.concatenate(out, axis=1)
        return pa.table({"a": pa.array(edges[0]), "b": pa.array(edges[1])})

    return run


def _links(clusters: DataFrame, percent: int, packs: int, members: int, shingles: int) -> DataFrame:
    """Verified links inside candidate clusters: rows of (cluster, node, n, band, shingles) to edges that span them."""
    weight = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_members"), F.sum("n").alias("_weight"))
    large = weight.where((F.col("_members") > members) | (F.col("_weight") > shingles))
    large, n_large = materialise_counting(large.select("cluster", F.lit(True).alias("_large")), "jaccard-large")
    sized = clusters.join(broadcast_if_small(large, n_large), "cluster", "left")
    pack = F.pmod(F.xxhash64("cluster"), F.lit(packs))
    whole = sized.where("_large IS NULL").select(
        pack.alias("task"), F.lit(-1).alias("pair"), F.col("cluster").alias("group"), F.lit(0).alias("side"), "node", "n", "shingles"
    )
    # larger ones: pieces by band and hash; only pieces of partner bands are compared
    pieces, n_pieces = materialise_counting(
        sized.where("_large")
        .groupBy("cluster", "band")
        .agg(F.count(F.lit(1)).alias("_count"), F.sum("n").alias("_load"))
        .withColumn("_parts", F.greatest(F.ceil(F.col("_count") / members), F.ceil(F.col("_load") / shingles))),
        "jaccard-pieces",
    )
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("_parts"))
    cut = sized.where("_large").join(broadcast_if_small(pieces, n_pieces), ["cluster", "band"]).withColumn("part", part)
    listed = pieces.select("cluster", "band", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"))
    other = listed.select("cluster", F.col("band").alias("band2"), F.col("part").alias("part2"))
    same = (F.col("band") == F.col("band2")) & (F.col("part") <= F.col("part2"))
    pairs = listed.join(other, "cluster").where(same | (F.col("band2") == F.col("band") + 1))
    pairs = pairs.withColumn("task", F.xxhash64("cluster", "band", "part", "band2", "part2"))
    pairs, n_pairs = materialise_counting(pairs, "jaccard-pairs")
    here = cut.join(broadcast_if_small(pairs, n_pairs), ["cluster", "band", "part"]).select("task", F.lit(0).alias("side"), "node", "n", "shingles")
    apart = pairs.where(~((F.col("band") == F.col("band2")) & (F.col("part") == F.col("part2"))))
    apart = apart.select("cluster", F.col("band2").alias("band"), F.col("part2").alias("part"), "task")
    there = cut.join(broadcast_if_small(apart, n_pairs), ["cluster", "band", "part"]).select("task", F.lit(1).alias("side"), "node", "n", "shingles")
    split = here.unionByName(there).select(
        "task", F.lit(0).alias("pair"), F.col("task").alias("group"), "side", "node", "n", "shingles"
    )
    return whole.unionByName(split).groupBy("pair", "task").applyInArrow(_compare(percent), "a long, b long")


def _common_share(source: DataFrame, n: int, width: int) -> float:
    """:func:`shared_by_unrelated` for a sample by hash of the text, of bounded size. It sets costs only, never results."""
    chosen = F.pmod(F.xxhash64("_text", F.lit(11)), F.lit(max(1, n // _SAMPLE))) == 0
    short = F.octet_length("_text").between(1, _SAMPLE_BYTES)
    texts = [r["_text"] for r in source.where(short & chosen).select("_text").limit(2 * _SAMPLE).toLocalIterator()]
    return shared_by_unrelated(shingle_sets(texts, width))


def jaccard_components(
    docs: DataFrame, width: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Exact, by partitioning the universe. Sets are grouped by size band; a band's scheme hashes the
    shingles of a set into segments, as many as two linked sets can differ in elements and one more,
    so that linked sets agree in a segment. Segments are indexed by their subset, some with every
    subset of one element less, as the cost model of the band decides (see ``_scheme``). A set is
    indexed in its band and in those above where partners can be.

    Equal sets are one node. Blocks of packed entries meet by signature. The pairs of a signature that few sets have are
    listed, and those stay whose sketches, parities of as many groups of elements as a set has elements, differ in
    no more places than linked sets may in elements. So sets that have met by accident do not grow into one large cluster.
    A signature of many sets gives star edges, also inside a task, from which few entries of it go on. The
    components of both are candidate clusters, supersets of the true ones. Each cluster's sets are then compared, within bounded pieces of
    members (pieces whose sizes cannot be linked are not compared), first by 32 bits of each shingle, counting
    in favour of a link what these cannot tell; the clusters that this leaves are compared by all 64. Only
    spanning edges leave a task; their components are the result.

    Result: one row per document: id, ``n_shingles``, ``component_id`` (the smallest id reachable),
    ``text_hash`` (xxhash64 of the text) and ``representative`` (the row of the smallest id and text hash). A null
    text or one without words has an empty set and is linked with nothing; a text of fewer words than
    ``width`` has one shingle. Repeated rows are in one component; a null id is larger than any other
    and is the component id only among null ids. ``percent`` must be 80 to 100. An empty table gives
    an empty table. Sets are named by 64 bits of a digest, shingles by 64 bits of a hash.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    spark = docs.sparkSession
    text = F.col(text_column).cast("string")
    source = docs.select(F.col(id_column).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_own"))
    # sizes of the table by length of text, and a sample, decide bands, costs and blocks; results never depend on them
    size = F.greatest(F.octet_length("_text") / 6.0, F.lit(1.0))
    census = (
        source.where("octet_length(_text) > 0")
        .groupBy(F.floor(F.log(_BAND, size)).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("_text")).alias("longest"))
        .collect()
    )
    largest = max([r["longest"] for r in census], default=1)
    plain = Bands(largest, percent)
    populations: dict[int, float] = {}
    for r in census:
        band = int(plain.band(np.array([max(1, int(_BAND ** (r["step"] + 0.5)))]))[0])
        populations[band] = populations.get(band, 0.0) + r["n"]
    bands = Bands(largest, percent, populations, _common_share(source, sum(r["n"] for r in census), width))
    entries = sum(n * 1.6 * bands.schemes[b].segments for b, n in populations.items())
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(entries / _BLOCK))

    # the entries exist in the shuffle only
    index = materialise(
        source.mapInArrow(_index(bands, width, blocks), _INDEX)
        .groupBy("block")
        .applyInArrow(_join_block, _MET),
        "jaccard-index",
    )
    rows = index.where("kind = 0").select("_id", "own", "n", "node")
    met = index.where("kind = 1").select(F.col("node").alias("a"), F.col("other").alias("b"))
    met = materialise(met.distinct().unionByName(_near(index, percent)), "jaccard-met")
    candidates = components(met, "jaccard-candidates")
    # one document stands for each set; texts of candidates are read again
    first = rows.join(candidates, "node").groupBy("node", "root").agg(F.min_by(F.struct("_id", "own"), "own").alias("_first"))
    chosen, n_chosen = materialise_counting(first.select("node", "root", "_first._id", "_first.own"), "jaccard-chosen")
    lows = bands.lows

    def sets(values: pa.Array, short: bool) -> list[pa.Array]:
        found = shingle_sets(values.to_pylist(), width)
        named = [digest(s) for s in found]
        n = [len(s) for s in found]
        if short:
            found = [np.unique(s.astype(np.uint32)) for s in found]
        flat = np.concatenate([*found, np.empty(0, np.uint32 if short else np.uint64)])
        return [
            pa.ListArray.from_arrays(pa.array(ends_of(np.array([len(s) for s in found], np.int64)), pa.int32()), pa.array(flat.view(np.int32 if short else np.int64))),
            pa.array(n, pa.int64()), pa.array(np.searchsorted(lows, n, "right") - 1, pa.int64()),
            pa.array(named, pa.int64()),
        ]

    def verified(chosen: DataFrame, n_chosen: int, label: str, short: bool) -> DataFrame:
        """Components of the links inside clusters, from the texts of (node, root, _id, own), read again."""
        mine = (source["_own"] == chosen["own"]) & source["_id"].eqNullSafe(chosen["_id"])
        texts = source.join(broadcast_if_small(chosen, n_chosen), mine).select("node", F.col("root").alias("cluster"), "_text")
        kind = T.ArrayType(T.IntegerType() if short else T.LongType())
        extra = struct_of(shingles=kind, n=T.LongType(), band=T.LongType(), _named=T.LongType())
        listed = map_rows(texts, "_text", extra, lambda values: sets(values, short), keep_input=False)
        clusters, n_sets = materialise_counting(
            listed.where("node = _named").drop("_named").dropDuplicates(["node"]), f"jaccard-{label}"
        )
        packs = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_sets // 500)
        size = (_SHORT_MEMBERS, _SHORT_SHINGLES) if short else (_MEMBERS, _SHINGLES)
        links = materialise(_links(clusters, percent, packs, *size), f"jaccard-{label}-linked")
        return components(links, f"jaccard-{label}-links")

    # shingles of 32 bits part what has only met by accident; what is left is small, and is compared whole
    likely = verified(chosen, n_chosen, "short", True)
    again, n_again = materialise_counting(chosen.drop("root").join(likely, "node"), "jaccard-likely")
    roots = verified(again, n_again, "sets", False)
    grouped = rows.join(roots, "node", "left").withColumn("_root", F.coalesce("root", "node"))
    # the smallest id, null last; the text decides between rows of one id
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("own").alias("own"))
    # written, so that the rows are joined with it by exchanges of their own, which can be split at a hot component
    smallest, n_smallest = materialise_counting(
        grouped.where("node IS NOT NULL").groupBy("_root").agg(F.min(place).alias("_least")), "jaccard-smallest"
    )
    alone = F.col("node").isNull()
    return grouped.join(broadcast_if_small(smallest, n_smallest), "_root", "left").select(
        F.col("_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("_id")).otherwise(F.col("_least.id")).alias("component_id"),
        F.col("own").alias("text_hash"),
        (alone | (place == F.col("_least"))).alias("representative"),
    )


def drop_near_copies(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One document of each component (see :func:`jaccard_components`) stays: the one with the smallest id.

    All columns are kept. Texts are not shuffled as long as the counted table of the others is small.
    Empty texts, and texts without words, all stay.
    """
    rows, back = set_aside(docs, id_column, text_column)
    found = materialise(jaccard_components(rows, width, percent, "id", "text"), "jaccard-result")
    found = found.select(F.col("id").alias("_id"), F.col("text_hash").alias("_own"), "representative", "n_shingles")
    others, n = materialise_counting(found.where("NOT representative").distinct(), "near-copies")
    text = F.xxhash64(F.col("text").cast("string"))
    mine = F.col("id").cast("long").eqNullSafe(F.col("_id")) & (text == F.col("_own"))
    kept = rows.join(broadcast_if_small(others, n), mine, "left_anti")
    # rows that agree in id and text are equal copies too
    again = found.where("representative AND n_shingles > 0").groupBy("_id", "_own").count().where("count > 1")
    again, n = materialise_counting(again.select("_id", "_own"), "repeated-rows")
    if not n:
        return back(kept)
    repeated = kept.join(broadcast_if_small(again, n), mine, "left_semi")
    once = repeated.withColumn("_own_text", text).dropDuplicates(["id", "_own_text"]).drop("_own_text")
    return back(kept.join(broadcast_if_small(again, n), mine, "left_anti").unionByName(once))
