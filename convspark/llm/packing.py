"""Packing of documents into windows of tokens, in order, with cuts chosen by dynamic programming."""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import ends_of, gather, slices
from convspark.llm.bpe import byte_letters

#: Blanks of ASCII: no token of the vocabulary files reaches over one.
_CHUNK = re.compile(r"[^ \t-\r]+")
#: Characters that every version of the Unicode tables treats alike: ASCII, letters of Latin-1, usual punctuation.
_PLAIN = re.compile("[\x00-\x7F\xA1\xAB\xBB\xBF-\xD6\xD8-\xF6\xF8-\xFF\u2013\u2014\u2018-\u201E\u2026]*")
#: Words of a plain text in lower case; punctuation keeps the blank behind it, which the library drops. Fixed value.
_PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^ \t-\ra-z0-9\xDF-\xF6\xF8-\xFF]+[ \t-\r]?"
)
#: Pieces that end a sentence: enders with a blank behind them, or a whole chunk that ends so.
_ENDS_SENTENCE = re.compile(r"""[.!?…][!?."'”’)\]]*[ \t-\r]\Z|[^ \t-\r].*[.!?…。！？]["'”’)\]]*\Z""", re.DOTALL)
#: Characters of pieces whose ids a worker remembers.
_REMEMBERED = 6_000_000


@dataclass(frozen=True)
class Costs:
    """What a cut costs, in tokens of padding; a cut between two documents is free."""

    sentence: int = 16
    inside: int = 64
    #: A sentence longer than this may be cut inside, every ``step`` tokens.
    longest: int = 512
    step: int = 64

    def __post_init__(self) -> None:
        if min(self.sentence, self.inside) < 0 or min(self.longest, self.step) < 1:
            raise ValueError("costs must not be negative, lengths positive")


_BLANKS = " \t\n\r\x0b\x0c"


def _is_plain(text: str) -> bool:
    """Only plain characters, and no beginning of a special token."""
    return _PLAIN.fullmatch(text) is not None and "<|" not in text


class _Places(dict):
    """Place of each piece seen; unseen ones get the next place and wait in ``fresh``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.fresh.append(piece)
        return place


class ChunkEncoder:
    """Ids of texts by the tokenizers library, which sees a distinct piece once, until a bounded memory of them is full.

    Only for vocabularies that drop white space and never join two chunks between blanks. Plain texts in
    lower case are cut into the words that the vocabulary's own pattern finds; of other texts, and of those
    that may hold a special token, each chunk with a character that is not plain goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.places, self.size = _Places(), 0
        self.flat, self.offsets = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.closing = np.empty(0, bool)

    def _ids(self, piece: str) -> list[int]:
        """A word of a plain text needs the merges only, on the letters that stand for its bytes; others the whole library."""
        if not _is_plain(piece):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        word = piece.rstrip(_BLANKS)
        if not (word.isascii() and word.isprintable()):
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return [token.id for token in self.tokenizer.model.tokenize(word)]

    def _learn(self) -> None:
        fresh, self.places.fresh = self.places.fresh, []
        found = list(map(self._ids, fresh))
        ends = self.offsets[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)
        self.flat = np.concatenate([self.flat, np.array([i for x in found for i in x], np.int32)])
        self.offsets = np.concatenate([self.offsets, ends])
        closing = np.array([(p[-1] in _BLANKS or not _is_plain(p)) and _ENDS_SENTENCE.search(p) is not None for p in fresh], bool)
        self.closing = np.concatenate([self.closing, closing])
        self.size += sum(map(len, fresh))

    @staticmethod
    def pieces(text: str) -> list[str]:
        if _is_plain(text):
            return _PIECE.findall(text.lower())
        found = []
        for chunk in _CHUNK.findall(text):
            if _is_plain(chunk):
                found += _PIECE.findall(chunk.lower() + " ")
            else:
                found.append(chunk)
        return found

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids, and the places (numbers of ids before them) where a sentence ends."""
        if self.size > _REMEMBERED:
            self._forget()
        pieces: list[str] = []
        counts = []
        for text in texts:
            before = len(pieces)
            if text:
                pieces += self.pieces(text)
            counts.append(len(pieces) - before)
        codes = np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))
        if self.places.fresh:
            self._learn()
        ids, ends = gather(self.flat, self.offsets, codes)
        ends = np.concatenate([[0], ends]).astype(np.int64)
        at = ends_of(np.array(counts, np.int64))
        stops = self.closing[codes]
        result = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            first = ends[a]
            result.append((ids[first : ends[b]], ends[a + 1 : b + 1][stops[a:b]] - first))
        return result


@lru_cache(2)
def _encoder(name: str) -> ChunkEncoder:
    return ChunkEncoder(SparkFiles.get(name))


def cut_places(
    doc_ends: np.ndarray, sentence_ends: np.ndarray, costs: Costs, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """All places where a cut may lie, from 0 to the end, increasing, and the cost of a cut there."""
    places = np.union1d(np.concatenate([[0], doc_ends]), sentence_ends).astype(np.int64)
    gaps = np.diff(places)
    longest, step = min(costs.longest, window), min(costs.step, window)
    long = np.flatnonzero(gaps > longest)
    inner = [np.arange(places[k] + step, places[k + 1], step) for k in long.tolist()]
    whole = np.union1d(places, np.concatenate(inner)) if inner else places
    fees = np.full(len(whole), costs.inside, np.int64)
    fees[np.searchsorted(whole, sentence_ends)] = costs.sentence
    fees[np.searchsorted(whole, np.concatenate([[0], doc_ends]))] = 0
    return whole, fees


def _bits(numbers: np.ndarray) -> np.ndarray:
    """Ones of each number in binary."""
    return np.unpackbits(numbers.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1).sum(axis=1).astype(np.int64)


def choose_cuts(places: np.ndarray, fees: np.ndarray, window: int, inside: int, closing: bool) -> tuple[list[int], int]:
    """Cuts of least cost, the first and the last place among them, and that cost.

    Between neighbours lie at most ``window`` tokens. A stretch costs ``window`` less its length, and
    nothing if its length is a power of two. The best way to a place, for a stretch that is padded, comes
    from the least of ``cost + place`` within the window before it: places wait in a queue of increasing
    values, each enters and leaves it once. Stretches of a power of two are looked up. With ``closing``
    the last stretch may also be cut further, into powers of two, for ``inside`` per cut more.
    """
    last = len(places) - 1
    if last == 0:
        return [int(places[0])], 0
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    exact: dict[int, list[int]] = {}
    for power in powers:
        before = np.searchsorted(places, places - power)
        hit = np.flatnonzero((places >= places[0] + power) & (places[np.minimum(before, last)] == places - power))
        for j, i in zip(hit.tolist(), before[hit].tolist(), strict=True):
            exact.setdefault(j, []).append(i)
    at, fee = places.tolist(), fees.tolist()
    cost, value, back = [0] * len(at), [0] * len(at), [0] * len(at)
    value[0] = at[0]
    queue = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        first = here - window
        while at[queue[0]] < first:
            queue.popleft()
        i = queue[0]
        least = value[i] + window - here
        for k in exact.get(j, ()):
            if cost[k] < least:
                i, least = k, cost[k]
        cost[j], back[j] = least + fee[j], i
        value[j] = cost[j] + here
        while queue and value[queue[-1]] > value[j]:
            queue.pop()
        queue.append(j)
    tail: list[int] = []
    if closing:
        low = int(np.searchsorted(places, places[-1] - window))
        lengths = places[-1] - places[low:last]
        split = np.array(cost[low:last]) + inside * (_bits(lengths) - 1) + fee[last]
        k = int(split.argmin())
        if split[k] < cost[last]:
            cost[last], back[last] = int(split[k]), low + k
            start, length = at[low + k], int(lengths[k])
            for power in reversed(powers):
                if length & power:
                    start += power
                    tail.append(start)
            tail.pop()  # the end itself
    cuts = [last]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return sorted([at[k] for k in cuts] + tail), cost[last]


class _Packer:
    """Documents of one task that wait for their cuts."""

    def __init__(self, window: int, costs: Costs, first_sequence: int) -> None:
        self.window, self.costs, self.sequence = window, costs, first_sequence
        self.keys: list = []
        self.ids: list[np.ndarray] = []
        self.stops: list[np.ndarray] = []
        self.skipped = 0  # ids of the first document that lie in earlier sequences
        self.tokens = 0

    def add(self, key, ids: np.ndarray, stops: np.ndarray) -> None:
        self.keys.append(key)
        self.ids.append(ids)
        self.stops.append(stops)
        self.tokens += len(ids)

    def flush(self, end: bool) -> tuple | None:
        """Pieces of all sequences but the last one, which goes on with what follows; of all at the end."""
        if not self.keys:
            return None
        lengths = np.array([len(x) for x in self.ids], np.int64)
        starts = ends_of(lengths)[:-1] - self.skipped
        doc_ends = starts + lengths
        stops = np.concatenate([s + a for s, a in zip(self.stops, starts.tolist(), strict=True)])
        places, fees = cut_places(doc_ends, stops[stops > 0], self.costs, self.window)
        cuts, _ = choose_cuts(places, fees, self.window, self.costs.inside, end)
        if not end:
            cuts.pop()
        if len(cuts) < 2:
            return None
        cuts = np.array(cuts, np.int64)
        stop = int(cuts[-1])
        begins = np.union1d(cuts[:-1], starts[(starts > 0) & (starts < stop)])
        sizes = np.diff(begins, append=stop)
        doc = np.searchsorted(starts, begins, "right") - 1
        sequence = np.searchsorted(cuts, begins, "right") - 1
        raw = np.concatenate(self.ids)[self.skipped : self.skipped + stop].astype("<u4").tobytes()
        ids = [raw[4 * a : 4 * (a + n)] for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
        pieces = (
            [self.keys[k] for k in doc.tolist()],
            begins - starts[doc],
            sizes,
            ids,
            lengths[doc],
            self.sequence + sequence,
            begins - cuts[sequence],
            np.diff(cuts)[sequence],
        )
        self.sequence += len(cuts) - 1
        rest = int(np.searchsorted(doc_ends, stop, "right"))
        self.skipped = 0 if rest == len(lengths) else max(stop - int(starts[rest]), 0)
        self.keys, self.ids, self.stops = self.keys[rest:], self.ids[rest:], self.stops[rest:]
        self.tokens = int(lengths[rest:].sum()) - self.skipped
        return pieces


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 2,
    window: int = 4096,
    costs: Costs = Costs(),
    block_tokens: int = 1 << 18,
    order_by: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Cut documents into pieces that fill windows of ``window`` tokens, in order, with little padding.

    A document is the ids of its whole text and ``end_id``. Documents follow one another in the order of
    the table as it is stored (or of ``order_by``, range partitioned and sorted); a cut between two
    documents is free, one after a sentence or inside one has its cost, and so has padding. Each task
    cuts about ``block_tokens`` at once with least cost (:func:`choose_cuts`), keeps the last window
    open for the tokens that follow, and closes its own end with sequences of a power of two, which need
    no padding. No text is shuffled. Without ``order_by`` the rows of ``docs`` must come in the same order
    whenever a task runs again, as those of a stored table do.

    Result per piece: id, ``start`` (ids of its document before it), ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens`` (of its document, ``end_id`` included), ``sequence_id``
    (unique, increasing in order, with gaps between tasks), ``offset`` (in the sequence, without gaps),
    ``sequence_tokens``. Null and empty texts are documents of ``end_id`` alone; repeated rows are documents
    of their own; a null id stays null; other columns are ignored; an empty table gives no pieces. A text
    longer than a window is cut like any other; its task holds it whole.
    """
    if window < 1 or block_tokens < window:
        raise ValueError("window must be positive, block_tokens at least as large")
    spark = docs.sparkSession
    spark.sparkContext.addFile(vocabulary_path)
    name = os.path.basename(vocabulary_path)
    if order_by:
        order = [F.col(f"`{c}`") for c in order_by]
        docs = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    fields = [T.StructField(id_column, source.schema["id"].dataType)] + [
        T.StructField(c, T.BinaryType() if c == "ids" else T.LongType())
        for c in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens")
    ]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, costs, TaskContext.get().partitionId() << 32)
        kind = None

        def flush(end: bool) -> Iterator[pa.RecordBatch]:
            pieces = packer.flush(end)
            if pieces is not None:
                keys, *rest = pieces
                columns = [pa.array(keys, kind), *[pa.array(c, pa.binary()) if isinstance(c, list) else pa.array(c) for c in rest]]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch.column(0).type
            for a, b in slices(batch.column(1)):
                keys = batch.column(0).slice(a, b - a).to_pylist()
                texts = batch.column(1).slice(a, b - a).to_pylist()
                for key, (ids, stops) in zip(keys, _encoder(name).encode(texts), strict=True):
                    packer.add(key, np.append(ids, np.int32(end_id)), stops)
                    if packer.tokens >= block_tokens:
                        yield from flush(False)
        yield from flush(True)

    return source.mapInArrow(run, T.StructType(fields))
