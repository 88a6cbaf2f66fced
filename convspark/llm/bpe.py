"""Byte-level BPE with a transducer lexicon of the corpus's frequent words."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import ends_of, gather, map_rows, slices, struct_of
from convspark.llm.lexicon import compile_words, find_words, open_packed, pack
from convspark.workspace import materialise, new_path

#: Splits a text before the merges. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words over this length are never compiled; they are merged.
LONGEST_WORD = 48
#: Ids of the words that a worker remembers, all together.
_REMEMBERED = 600_000
#: Words of so many bytes are merged one by one, over a heap; shorter ones all together.
_ALONE = 64
#: Stands for the rank of a pair without a merge.
_NEVER = 1 << 30
#: Characters beyond the tables of the quick splitter.
_late = re.compile("[\U00010000-\U0010ffff]").search
_any = regex.compile(PATTERN).findall


@dataclass(frozen=True)
class Vocabulary:
    """Merges as (left, right) ids in order of rank with the id they make, and the bytes of each id."""

    merges: np.ndarray
    token_bytes: list[bytes]
    byte_ids: list[int]
    special: dict[str, int]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file: visible Latin-1 as it is, others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    ids = content["model"]["vocab"]
    letters = byte_letters()
    value = {c: b for b, c in enumerate(letters)}
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    token_bytes = [b""] * (1 + max([*ids.values(), *added.values()]))
    for token, i in ids.items():
        token_bytes[i] = bytes(value[c] for c in token)
    for token, i in added.items():
        token_bytes[i] = token.encode()
    pairs = (m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"])
    merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int32).reshape(-1, 3)
    return Vocabulary(merges, token_bytes, [ids[c] for c in letters], added)


def _ranges(is_inside: Callable[[str], bool]) -> str:
    """Characters up to U+FFFF that a test holds for, as the inside of a character class."""
    inside = np.array([is_inside(chr(c)) for c in range(0x10000)] + [False])
    edges = np.flatnonzero(np.diff(inside, prepend=False)).tolist()
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


@lru_cache(1)
def _quick() -> Callable[[str], list[str]]:
    """``PATTERN`` up to U+FFFF with its classes written out: ``re`` looks these up in a bitmap."""
    letter, number = (_ranges(lambda c, kind=kind: unicodedata.category(c)[0] == kind) for kind in "LN")
    space = _ranges(lambda c: c.isspace() and not "\x1c" <= c <= "\x1f")
    return re.compile(
        rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall


def split_words(text: str) -> list[str]:
    """Words of a text, by ``PATTERN``; characters that this Python's tables do not know count as symbols up to U+FFFF."""
    return _any(text) if not text.isascii() and _late(text) else _quick()(text)


def merge_word(word: bytes, byte_ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Ids of a word: again and again the pair of least rank, the first of equals, becomes one id."""
    ids: list[int | None] = [byte_ids[b] for b in word]
    n = len(ids)
    if n < 64:
        while n > 1:
            best, at = None, 0
            for i in range(n - 1):
                made = ranks.get((ids[i], ids[i + 1]))
                if made is not None and (best is None or made < best):
                    best, at = made, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
            n -= 1
        return ids
    # long words: a heap of pairs over a linked list
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            made = ranks.get((ids[i], ids[j]))
            if made is not None:
                heapq.heappush(heap, (made[0], i, ids[i], ids[j], made[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j] = made, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [x for x in ids if x is not None]


def _pairs(merges: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """Rank and id made, by left and right id."""
    return {(a, b): (k, c) for k, (a, b, c) in enumerate(merges.tolist())}


class Merger:
    """The merges in an order to look up many pairs at once."""

    def __init__(self, merges: np.ndarray, byte_ids: np.ndarray) -> None:
        self.merges, self.byte_ids = np.asarray(merges, np.int64), np.asarray(byte_ids, np.int64)
        self.made = self.merges[:, 2]
        keys = self.merges[:, 0] << 32 | self.merges[:, 1]
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @cached_property
    def pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        return _pairs(self.merges)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge; the last counts of those with the same pair, as in :func:`_pairs`."""
        if not len(self.keys):
            return np.full(len(left), _NEVER)
        keys = left << 32 | right
        at = np.maximum(np.searchsorted(self.keys, keys, "right") - 1, 0)
        return np.where(self.keys[at] == keys, self.order[at], _NEVER)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the offsets of each word: those of :func:`merge_word`.

        Every round makes one merge in each word that has one left; words without leave.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        alone = np.flatnonzero(lengths >= _ALONE)
        byte_ids = self.byte_ids.tolist()
        listed = [merge_word(words[k], byte_ids, self.pairs) for k in alone.tolist()]
        ids_of = [np.array([i for x in listed for i in x], np.int64)]
        word_of = [np.repeat(alone, np.array([len(x) for x in listed], np.int64))]
        short = np.flatnonzero(lengths < _ALONE)
        ids = self.byte_ids[np.frombuffer(b"".join(words[k] for k in short.tolist()), np.uint8)]
        word = np.repeat(short, lengths[short])
        # rank of the pair that begins at a place
        offers = np.full(len(ids), _NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        offers[inner] = self.ranks(ids[inner], ids[inner + 1])
        while len(ids):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(offers << 32 | np.arange(len(ids)), starts)
            rank, at = best >> 32, best & 0xFFFFFFFF
            on = rank < _NEVER
            stays = np.repeat(on, np.diff(starts, append=len(ids)))
            ids_of.append(ids[~stays])
            word_of.append(word[~stays])
            rank, at = rank[on], at[on]
            ids[at] = self.made[rank]
            stays[at + 1] = False
            at = (np.cumsum(stays) - 1)[at]
            ids, word, offers = ids[stays], word[stays], offers[stays]
            # the new ids' pairs: with what follows, and with what lies before
            offers[at] = _NEVER
            left = np.concatenate([at, at - 1])
            left = left[(left >= 0) & (left + 1 < len(ids))]
            left = left[word[left] == word[left + 1]]
            offers[left] = self.ranks(ids[left], ids[left + 1])
        merged, owner = np.concatenate(ids_of), np.concatenate(word_of)
        return merged[np.argsort(owner, kind="stable")].astype(np.int32), ends_of(np.bincount(owner, minlength=len(words)))


class Coder:
    """Encodes and decodes slices of texts with a packed lexicon.

    It remembers the ids of words from slice to slice, of ``remembered`` ids in all; then it begins anew.
    """

    def __init__(self, arrays: dict[str, np.ndarray], remembered: int = _REMEMBERED) -> None:
        self.arrays, self.remembered = arrays, remembered
        self.word_ids, self.word_ends = arrays["word_ids"], arrays["word_offsets"]
        self.token_data, self.token_ends = np.asarray(arrays["token_data"]), np.asarray(arrays["token_offsets"])
        self.merger = Merger(arrays["merges"].reshape(-1, 3), arrays["byte_ids"])
        self.special = json.loads(arrays["special"].tobytes().decode())
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.characters: set[str] = set()
        self._forget()

    def _forget(self) -> None:
        #: place of each word met, and the ids by place
        self.places: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def pieces(self, text: str) -> list[str]:
        """Words of a text. Characters younger than this Python's tables are split by the library's own tables."""
        if not text.isascii() and not self._known(text):
            from tokenizers.pre_tokenizers import ByteLevel

            return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        return split_words(text)

    def _known(self, text: str) -> bool:
        """Whether Python's tables know all characters: those of other libraries may be younger or older."""
        new = set(text) - self.characters
        if any(unicodedata.category(c) == "Cn" for c in new):
            return False
        self.characters |= new
        return True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the offsets of each text."""
        codes, known = [], len(self.places)
        for text in texts:
            words: list[str] = []
            if any(x in text for x in self.special):
                at = 0
                for found in self.cut.finditer(text):
                    words += self.pieces(text[at : found.start()])
                    words.append(found[0])
                    at = found.end()
                text = text[at:]
            words += self.pieces(text)
            codes.append(np.fromiter(map(self.places.__getitem__, words), np.int64, len(words)))
        self._learn(list(islice(self.places, known, None)))
        pick = np.concatenate(codes) if codes else np.empty(0, np.int64)
        ids, ends = gather(self.flat, self.ends, pick)
        total = np.concatenate([[0], ends])
        if len(self.flat) > self.remembered:
            self._forget()
        return ids, total[ends_of(np.array([len(c) for c in codes], np.int64))]

    def _learn(self, words: list[str]) -> None:
        """Append the ids of new words: special ones, those of the lexicon, and merged ones."""
        encoded = [w.encode() for w in words]
        found = find_words(self.arrays, encoded)
        # what is cut out of a text as special is never a word beside
        special = [k for k, w in enumerate(words) if w in self.special]
        found[special] = -1
        unseen = found < 0
        unseen[special] = False
        listed, unseen = np.flatnonzero(found >= 0), np.flatnonzero(unseen)
        values, ends = gather(self.word_ids, self.word_ends, found[listed])
        merged, offsets = self.merger.merge([encoded[k] for k in unseen.tolist()])
        named = np.array([self.special[words[k]] for k in special], np.int32)
        # segments in the order found; then in that of the words
        source = np.concatenate([values, merged, named]).astype(np.int32)
        order = np.concatenate([listed, unseen, np.array(special, np.int64)])
        lengths = np.concatenate([np.diff(ends, prepend=0), np.diff(offsets), np.ones(len(special), np.int64)])
        ids, ends = gather(source, ends_of(lengths), np.argsort(order))
        self.flat = np.concatenate([self.flat, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of ids; bytes that are no UTF-8 become U+FFFD. Null and unknown ids are refused."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_ends) - 1):
            raise ValueError("an id is not in the vocabulary")
        data, ends = gather(self.token_data, self.token_ends, ids.astype(np.int64))
        at = np.concatenate([[0], ends])[offsets].tolist()
        raw = data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]


@lru_cache(1)
def _coder(name: str) -> Coder:
    """The coder of the lexicon in use; a worker lives on after its job, so it keeps one only."""
    return Coder(open_packed(SparkFiles.get(name)))


@dataclass(frozen=True)
class Lexicon:
    """Name of the packed file that every executor fetches from the shared folder."""

    name: str


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) <= LONGEST_WORD]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
        )

    for batch in batches:
        texts = batch.column(0)
        for a, b in slices(texts):
            for text in texts.slice(a, b - a).to_pylist():
                if text:
                    counts.update(split_words(text))
            if len(counts) > 200_000:
                yield flush()
    yield flush()


def _write_shared(spark: SparkSession, label: str, data: bytes) -> str:
    """Write a file of the driver's into the shared folder, through Spark's own file systems."""
    path = new_path(spark, label)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        for at in range(0, len(data), 1 << 22):
            stream.write(bytearray(data[at : at + (1 << 22)]))
    finally:
        stream.close()
    return path


def build_lexicon(
    docs: DataFrame, vocabulary_path: str, max_words: int = 200_000, text_column: str = "text"
) -> Lexicon:
    """Compile the most frequent words of all texts, with their ids, for every executor to map.

    Words are counted over the whole table (counts are added up per task before the shuffle). The
    words with the highest counts, ``max_words`` at most and each seen twice at least, go to the
    driver, which merges them and compiles a minimal acyclic transducer: shared prefixes and suffixes,
    outputs adding up to a word's place, ids by place. One packed file with the transducer, the merges
    and the bytes of each id is written to the shared folder and fetched once per executor, where
    workers map it. The bound keeps it at some megabytes for any corpus. The lexicon only saves work:
    words that are not in it are merged exactly, so ids never depend on it.
    """
    spark = docs.sparkSession
    vocabulary = load_vocabulary(vocabulary_path)
    counted = (
        docs.select(F.col(text_column).cast("string").alias("text"))
        .mapInArrow(_count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where("n >= 2")
    )
    counts = materialise(counted, "word-counts")
    # the least count that few enough words have: a histogram of counts, of at most sqrt(2 * all words) rows
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    listed, least = 0, None
    for row in histogram.orderBy(F.desc("n")).toLocalIterator():
        listed += row["words"]
        if listed > max_words:
            break
        least = row["n"]
    words = [] if least is None else [r["word"].encode() for r in counts.where(F.col("n") >= least).collect()]
    words.sort()
    ids, offsets = Merger(vocabulary.merges, np.array(vocabulary.byte_ids)).merge(words)
    arrays = compile_words(words) | {
        "word_ids": ids,
        "word_offsets": offsets,
        "merges": vocabulary.merges.reshape(-1),
        "byte_ids": np.array(vocabulary.byte_ids, np.int32),
        "token_data": np.frombuffer(b"".join(vocabulary.token_bytes), np.uint8),
        "token_offsets": ends_of(np.array([len(t) for t in vocabulary.token_bytes], np.int64)),
        "special": np.frombuffer(json.dumps(vocabulary.special).encode(), np.uint8),
    }
    path = _write_shared(spark, f"lexicon-{uuid.uuid4().hex}", pack(arrays))
    spark.sparkContext.addFile(path)
    return Lexicon(path.rsplit("/", 1)[1])


def encode_documents(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> DataFrame:
    """All columns plus ``ids`` (array<int>) and ``n_tokens``; columns of these names are replaced.

    The ids are those of the tokenizers library without special tokens of its own, strings of special
    tokens in a text being such tokens. Null and empty texts have no ids. A very long text is a slice
    of its own. Each row is worked on alone, so repeated rows and empty tables need no care.
    """
    name = lexicon.name

    def work(texts: pa.Array) -> list[pa.Array]:
        ids, offsets = _coder(name).encode([t or "" for t in texts.to_pylist()])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return [lists, pa.array(np.diff(offsets), pa.int64())]

    extra = struct_of(ids=T.ArrayType(T.IntegerType()), n_tokens=T.LongType())
    return map_rows(docs, text_column, extra, work)


def decode_documents(encoded: DataFrame, lexicon: Lexicon, ids_column: str = "ids") -> DataFrame:
    """All columns plus ``decoded``, the text of the ids; null ids give a null, an unknown id is an error."""
    name = lexicon.name

    def work(lists: pa.Array) -> list[pa.Array]:
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        texts = pa.array(_coder(name).decode(ids, ends_of(counts)), pa.string())
        return [pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))]

    return map_rows(encoded, ids_column, struct_of(decoded=T.StringType()), work)


def round_trip(docs: DataFrame, lexicon: Lexicon, text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """All columns plus ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (and ``ids``): encoded and decoded in one pass.

    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8,
    in lower-case hex. For rows see :func:`encode_documents`.
    """
    name = lexicon.name

    def work(texts: pa.Array) -> list[pa.Array]:
        coder = _coder(name)
        ids, offsets = coder.encode([t or "" for t in texts.to_pylist()])
        raw, at = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
        digest = lambda data: hashlib.sha256(data).hexdigest()
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))] if with_ids else []
        return lists + [
            pa.array(np.diff(offsets), pa.int64()),
            pa.array([digest(raw[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.string()),
            pa.array([digest(t.encode()) for t in coder.decode(ids, offsets)], pa.string()),
        ]

    wanted = {"ids": T.ArrayType(T.IntegerType())} if with_ids else {}
    extra = struct_of(**wanted, n_tokens=T.LongType(), ids_sha256=T.StringType(), decoded_sha256=T.StringType())
    return map_rows(docs, text_column, extra, work)
