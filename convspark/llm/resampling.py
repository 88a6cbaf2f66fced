"""Importance resampling towards a target distribution of hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import map_rows, slices, struct_of
from convspark.llm.byte_runs import ByteRuns
from convspark.operators.ordering import ordered_index
from convspark.workspace import materialise

#: Bytes of text whose n-grams are interned in one table.
_SLICE = 1 << 18


def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether it belongs to a word (digits, letters, everything beyond ASCII), and its lower case."""
    codes = np.arange(256)
    inside = (codes >= 0x80) | ((codes >= 0x30) & (codes <= 0x39)) | ((codes >= 0x61) & (codes <= 0x7A))
    upper = (codes >= 0x41) & (codes <= 0x5A)
    return inside | upper, np.where(upper, codes + 0x20, codes).astype(np.uint8)


_INSIDE, _LOWER = _word_bytes()


def canonical(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words of all texts joined by one space: the bytes, where words start and end, words per text.

    Every run of consecutive words is then one run of bytes.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = np.frombuffer(b"".join(x.as_buffer().to_pybytes() + b" " for x in texts), np.uint8)
    inside = _INSIDE[joined]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]  # every text is followed by a space, so each word ends
    limits = np.cumsum(lengths + 1)
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    # a word takes the byte behind it along, as the space that joins it to the next one
    taken = inside.copy()
    taken[ends] = True
    lower = np.where(inside, _LOWER[joined], np.uint8(0x20))
    data = lower[taken].tobytes()
    sizes = ends - starts
    after = np.cumsum(sizes + 1)
    return data, after - sizes - 1, after - 1, counts


def runs(starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all runs of 1 to ``width`` words inside one text, and the text of each."""
    text = np.repeat(np.arange(len(counts)), counts)
    parts = []
    for k in range(min(width, len(starts))):
        same = text[: len(text) - k] == text[k:]
        parts.append((starts[: len(starts) - k][same], ends[k:][same], text[k:][same]))
    if not parts:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    first, last, of = (np.concatenate(p) for p in zip(*parts, strict=True))
    return first, last, of


def intern(parts: ByteRuns) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every run of bytes, equal runs having the same, and the run that owns each slot (-1: none).

    The table is open-addressed with linear probing, at most half full. A run settles where a free slot
    becomes its own or where the owner has its 64-bit key, its length and, verified, its bytes; all others
    try the next slot. All runs that still search probe together.
    """
    n = len(parts.starts)
    size = 1 << max(4, (2 * n - 1).bit_length() if n else 4)
    owner = np.full(size, -1, np.int64)
    keys, lengths = parts.xxh64(), parts.lengths
    slots = (keys & np.uint64(size - 1)).astype(np.int64)
    search = np.arange(n)
    while len(search):
        at = slots[search]
        free = owner[at] < 0
        owner[at[free]] = search[free]  # one of those that want a slot gets it
        holder = owner[at]
        alike = np.flatnonzero((keys[holder] == keys[search]) & (lengths[holder] == lengths[search]))
        settled = np.zeros(len(search), bool)
        settled[alike] = parts.equal(holder[alike], search[alike])
        search = search[~settled]
        slots[search] = (slots[search] + 1) & (size - 1)
    return slots, owner


class Features:
    """The runs of words of some texts: text and slot of each, and bucket and count of each slot."""

    def __init__(self, texts: pa.Array, width: int, buckets: int) -> None:
        data, starts, ends, self.words = canonical(texts)
        first, last, self.text = runs(starts, ends, self.words, width)
        parts = ByteRuns(data, first, last)
        self.slots, owner = intern(parts)
        used = np.flatnonzero(owner >= 0)
        self.bucket, self.count = np.zeros(len(owner), np.int64), np.bincount(self.slots, minlength=len(owner))
        self.bucket[used] = parts.crc32(owner[used]) % buckets


def count_buckets(texts: DataFrame, column: str, width: int, buckets: int) -> DataFrame:
    """Features of all texts per bucket (``bucket``, ``n``); every task sends the buckets it met once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            values = batch.column(0)
            for a, b in slices(values, _SLICE):
                found = Features(values.slice(a, b - a), width, buckets)
                np.add.at(total, found.bucket, found.count)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    source = texts.select(F.col(f"`{column}`").cast("string"))
    return source.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the log of target share by raw share per bucket, one feature added to each, rounded down."""
    s_all, t_all = sum(raw.values()), sum(target.values())
    return np.array(
        [
            math.floor(1000 * math.log((target.get(k, 0) + 1) * (s_all + buckets) / ((raw.get(k, 0) + 1) * (t_all + buckets))))
            for k in range(buckets)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray, width: int, text_column: str) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``n_features`` and ``weight``, the sum of its features' gains."""
    buckets = len(gains)

    def work(texts: pa.Array) -> list[pa.Array]:
        words, features, weights = [], [], []
        for a, b in slices(texts, _SLICE):
            found = Features(texts.slice(a, b - a), width, buckets)
            gain = gains[found.bucket][found.slots]  # of every occurrence
            sums = np.zeros(b - a, np.int64)
            np.add.at(sums, found.text, gain)
            words.append(found.words)
            features.append(np.bincount(found.text, minlength=b - a))
            weights.append(sums)
        return [pa.array(np.concatenate(x).astype(np.int64)) for x in (words, features, weights)]

    extra = struct_of(n_words=T.LongType(), n_features=T.LongType(), weight=T.LongType())
    return map_rows(docs, text_column, extra, work, keep_input=False)


def gumbel(key: Column, seed: int = 42) -> Column:
    """Thousandths of a Gumbel draw, rounded down, from a hash of the seed and a key; a null key is the empty string."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    bits = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((bits + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    width: int = 3,
    buckets: int = 10_000,
    min_words: int = 20,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Draw documents that look like the target texts, without replacement, by Gumbel top-k on log weights.

    Features are all runs of 1 to ``width`` lower-case words, repeats counted, hashed into ``buckets``. Per
    slice of texts they are interned in an open-addressed table, so that a distinct one is hashed into
    its bucket once and its occurrences gather the bucket's gain by slot. Two passes over the texts, none
    of them shuffled: one adds up counts per bucket (a table of ``buckets`` rows, the only thing that goes
    through the driver), one gathers gains. The draw ranks only scores above a percentile that leaves
    at least as many as wanted, by a range partition of narrow rows.

    Result per document: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (1, 2, ... by falling
    score, ties to the smaller id, a null id being the smallest; null if not drawn). A document with
    fewer than ``min_words`` words is not drawn and not counted. Null and empty texts have no features and
    weight 0; rows that repeat an id have the same noise, and ranks of their own in an order that is not
    defined if their scores are equal; a very long text is a slice of its own; without target texts all
    targets are equal; an empty table gives an empty table. Other columns are ignored.
    """
    if not 0 <= percent <= 100 or width < 1 or buckets < 1:
        raise ValueError("percent must be from 0 to 100, width and buckets positive")
    narrow = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    raw, wanted = (
        {r["bucket"]: r["n"] for r in count_buckets(df, text_column, width, buckets).collect()} for df in (docs, target)
    )
    weighed = weigh(narrow, bucket_gains(raw, wanted, buckets), width, "text")
    scored = materialise(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scores")
    able = F.col("n_words") >= min_words
    # twice the error that the percentile may have, and integer ties only add rows
    share = max(0.0, 1 - percent / 100 - 0.002)
    n, least = scored.where(able).agg(F.count(F.lit(1)), F.percentile_approx("score", share, 1000)).first()
    drawn = percent * n // 100
    high = able & (F.col("score") >= F.lit(least).cast("long"))
    if scored.where(high).count() < drawn:
        high = able
    falling = ordered_index(scored.where(high).withColumn("falling", -F.col("score")), "falling", "id")
    ranked = falling.select(
        *scored.columns, F.when(F.col("ordinal") < drawn, F.col("ordinal") + 1).cast("long").alias("rank")
    )
    others = scored.where(~F.coalesce(high, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).withColumnRenamed("id", id_column)
