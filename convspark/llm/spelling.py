"""Groups of spelling variants: words one edit apart, found over a reduced alphabet."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.workspace import BROADCAST_ROWS, materialise, materialise_counting

#: Letters of words, in lower case but for those beyond ASCII, and the UTF-8 bytes of a run of them.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_RUN = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF])+")
#: Symbols that letters are hashed to, at most.
_SYMBOLS = "0123456789ABCDEFGHIJKLMN"
#: Base of the keys of reduced words: odd, and above the number of any symbol.
_BASE = np.uint64(25)
#: Neighbours that are made at once, and that a task makes.
_NUMBERS = 1 << 20
_NUMBERS_PER_TASK = 1 << 23
#: Distinct words that a task counts before it sends them on.
_WORDS_PER_TASK = 200_000


def count_words(
    docs: DataFrame, min_length: int = 5, drop_one_in: int = 97, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Occurrences of words (``word``, ``n``), counted per task before the shuffle.

    Words are runs of Latin letters, A-Z in lower case. Where ``drop_one_in`` divides the CRC-32 of ``<id>:<run>``,
    the run has lost one letter, at the CRC modulo its length; 0 leaves all runs as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            kept = [(w, n) for w, n in total.items() if len(w) - w.count(b"\xc3") >= min_length]
            total.clear()
            words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                counts = Counter(_RUN.findall(text.as_buffer().to_pybytes().lower())) if text.is_valid else {}
                prefix = crc32(f"{key}:".encode())
                for word, n in counts.items():
                    if drop_one_in and not (h := crc32(word, prefix)) % drop_one_in:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1 :]).encode()
                    total[word] = total.get(word, 0) + n
                if len(total) > _WORDS_PER_TASK:
                    yield flush()
        yield flush()

    source = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")), F.col(f"`{text_column}`").cast("string")
    )
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def choose_symbols(words_by_length: dict[int, int]) -> tuple[int, int]:
    """Size of the reduced alphabet with the least expected work, and how many neighbours it makes.

    A word of length L has about 2 L k neighbours over k symbols, of which each meets the words whose
    reduced form it is; to verify one of these costs about as much as to make and move three neighbours. Letters
    are not equally frequent, so k symbols part words like 0.6 k equal ones.
    """

    def made(k: int) -> int:
        return sum(n * (2 * length + 1) * (k + 1) for length, n in words_by_length.items())

    def met(k: int) -> float:
        return sum(n * n * (2 * length + 1) * k / (0.6 * k) ** length for length, n in words_by_length.items())

    best = min(range(4, len(_SYMBOLS) + 1), key=lambda k: made(k) + 3 * met(k))
    return best, made(best)


def reduced(word: Column, symbols: int) -> Column:
    """The word with every letter replaced by one of a few symbols, chosen by the letter's hash."""
    return F.translate(word, LETTERS, "".join(_SYMBOLS[crc32(f"{x}/{symbols}".encode()) % symbols] for x in LETTERS))


def _blocks(codes: pa.Array, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Reduced words of one length at a time: their places, and the numbers of their symbols from 1 on."""
    lengths = pc.binary_length(codes).to_numpy(zero_copy_only=False)
    number = np.zeros(256, np.uint64)
    number[np.frombuffer(_SYMBOLS.encode(), np.uint8)] = np.arange(1, len(_SYMBOLS) + 1)
    for length in np.unique(lengths[lengths > 0]).tolist():
        where = np.flatnonzero(lengths == length)
        rows = max(1, _NUMBERS // ((2 * length + 1) * (symbols + 1)))
        for k in range(0, len(where), rows):
            part = where[k : k + rows]
            text = b"".join(codes.take(pa.array(part)).to_numpy(zero_copy_only=False).astype("S").tolist())
            yield part, number[np.frombuffer(text, np.uint8).reshape(len(part), length)]


def _sums(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of digit times power of :data:`_BASE` over the first 0, 1, ... digits, and the powers; modulo 2 ** 64."""
    powers = np.full(digits.shape[1] + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros((len(digits), digits.shape[1] + 1), np.uint64)
    np.cumsum(digits * powers[:-1], axis=1, out=sums[:, 1:])
    return sums, powers


def code_keys(codes: pa.Array, symbols: int) -> np.ndarray:
    """64-bit keys of reduced words; exact numbers for short words, a hash for long ones."""
    keys = np.zeros(len(codes), np.uint64)
    for part, digits in _blocks(codes, symbols):
        keys[part] = _sums(digits)[0][:, -1]
    return keys


def neighbour_keys(digits: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of the words themselves and of all one-edit neighbours, a sorted row per word, repeats included."""
    sums, powers = _sums(digits)
    whole = sums[:, -1:]
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    shorter = sums[:, :-1] + (whole - sums[:, 1:]) * inverse
    replaced = whole[:, :, None] + (every - digits[:, :, None]) * powers[:-1, None]
    longer = (sums + (whole - sums) * _BASE)[:, :, None] + every * powers[:, None]
    return np.sort(np.concatenate([whole, shorter, *(x.reshape(len(digits), -1) for x in (replaced, longer))], axis=1), axis=1)


def _with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with ``code``, the reduced word, and its ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array(code_keys(batch.column(batch.num_columns - 1), symbols).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "key"])

    coded = words.withColumn("code", reduced(F.col("word"), symbols))
    return coded.mapInArrow(run, T.StructType([*coded.schema, T.StructField("key", T.LongType())]))


def _neighbourhoods(codes: DataFrame, symbols: int) -> DataFrame:
    """(``code``, ``key`` of a neighbour, whether that is its ``own``), for neighbours whose key is no lower than its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for part, digits in _blocks(column, symbols):
                own = _sums(digits)[0][:, -1:]
                keys = neighbour_keys(digits, symbols)
                kept = keys >= own
                kept[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                row = np.nonzero(kept)[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        column.take(pa.array(part[row])),
                        pa.array(keys[kept].view(np.int64)),
                        pa.array(keys[kept] == own[row, 0]),
                    ],
                    ["code", "key", "own"],
                )

    return codes.mapInArrow(run, "code string, key long, own boolean")


def _counted(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join, broadcast up to :data:`BROADCAST_ROWS` rows; beyond that Spark's sizes choose neither side."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side.hint("merge")


def near_pairs(words: DataFrame, symbols: int, tasks: int) -> DataFrame:
    """All pairs of words exactly one edit apart, once each: (``a``, ``a_n``, ``b``, ``b_n``).

    ``words``: distinct ``word``, ``n``. One edit changes a reduced word by one edit at most, so two near words
    have reduced words of which one lies in the other's full neighbourhood. Neighbourhoods are made of the
    distinct reduced words, by ``tasks`` tasks, kept where their key is not below the word's own (such a pair is met
    from the other side), and joined with the vocabulary by key. What meets is verified on the words
    themselves, so that words of equal keys do no harm.
    """
    coded, n = materialise_counting(_with_keys(words, symbols), "coded-words")
    codes = coded.select("code").repartition(tasks, "code").distinct()
    right = coded.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    # Spark sizes neighbourhoods by the words that they are made of, hundreds of times too low: they are never broadcast
    met = _neighbourhoods(codes, symbols).join(_counted(right, n), "key").drop("key")
    left = coded.select("code", F.col("word").alias("a"), F.col("n").alias("a_n"))
    once = ~F.col("own") | (F.col("a") < F.col("b"))
    return (
        met.join(_counted(left, n), "code").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")
    )


def follow(links: DataFrame) -> DataFrame:
    """Last word reached from each ``word`` over ``form``: (``word``, ``root``). Chains must not loop.

    Every round doubles the way that each word has gone, so rounds grow with the logarithm of the longest
    chain. A form that many words share is a key with one row on the other side, which adaptive execution may split.
    """
    now, n = materialise_counting(links.select("word", F.col("form").alias("root")), "roots")
    moved = n
    while moved:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        gone = now.join(_counted(on, n), "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        table, moved = materialise_counting(gone, "roots", F.col("_moved"))
        now = table.drop("_moved")
    return now


def spelling_variants(
    docs: DataFrame,
    min_length: int = 5,
    min_count: int = 3,
    drop_one_in: int = 97,
    factor: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Words of all texts, each with the more frequent word that it is likely a variant of.

    Words: :func:`count_words`, of ``min_length`` letters and ``min_count`` occurrences at least. Near words differ by
    exactly one inserted, deleted or replaced letter. A word's form is its near word of largest count (ties: the
    smallest) if that is at least ``factor`` times its own; its root is the last word that forms lead to. Counts
    rise along forms, so they cannot loop. The alphabet's size only sets how much work there is
    (:func:`choose_symbols`); no group is gathered, joins over frequent forms or reduced words may be split.

    Result per word: ``word``, ``form`` (or null), ``root``, ``n``, ``n_near``, ``form_n`` (or null). Null and empty
    texts have no words, a null id counts as empty, repeated rows count again, other columns are ignored,
    an empty table gives no words. A very long text is counted whole, by one task.
    """
    if min_length < 1 or factor < 2:
        raise ValueError("min_length must be positive, factor 2 or more")
    counted = count_words(docs, min_length, drop_one_in, id_column, text_column)
    words, n = materialise_counting(counted.where(F.col("n") >= min_count), "words")
    # bounded: longer words than these are few and far apart
    lengths = words.groupBy(F.least(F.length("word"), F.lit(64)).alias("length")).count().collect()
    symbols, made = choose_symbols({r["length"]: r["count"] for r in lengths})
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, made // _NUMBERS_PER_TASK)
    sides = [F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n"))
             for x, y in (("a", "b"), ("b", "a"))]
    both = near_pairs(words, symbols, tasks).select(F.inline(F.array(*sides)))
    best = (
        both.groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("_best"))
        .select("word", "n_near", F.col("_best.near").alias("_near"), (-F.col("_best.minus")).alias("_n"))
    )
    is_form = F.col("_n") >= factor * F.col("n")
    formed = materialise(
        words.join(_counted(best, n), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("_near")).alias("form"), F.when(is_form, F.col("_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(_counted(roots, n), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
