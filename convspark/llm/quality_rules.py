"""Quality rules: counts of a text's words and lines, and bands of its compression ratio."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import ends_of, map_rows, struct_of
from convspark.workspace import materialise

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits of compressed size / size for texts of at least so many bytes; None is no limit."""

    min_bytes: int
    low: float | None
    high: float | None


#: Short texts compress badly because the frame and the first occurrences weigh more, so both limits
#: fall with the length. Prose lies between, with room on both sides.
DOCUMENT_BANDS = (
    Band(0, None, None),
    Band(128, 0.42, None),
    Band(256, 0.40, 0.90),
    Band(512, 0.36, 0.80),
    Band(1024, 0.33, 0.72),
    Band(4096, 0.28, 0.68),
    Band(16384, 0.24, 0.66),
)
#: A chunk is judged alone, so its limits are those of its own length, wider at the lower end.
CHUNK_BANDS = (Band(0, None, None), Band(1024, 0.20, 0.80), Band(4096, 0.16, 0.72))


@dataclass(frozen=True)
class CompressionRule:
    level: int = 3
    chunk_bytes: int = 4096
    max_bad_share: float = 0.125
    document_bands: Sequence[Band] = DOCUMENT_BANDS
    chunk_bands: Sequence[Band] = CHUNK_BANDS

    @staticmethod
    def outside(size: Column, ratio: Column, bands: Sequence[Band]) -> Column:
        """Whether a ratio lies below or above the limits for a size."""
        beyond = F.lit(False)
        for band in sorted(bands, key=lambda b: b.min_bytes):
            low = F.lit(False) if band.low is None else ratio < band.low
            high = F.lit(False) if band.high is None else ratio > band.high
            beyond = F.when(size >= band.min_bytes, low | high).otherwise(beyond)
        return beyond

    def bad_chunks(self, size: Column, ratios: Column) -> Column:
        """Chunks outside their limits; the last one has a length of its own."""
        n = F.size(ratios)
        whole = F.filter(F.slice(ratios, 1, F.greatest(n - 1, F.lit(0))), lambda r: self.outside(F.lit(self.chunk_bytes), r, self.chunk_bands))
        last = self.outside(size - (n - 1) * self.chunk_bytes, F.get(ratios, n - 1), self.chunk_bands)
        return F.size(whole) + F.when(n > 0, last.cast("int")).otherwise(0)


#: Quantiles of the ratio that are the limits of whole texts and, as a text has many, of chunks.
DOCUMENT_TAIL, CHUNK_TAIL = 0.005, 0.001
#: Texts or chunks that a band must have for quantiles of its own.
MIN_IN_BAND = 100


def _fitted(rows: Sequence[tuple[int, int, float, float]], otherwise: Sequence[Band]) -> tuple[Band, ...]:
    """Bands from (band, count, low, high); two bands to a doubling of the length.

    Ratios fall with the length, inside a band too. So a band takes the upper limit of the next shorter one
    that has enough texts, and the lower limit of the next longer one (the longest its own); ``otherwise``
    holds where there is none.
    """
    known = {k: (low, high) for k, n, low, high in rows if n >= MIN_IN_BAND}
    if not known:
        return tuple(otherwise)
    bands = [Band(0, known[min(known)][0], None)]
    starts = {int(np.ceil(2 ** (k / 2))): k for k in range(min(known), max(known) + 2)}
    for start in sorted({*starts, *(b.min_bytes for b in otherwise if b.min_bytes)}):
        at = max((k for s, k in starts.items() if s <= start), default=min(known) - 1)
        given = max((b for b in otherwise if b.min_bytes <= start), key=lambda b: b.min_bytes)
        longer = [k for k in known if k > at] or [k for k in known if k == at]
        shorter = [k for k in known if k < at]
        low = known[min(longer)][0] if longer else given.low
        bands.append(Band(start, low, known[max(shorter)][1] if shorter else given.high))
    return tuple(bands)


def fit_measured(trusted: DataFrame, rule: CompressionRule) -> CompressionRule:
    """:func:`fit_bands` from what :func:`measure_documents` adds: ``n_bytes``, ``ratio``, ``chunk_ratios``."""
    last = F.col("n_bytes") - (F.size("chunk_ratios") - 1) * rule.chunk_bytes
    chunks = F.transform(
        "chunk_ratios",
        lambda r, i: F.struct(
            F.lit(True).alias("chunk"),
            F.when(i == F.size("chunk_ratios") - 1, last).otherwise(rule.chunk_bytes).alias("size"),
            r.alias("ratio"),
        ),
    )
    whole = F.struct(F.lit(False).alias("chunk"), F.col("n_bytes").alias("size"), F.col("ratio"))
    parts = trusted.where("n_bytes > 0").select(F.inline(F.array_append(chunks, whole)))
    tails = [DOCUMENT_TAIL, 1 - DOCUMENT_TAIL, CHUNK_TAIL, 1 - CHUNK_TAIL]
    band = F.floor(2 * F.log2(F.col("size")) + 1e-9).cast("int")
    found = parts.groupBy("chunk", band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("ratio", tails, 10000).alias("q")
    ).collect()
    documents = [(r.band, r.n, r.q[0], r.q[1]) for r in found if not r.chunk]
    pieces = [(r.band, r.n, r.q[2], r.q[3]) for r in found if r.chunk]
    return replace(
        rule,
        document_bands=_fitted(documents, rule.document_bands),
        chunk_bands=_fitted(pieces, rule.chunk_bands),
    )


def fit_bands(trusted: DataFrame, rule: CompressionRule | None = None, text_column: str = "text") -> CompressionRule:
    """The rule with bands that are quantiles of the ratios of trusted texts and of their chunks, by length.

    Only the quantiles of at most some sixty bands reach the driver. Null and empty texts tell nothing;
    without texts, or with fewer than ``MIN_IN_BAND`` in every band, the rule stays as it is.
    """
    rule = rule or CompressionRule()
    only = trusted.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    return fit_measured(measure_documents(only, rule, keep_text=False), rule)


def _repeated_words(codes: np.ndarray, offsets: np.ndarray, width: int = 5) -> np.ndarray:
    """Per text, words inside windows of ``width`` words that the text has twice or more. Codes of texts are disjoint."""
    n = len(codes)
    if n < width:
        return np.zeros(len(offsets) - 1, np.int64)
    # windows become dense numbers by pairing: exact, no hashes
    base = int(codes.max()) + 1
    two = np.unique(codes[:-1] * base + codes[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * n + two[2:], return_inverse=True)[1]
    last = codes[width - 1 :]
    _, five, counts = np.unique(four[: len(last)] * base + last, return_inverse=True, return_counts=True)
    text = np.searchsorted(offsets, np.arange(n), "right") - 1
    inside = text[: len(last)] == text[width - 1 :]
    repeated = np.flatnonzero((counts[five] > 1) & inside)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + width, -1)
    marked = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return marked[offsets[1:]] - marked[offsets[:-1]]


def measure_documents(
    docs: DataFrame, rule: CompressionRule | None = None, text_column: str = "text", keep_text: bool = True
) -> DataFrame:
    """All that the rules look at, in one pass over the texts: counts, and ratios of the text and of its chunks.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``n_bytes``,
    ``ratio`` (null for an empty text) and ``chunk_ratios``; input columns of these names are replaced.
    """
    rule = rule or CompressionRule()

    def work(texts: pa.Array) -> list[pa.Array]:
        compress = zstandard.ZstdCompressor(level=rule.level).compress
        codes: list[int] = []
        base, rows, counts, ratios, chunk_ratios = 0, [], [], [], []
        for text in texts.to_pylist():
            text = text or ""
            data = text.encode()
            places: dict[bytes, int] = {}
            before = len(codes)
            codes += [places.setdefault(w, base + len(places)) for w in data.split()]
            base += len(places)
            counts.append(len(codes) - before)
            lines = [x for x in text.split("\n") if x.strip(BLANKS)]
            rows.append(
                (
                    len(text) - sum(text.count(c) for c in BLANKS),
                    sum(text.count(c) for c in SYMBOLS),
                    len(lines) - len(set(lines)),
                    len(data),
                )
            )
            ratios.append(len(compress(data)) / len(data) if data else None)
            chunks = [data[a : a + rule.chunk_bytes] for a in range(0, len(data), rule.chunk_bytes)]
            # a text of one chunk is not compressed twice
            chunk_ratios.append([len(compress(c)) / len(c) for c in chunks] if len(chunks) > 1 else ratios[-1:] * len(chunks))
        n_words = np.array(counts, np.int64)
        repeated = _repeated_words(np.array(codes, np.int64), ends_of(n_words))
        failed = (n_words < 10) | (100 * repeated > 20 * n_words)
        chars, symbols, duplicates, size = (pa.array([r[k] for r in rows], pa.int64()) for k in range(4))
        return [
            pa.array(n_words), chars, symbols, duplicates, pa.array(repeated, pa.int64()), pa.array(failed), size,
            pa.array(ratios, pa.float64()), pa.array(chunk_ratios, pa.list_(pa.float64())),
        ]

    long = T.LongType()
    extra = struct_of(
        n_words=long, word_chars=long, n_symbols=long, n_dup_lines=long, n_repeat_words=long, base_failed=T.BooleanType(),
        n_bytes=long, ratio=T.DoubleType(), chunk_ratios=T.ArrayType(T.DoubleType()),
    )
    return map_rows(docs, text_column, extra, work, keep_input=keep_text)


def judge_measured(measured: DataFrame, *rules: CompressionRule, turn: Column | None = None) -> DataFrame:
    """``n_chunks``, ``n_bad_chunks`` and ``kept`` instead of ``n_bytes`` and ``chunk_ratios``; ``turn`` picks each row's rule."""
    size, ratios = F.col("n_bytes"), F.col("chunk_ratios")
    chosen = [
        F.struct(
            rule.bad_chunks(size, ratios).cast("long").alias("bad"),
            rule.outside(size, F.col("ratio"), rule.document_bands).alias("outside"),
            F.lit(rule.max_bad_share).alias("share"),
        )
        for rule in rules
    ]
    verdict = chosen[0] if turn is None else F.get(F.array(*chosen), turn)
    fine = (size == 0) | (~verdict["outside"] & (verdict["bad"] <= verdict["share"] * F.size(ratios)))
    added = {
        "n_chunks": F.size(ratios).cast("long"),
        "n_bad_chunks": verdict["bad"],
        "kept": ~F.col("base_failed") & fine,
    }
    names = [c for c in measured.columns if c not in ("n_bytes", "chunk_ratios", *added)]
    return measured.select(*[F.col(f"`{c}`") for c in names], *[c.alias(name) for name, c in added.items()])


def judge_documents(docs: DataFrame, rule: CompressionRule | None = None, text_column: str = "text") -> DataFrame:
    """Count what quality rules ask for and judge each text by its compression.

    Words are runs without blanks. Base rules fail texts of under 10 words and those of which over a
    fifth of the words lie in repeated 5-word windows. The compression rule takes zstandard's ratio of
    the whole UTF-8 text and of fixed chunks of it: under a band's lower limit the text repeats
    itself, above its upper one it is noise; limits depend on the length, and :func:`fit_bands` takes them
    from trusted texts. A text is rejected if the whole lies outside, or more than ``max_bad_share`` of
    its chunks, the last one by the band of its own length.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``ratio`` (null for an empty text), ``n_chunks``, ``n_bad_chunks``, ``kept``;
    input columns of these names are replaced, and ones named ``n_bytes`` or ``chunk_ratios`` are dropped. A null text
    counts as empty: no words, base_failed. Each row is judged alone, so repeated rows, ties and empty
    tables need no care; no shuffle.
    """
    rule = rule or CompressionRule()
    return judge_measured(measure_documents(docs, rule, text_column), rule)


def judge_by_trusted(
    docs: DataFrame, trusted: DataFrame, rule: CompressionRule | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """:func:`judge_documents` without texts, by bands from the texts whose ids ``trusted`` lists.

    Texts are read and compressed once, into a narrow table of measures; that table is what meets the list of
    ids. Ids fall into two halves by hash, and each text is judged by the bands of the other half, so that none
    sets its own limits. A null id is not trusted and lies in the first half; repeated ids of the list count once.
    """
    rule = rule or CompressionRule()
    id_name = F.col(f"`{id_column}`").alias(id_column)
    narrow = docs.select(id_name, F.col(f"`{text_column}`").cast("string").alias(text_column))
    measured = materialise(measure_documents(narrow, rule, text_column, keep_text=False), "measures")
    listed = measured.join(trusted.select(id_name).distinct(), id_column, "left_semi")
    half = F.pmod(F.xxhash64(F.col(f"`{id_column}`")), F.lit(2)).cast("int")
    rules = [fit_measured(listed.where(half == other), rule) for other in (1, 0)]
    turn = F.when(F.col(f"`{id_column}`").isNull(), F.lit(0)).otherwise(half)
    return judge_measured(measured, *rules, turn=turn)
