"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convspark.llm.batches import slices
from convspark.workspace import broadcast_if_small, materialise, materialise_counting

#: Characters of a gram; each takes 16 bits of a key, the last one the lowest.
ORDER = 4
_BITS = 16
#: Stands for characters beyond the basic plane, and for character 0.
_OTHER, _ZERO = 0xFFFF, 0xFFFE
#: Distinct grams that a task adds up before it hands them on.
_HELD = 4_000_000


@dataclass(frozen=True)
class PerplexityOptions:
    """A text is kept if its log perplexity lies between the ``low`` and ``high`` quantiles of its
    language's trusted texts, each of them scored by a model that was fitted without it.

    ``broadcast_grams`` is the largest table of scored grams that is sent to the workers (12 bytes
    each); beyond it grams are joined per document.
    """

    low: float = 0.005
    high: float = 0.995
    broadcast_grams: int = 4_000_000


def gram_keys(text: str) -> np.ndarray:
    """The key of the gram that ends at each character; the start is padded with zeros. As many as characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes > _ZERO - 1, _OTHER, np.where(codes == 0, _ZERO, codes)).astype(np.uint64)
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint64), codes])
    keys = np.zeros(len(codes), np.uint64)
    for k in range(ORDER):
        keys = (keys << np.uint64(_BITS)) | padded[k : k + len(codes)]
    return keys.view(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, text, trusted) to (language, key, trusted count, count)."""
    sums: dict[str | None, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
    held = 0

    def merged(parts):
        keys = np.concatenate([p[0] for p in parts])
        unique, of = np.unique(keys, return_inverse=True)
        return unique, *(np.bincount(of, np.concatenate([p[k] for p in parts])).astype(np.int64) for k in (1, 2))

    def flush() -> Iterator[pa.RecordBatch]:
        for language, parts in sums.items():
            keys, good, every = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(keys), pa.string()), pa.array(keys), pa.array(good), pa.array(every)],
                ["lang", "key", "good", "n"],
            )
        sums.clear()

    for batch in batches:
        for a, b in slices(batch.column(1)):
            by: dict[str | None, list[list[np.ndarray]]] = {}
            for lang, text, good in zip(*(batch.column(k).slice(a, b - a).to_pylist() for k in range(3)), strict=True):
                if text:
                    by.setdefault(lang, [[], []])[bool(good)].append(gram_keys(text))
            for lang, sides in by.items():
                parts = []
                for good, texts in enumerate(sides):
                    if texts:
                        keys, n = np.unique(np.concatenate(texts), return_counts=True)
                        parts.append((keys, n * good, n))
                sums[lang].append(merged(parts))
                held += len(sums[lang][-1][0])
                if len(sums[lang]) >= 8:
                    before = sum(len(p[0]) for p in sums[lang])
                    sums[lang] = [merged(sums[lang])]
                    held += len(sums[lang][0][0]) - before
            if held > _HELD:
                yield from flush()
                held = 0
    yield from flush()


def _suffix(key: Column, n: int) -> Column:
    """The last n characters of a key."""
    return key if n == ORDER else key.bitwiseAND(F.lit((1 << (_BITS * n)) - 1))


def _context(key: Column) -> Column:
    return F.shiftrightunsigned(key, _BITS)


def _discounts(counts: DataFrame) -> DataFrame:
    """Per language D1, D2, D3+ of modified Kneser-Ney from how many grams have the counts 1 to 4.

    Where these numbers give no discount between 0 and the count (small or odd tables), the absolute
    discounts 0.5, 1 and 1.5 stand in.
    """
    of = [F.count_if(F.col("a") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (F.col(f"n{k}").cast("double") for k in (1, 2, 3, 4))
    y = F.try_divide(n1, n1 + 2 * n2)
    raw = (1 - 2 * y * F.try_divide(n2, n1), 2 - 3 * y * F.try_divide(n3, n2), 3 - 4 * y * F.try_divide(n4, n3))
    safe = [
        F.when((n > 0) & (d > 0) & (d < k), d).otherwise(F.lit(k / 2)).alias(f"d{k}")
        for k, d, n in zip((1, 2, 3), raw, (n1, n2, n3), strict=True)
    ]
    return counts.groupBy("lang").agg(*of).select("lang", *safe)


@dataclass(frozen=True)
class KneserNey:
    """Tables per order 1 .. ORDER: ``grams`` (lang, key, p) and ``backoff`` (lang, context, g), and ``floor`` (lang, p)."""

    grams: list[DataFrame]
    backoff: list[DataFrame]
    floor: DataFrame


def fit_kneser_ney(counts: DataFrame) -> KneserNey:
    """Interpolated modified Kneser-Ney from counts (``lang``, ``key``, ``a``) of full grams.

    Below the highest order a gram counts the different characters before it. Per order the discounted
    counts are joined with the sums of their contexts and with the probabilities of their suffixes, all
    by (language, key): the tables are sharded by the shuffle, none is collected.
    """
    adjusted = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        adjusted[n] = (
            adjusted[n + 1].groupBy("lang", _suffix(F.col("key"), n).alias("key")).agg(F.count(F.lit(1)).alias("a"))
        )
        adjusted[n] = materialise(adjusted[n], f"grams-{n}")
    # one unseen character shares the mass that unigrams give away
    floor, grams, backoff = None, [], []
    lower = None
    for n in range(1, ORDER + 1):
        table = adjusted[n]
        cut = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (
            table.join(F.broadcast(_discounts(table)), "lang")
            .withColumn("context", _context(F.col("key")))
            .withColumn("cut", cut)
        )
        sums = materialise(
            rows.groupBy("lang", "context").agg(F.sum("a").alias("total"), (F.sum("cut") / F.sum("a")).alias("g")),
            f"contexts-{n}",
        )
        own = (F.col("a") - F.col("cut")) / F.col("total")
        if n == 1:
            sizes = table.groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("v"))
            floor = materialise(
                sums.join(F.broadcast(sizes), "lang").select("lang", (F.col("g") / F.col("v")).alias("p")), "floor"
            )
            found = rows.join(sums, ["lang", "context"]).join(F.broadcast(floor), "lang")
            found = found.select("lang", "key", (own + F.col("p")).alias("p"))
        else:
            suffix = lower.select("lang", F.col("key").alias("suffix"), F.col("p").alias("rest"))
            found = (
                rows.withColumn("suffix", _suffix(F.col("key"), n - 1))
                .join(sums, ["lang", "context"])
                .join(suffix, ["lang", "suffix"])
                .select("lang", "key", (own + F.col("g") * F.col("rest")).alias("p"))
            )
        lower = materialise(found, f"model-{n}")
        grams.append(lower)
        backoff.append(sums.select("lang", "context", "g"))
    return KneserNey(grams, backoff, floor)


def gram_scores(model: KneserNey, keys: DataFrame) -> DataFrame:
    """(``lang``, ``key``) to ln of the probability of the last character: the longest gram known, times back-off weights."""
    rows = keys.select("lang", "key")
    for n in range(ORDER, 0, -1):
        grams = model.grams[n - 1].select("lang", F.col("key").alias(f"k{n}"), F.col("p").alias(f"p{n}"))
        weights = model.backoff[n - 1].select("lang", F.col("context").alias(f"c{n}"), F.col("g").alias(f"g{n}"))
        rows = rows.withColumn(f"k{n}", _suffix(F.col("key"), n)).withColumn(f"c{n}", _context(F.col(f"k{n}")))
        rows = rows.join(grams, ["lang", f"k{n}"], "left").join(weights, ["lang", f"c{n}"], "left")
    rows = rows.join(F.broadcast(model.floor.withColumnRenamed("p", "p0")), "lang")
    p = F.coalesce("p1", "p0")
    for n in range(2, ORDER + 1):
        p = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"g{n}"), F.lit(1.0)) * p)
    return rows.select("lang", "key", F.ln(p).alias("score"))


#: A trusted text's half is written before its language: the model of "0=en" has not seen half 0.
_HALVES = ("0", "1")
_SCORED = "_id long, lang string, _good boolean, _chars long, _sum double, _count long, _held double"


def _sum_broadcast(marked: DataFrame, scores: DataFrame) -> DataFrame:
    """Add up scores with the whole table in each worker."""
    table = scores.toArrow().sort_by([("lang", "ascending"), ("key", "ascending")])
    names = table.column("lang").combine_chunks().dictionary_encode()
    keys, values = table.column("key").to_numpy(), table.column("score").to_numpy().astype(np.float32)
    codes = names.indices.to_numpy()
    model = {lang: (keys[codes == k], values[codes == k]) for k, lang in enumerate(names.dictionary.to_pylist())}
    shared = marked.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                langs, strings, halves = (part.column(k).to_pylist() for k in (1, 3, 4))
                sums, counts = np.zeros(b - a), np.zeros(b - a, np.int64)
                held = np.full(b - a, np.nan)
                rows: dict[tuple[str, bool], list[int]] = defaultdict(list)
                for k, (lang, text, half) in enumerate(zip(langs, strings, halves, strict=True)):
                    if text and lang in shared.value:
                        rows[lang, False].append(k)
                    if text and half is not None and half + lang in shared.value:
                        rows[half + lang, True].append(k)
                for (lang, without), places in rows.items():
                    keys, values = shared.value[lang]
                    grams = [gram_keys(strings[k]) for k in places]
                    found = values[np.searchsorted(keys, np.concatenate(grams))].astype(np.float64)
                    ends = np.cumsum([len(g) for g in grams])
                    totals = np.add.reduceat(found, np.concatenate([[0], ends[:-1]]))
                    if without:
                        held[places] = totals
                    else:
                        sums[places], counts[places] = totals, np.diff(ends, prepend=0)
                chars = pa.array([len(t or "") for t in strings], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], chars, pa.array(sums), pa.array(counts), pa.array(held, mask=np.isnan(held))],
                    ["_id", "lang", "_good", "_chars", "_sum", "_count", "_held"],
                )

    return marked.mapInArrow(run, _SCORED)


def _sum_joined(marked: DataFrame, scores: DataFrame) -> DataFrame:
    """Add up scores by a join of every document's distinct grams, for a table of any size."""
    # written, so that a row keeps its number
    rows = materialise(marked.withColumn("_row", F.monotonically_increasing_id()), "perplexity-rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lang, text, half in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if text:
                    keys, n = np.unique(gram_keys(text), return_counts=True)
                    for without, model in ((False, lang), (True, half and half + lang)):
                        if model is not None:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([row] * len(keys), pa.int64()), pa.array([model] * len(keys)), pa.array(keys), pa.array(n), pa.array([without] * len(keys))],
                                ["_row", "lang", "key", "_n", "_without"],
                            )

    grams = rows.select("_row", "lang", "_text", "_half").mapInArrow(
        run, "_row long, lang string, key long, _n long, _without boolean"
    )
    part = F.col("score") * F.col("_n")
    sums = (
        grams.join(scores, ["lang", "key"])
        .groupBy("_row")
        .agg(
            F.sum(F.when(~F.col("_without"), part)).alias("_sum"),
            F.sum(F.when(~F.col("_without"), F.col("_n"))).alias("_count"),
            F.sum(F.when(F.col("_without"), part)).alias("_held"),
        )
    )
    chars = F.coalesce(F.char_length("_text"), F.lit(0)).cast("long").alias("_chars")
    return rows.select("_row", "_id", "lang", "_good", chars).join(sums, "_row", "left").drop("_row")


def judge_perplexity(
    docs: DataFrame,
    trusted: DataFrame,
    options: PerplexityOptions | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
) -> DataFrame:
    """Perplexity of each document under its language's model, and whether it lies within the language's limits.

    ``trusted`` has the ids (``id_column``) of texts to learn from. Grams of four characters are counted
    over all texts, per language, in one pass: the trusted ones make the model, all of them are what has to be
    scored. Counts are added up per task, then per (language, gram). The model and the scores of all
    grams that occur come from joins of these sharded tables; their number is bounded by the
    languages' character sequences, not by the documents. Documents then add up scores with the table
    in each worker if its counted size allows, or by a join per document. Limits are quantiles of the log
    perplexity of a language's trusted texts: high for noise, low for text that repeats what is most common.
    Trusted texts are cut into halves by a hash of the text, so copies stay together, and each is held
    against the limits by the score of a model of the other half alone; ``perplexity`` shows that of the
    model of all. Where the other half of a language is empty, the model of all stands in.

    Result: id, ``lang``, ``n_chars``, ``perplexity``, ``trusted``, ``low``, ``high`` (limits, as perplexities),
    ``kept``. Null or empty texts, and those of a language without trusted texts, have no perplexity and are
    kept. A null language is a language of its own, shown as null. Rows with one id are trusted together; repeated rows count
    repeatedly. An empty table gives an empty table.
    """
    options = options or PerplexityOptions()
    ids, n_ids = materialise_counting(
        trusted.select(F.col(id_column).alias("_id")).where("_id IS NOT NULL").distinct(), "trusted"
    )
    marked = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(language_column)), F.lit("")).alias("lang"),
        F.col(text_column).cast("string").alias("_text"),
    ).join(broadcast_if_small(ids.withColumn("_good", F.lit(True)), n_ids), "_id", "left")
    half = F.when(F.col("_good"), F.pmod(F.xxhash64("_text"), F.lit(2)).cast("string"))
    marked = marked.select("_id", "lang", F.coalesce("_good", F.lit(False)).alias("_good"), "_text", half.alias("_half"))
    views = [F.struct("lang", F.col("_good").alias("learn"))]
    views += [F.struct(F.concat(F.lit(h), "lang").alias("lang"), (F.col("_half") != h).alias("learn")) for h in _HALVES]
    seen = marked.select("_text", F.explode(F.when(F.col("_good"), F.array(*views)).otherwise(F.array(views[0]))).alias("_as"))
    counts, n_grams = materialise_counting(
        seen.select("_as.lang", "_text", "_as.learn").mapInArrow(_count_grams, "lang string, key long, good long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("good").alias("good"), F.sum("n").alias("n")),
        "gram-counts",
    )
    model = fit_kneser_ney(counts.where("good > 0").select("lang", "key", F.col("good").alias("a")))
    scores = materialise(gram_scores(model, counts), "gram-scores")
    add = _sum_broadcast if n_grams <= options.broadcast_grams else _sum_joined
    carried = materialise(add(marked, scores), "perplexities")
    score = -F.try_divide("_sum", "_count")
    unseen = F.coalesce(-F.try_divide("_held", "_count"), score)
    scored = carried.withColumns(
        {"_log": F.when(F.col("_count") > 0, score), "_judged": F.when(F.col("_count") > 0, unseen)}
    )
    q = F.percentile_approx("_judged", [options.low, options.high], 10000)
    limits, n_limits = materialise_counting(
        scored.where("_good AND _judged IS NOT NULL").groupBy("lang").agg(q.alias("_q")).select(
            "lang", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high")
        ),
        "limits",
    )
    inside = F.col("_judged").between(F.col("_low"), F.col("_high"))
    return scored.join(broadcast_if_small(limits, n_limits), "lang", "left").select(
        F.col("_id").alias(id_column),
        F.when(F.col("lang") != "", F.substring("lang", 2, 1 << 30)).alias("lang"),
        F.col("_chars").alias("n_chars"),
        F.exp("_log").alias("perplexity"),
        F.col("_good").alias("trusted"),
        F.exp("_low").alias("low"),
        F.exp("_high").alias("high"),
        F.coalesce(inside, F.lit(True)).alias("kept"),
    )
