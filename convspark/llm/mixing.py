"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convspark.workspace import broadcast_if_small, materialise, materialise_counting

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a boundary bucket should hold, and buckets per level.
_GROUP, _BUCKETS = 512, 1024
_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1, decided by the parts."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, _DIGITS), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(16**_DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of sources (``_none``, ``_source``, ``source_size``): weighted shares under caps.

    ``share`` of all sizes is dealt out by weight; a target stops at ``cap`` times its source's size
    and the excess goes to the others by weight until none is above. Solved at once: in order of
    cap / weight, the level at which the rest shares what the earlier caps leave. One row per source.
    """
    order = Window.orderBy("_none", "_source")
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("_cap") / F.col("_weight"), "_none", "_source")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    place = (F.row_number().over(order) - 1) % len(weights)
    level = (F.col("_goal") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))) / F.sum("_weight").over(rest)
    return (
        sizes.withColumn("_weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place))
        .withColumn("_cap", cap * F.col("source_size"))
        .withColumn("_goal", share * F.sum("source_size").over(everything))
        .withColumn("_level", level)
        .withColumn("_capped", F.col("_cap") <= F.col("_level") * F.col("_weight"))
        .withColumn("_level", F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything))
        .withColumn("target", F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_level") * F.col("_weight")))
        .drop("_cap", "_goal", "_level", "_capped", "_weight")
    )


def _boundary(rows: DataFrame, bucket: str, wanted: str) -> DataFrame:
    """The bucket of each source in which the running sum of sizes reaches ``wanted``, and the sum before it."""
    running = Window.partitionBy("_none", "_source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("_none", "_source", bucket)
        .agg(F.sum("size").alias("_words"), F.first(wanted).alias("_wanted"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(running), F.lit(0)))
        .where((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_words")))
        .select("_none", "_source", F.col(bucket).alias("_edge"), "_before")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 8,
    weight_column: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    carry: bool = False,
) -> DataFrame:
    """How many copies of each document a mix of sources takes.

    A document's size is its number of words. Sources, in code point order with null last, have the
    weights in turn and share ``share`` of all sizes; see :func:`source_targets`. A document of a
    source should be taken ``target / source size`` times (times its relative ``weight_column``, if
    given; null or negative counts as 0), ``cap`` times at most. The whole part is certain. For the
    fractional part λ, documents are ranked by Pareto's variable (u / (1-u)) / (λ / (1-λ)), u a hash
    of id and text, and the lowest ranks are taken until their words reach what the target lacks.

    No source is one group: ranks fall into up to 1024 x 1024 buckets per source; counting finds the
    bucket in which the sum of words is reached, and only in that one (some hundred rows) are
    documents taken one by one, each that still fits. So a source ends below its target by less than
    any document left in that bucket.

    Result: id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` (copies x size), and
    with ``carry`` the whole input row as ``document``. A null text has size 0, an empty table gives an empty table, repeated
    rows are documents of their own, and reruns agree. A null source is a source of its own.
    """
    weight = F.lit(1.0)
    if weight_column is not None:
        weight = F.greatest(F.coalesce(F.col(weight_column).cast("double"), F.lit(0.0)), F.lit(0.0))
    text = F.col(text_column)
    source = F.col(source_column).cast("string")
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] if carry else []
    narrow = materialise(
        docs.select(
            F.col(id_column),
            F.col(source_column).alias("source"),
            source.isNull().alias("_none"),
            F.coalesce(source, F.lit("")).alias("_source"),
            word_count(text).alias("size"),
            weight.alias("_own"),
            _uniform(
                F.lit(str(seed)),
                F.coalesce(F.col(id_column).cast("string"), F.lit("")),
                F.md5(F.coalesce(text, F.lit(""))),
            ).alias("_u"),
            F.monotonically_increasing_id().alias("_row"),
            *carried,
        ),
        "mix-rows",
    )
    sizes = narrow.groupBy("_none", "_source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("size") * F.col("_own")).alias("_weighted"),
    )
    sources, n_sources = materialise_counting(source_targets(sizes, weights, share, cap), "mix-sources")
    expected = F.when(F.col("_weighted") > 0, F.col("target") * F.col("_own") / F.col("_weighted")).otherwise(0.0)
    dealt = (
        narrow.join(broadcast_if_small(sources, n_sources), ["_none", "_source"])
        .withColumn("_expected", F.least(expected, F.lit(cap)))
        .withColumn("_certain", F.floor("_expected"))
        .withColumn("_odds", F.col("_expected") - F.col("_certain"))
    )
    left = F.col("target") - F.col("_sure")
    sure = dealt.groupBy("_none", "_source").agg(
        F.sum(F.col("_certain") * F.col("size")).alias("_sure"),
        F.avg(F.when(F.col("_odds") > 0, F.col("_odds"))).alias("_mean"),
    )
    lots, _ = materialise_counting(
        sources.join(sure, ["_none", "_source"])
        .withColumn("_lack", left)
        .withColumn("_b1", F.least(F.lit(_BUCKETS), F.greatest(F.lit(1), F.floor(F.col("_rows") / _GROUP))))
        .withColumn(
            "_b2", F.least(F.lit(_BUCKETS), F.greatest(F.lit(1), F.floor(F.col("_rows") / F.col("_b1") / _GROUP)))
        )
        .select("_none", "_source", "_lack", "_mean", "_b1", "_b2"),
        "mix-lots",
    )
    odds = lambda c: c / (1 - c)
    rank = odds(F.col("_u")) / odds(F.col("_odds"))
    # as u itself where all odds are equal, so that buckets are filled evenly
    spread = rank * odds(F.col("_mean"))
    fine = F.least(F.floor(spread / (1 + spread) * F.col("_b1") * F.col("_b2")), F.col("_b1") * F.col("_b2") - 1)
    ranked = (
        dealt.join(broadcast_if_small(lots, n_sources), ["_none", "_source"])
        .withColumn("_rank", F.when(F.col("_odds") > 0, rank))
        .withColumn("_fine", F.when(F.col("_odds") > 0, fine))
        .withColumn("_coarse", F.floor(F.col("_fine") / F.col("_b2")))
    )
    candidates = ranked.where(F.col("_fine").isNotNull() & (F.col("_lack") > 0))
    coarse = _boundary(candidates, "_coarse", "_lack")
    coarse = coarse.select("_none", "_source", F.col("_edge").alias("_coarse"), F.col("_before").alias("_sum"))
    near = candidates.join(broadcast_if_small(coarse, n_sources), ["_none", "_source", "_coarse"]).withColumn(
        "_still", F.col("_lack") - F.col("_sum")
    )
    edge = _boundary(near, "_fine", "_still").select(
        "_none", "_source", F.col("_edge").alias("_fine"), F.col("_before").alias("_sum_fine")
    )
    fitted = F.aggregate(
        F.array_sort(F.collect_list(F.struct("_rank", "_row", "size"))),
        F.struct(
            F.first(F.col("_still") - F.col("_sum_fine")).cast("double").alias("gap"),
            F.array().cast("array<bigint>").alias("rows"),
        ),
        lambda state, row: F.when(
            row["size"] <= state["gap"],
            F.struct(
                (state["gap"] - row["size"]).alias("gap"),
                F.concat(state["rows"], F.array(row["_row"])).alias("rows"),
            ),
        ).otherwise(state),
    )["rows"]
    last, n_last = materialise_counting(
        near.join(broadcast_if_small(edge, n_sources), ["_none", "_source", "_fine"])
        .groupBy("_none", "_source", "_fine")
        .agg(fitted.alias("_rows_taken")),
        "mix-last",
    )
    edges = last.select("_none", "_source", F.col("_fine").alias("_last"))
    marks = last.select(F.explode("_rows_taken").alias("_row"), F.lit(1).alias("_marked"))
    marks = broadcast_if_small(marks, n_last * 4 * _GROUP)
    # without a boundary all that have a chance are taken, or none where nothing is lacking
    before = F.col("_fine") < F.coalesce("_last", F.when(F.col("_lack") > 0, F.col("_b1") * F.col("_b2")).otherwise(0))
    extra = F.coalesce("_marked", before.cast("int"), F.lit(0))
    copies = (F.col("_certain") + extra).cast("long")
    return (
        ranked.join(broadcast_if_small(edges, n_sources), ["_none", "_source"], "left")
        .join(marks, "_row", "left")
        .select(
            id_column, "source", "size", "source_size", "target", copies.alias("copies"),
            (copies * F.col("size")).alias("taken"), *["document"] * carry,
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every input row as often as :func:`mix_sources` takes it, with its own columns."""
    mix = mix_sources(docs, carry=True, **options).where("copies > 0")
    return mix.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "document").select("document.*")
