"""Row order at scale: dense indexes, sampling, shuffling, sharding. No global window over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convspark.functions.split import TEST, TRAIN
from convspark.params import check_positive
from convspark.workspace import materialise, new_path

_SEPARATOR = "\x1f"
_COPIES_PER_BLOCK = 10_000
#: Up to this many rows, a sample is cut in every task first, so that its input runs once.
ONE_PASS_ROWS = 100_000
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def row_digest(columns: Sequence[str], seed: int = 0) -> Column:
    """md5 over the seed and the given columns: a reproducible random order key."""
    return F.md5(F.concat_ws(_SEPARATOR, F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in columns]))


def _expand_copies(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """One row per copy, with its ``ordinal``.

    Rows with very many copies are cut into blocks that are spread over the cluster before they
    unfold. ``hot`` lists those rows ahead of the ranking: when there are none, which is the rule,
    that branch is dropped at run time and nothing is ranked twice.
    """
    few = rows.where(F.col("_copies") <= _COPIES_PER_BLOCK).withColumn(
        "ordinal", F.explode(F.sequence("_start", F.col("_start") + F.col("_copies") - 1))
    )
    end = F.col("_start") + F.col("_copies") - 1
    many = (
        rows.where(F.col("_copies") > _COPIES_PER_BLOCK)
        .join(hot, ["_bucket", "_digest"], "left_semi")
        .withColumn("_block", F.explode(F.sequence("_start", end, F.lit(_COPIES_PER_BLOCK).cast("long"))))
        .repartition("_digest", "_block")
        .withColumn(
            "ordinal", F.explode(F.sequence("_block", F.least(F.col("_block") + _COPIES_PER_BLOCK - 1, end)))
        )
        .drop("_block")
    )
    return few.unionByName(many)


def _lowest_of_each_task(keyed: DataFrame, n: int) -> DataFrame:
    """A table with the n rows of lowest digest of every task, copies included: all that a sample of n can hold.

    Rows are ranked and cut inside their task, ahead of the only shuffle; it moves n rows per task at most.
    """
    spark = keyed.sparkSession
    in_task = Window.partitionBy("_task").orderBy("_digest")
    placed = keyed.withColumn("_task", F.spark_partition_id()).withColumn("_place", F.row_number().over(in_task))
    before = spark.conf.get(_GROUP_LIMIT)
    spark.conf.set(_GROUP_LIMIT, str(max(n, int(before))))  # for the plan of this one job
    try:
        return materialise(placed.where(F.col("_place") <= n).drop("_task", "_place"), "lowest")
    finally:
        spark.conf.set(_GROUP_LIMIT, before)


def dense_index(
    df: DataFrame,
    seed: int = 0,
    limit: int | None = None,
    key: Sequence[str] | None = None,
    unique: bool = False,
    prefix_digits: int = 4,
) -> DataFrame:
    """Add ``ordinal``: 0, 1, 2, ... in the order of a seeded hash of ``key`` (default: all columns).

    Rows fall into ``16 ** prefix_digits`` buckets by the first digits of the hash. The bucket
    counts, at most that many numbers, give each bucket's offset and are broadcast; rows are then
    ranked inside their bucket only. With ``limit``, buckets past it are dropped before the
    shuffle, so a small sample of a huge table moves little more than the sample.

    Identical rows are counted before they are shuffled and unfolded afterwards, unless the caller
    promises that the key is ``unique``. The input runs once: without a limit the rows are written with
    their hash, and with one of :data:`ONE_PASS_ROWS` at most the lowest rows of each task are. Beyond
    that, counting and fetching each run it, and only the sample is moved.
    """
    columns = df.columns
    if not 1 <= prefix_digits <= 5:
        raise ValueError("prefix_digits must be from 1 to 5: a million buckets are broadcast at most")
    keyed = df.withColumn("_digest", row_digest(key or columns, seed)).withColumn(
        "_bucket", F.conv(F.left("_digest", F.lit(prefix_digits)), 16, 10).cast("int")
    )
    # counted, ranked and checked for copies from here: the input runs once
    if limit is None:
        keyed = materialise(keyed, "keyed")
    elif limit <= ONE_PASS_ROWS:
        keyed = _lowest_of_each_task(keyed, limit)
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    through = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    offsets = counts.select("_bucket", (through - F.col("_n")).alias("_offset"))
    if limit is not None:
        offsets = offsets.where(F.col("_offset") < limit)
    kept = keyed.join(F.broadcast(offsets), "_bucket")  # bounded: one row per bucket

    quoted = [f"`{c}`" for c in columns]
    ties = [f"`{c}`" for c in key] if key and unique else quoted
    in_bucket = Window.partitionBy("_bucket").orderBy("_digest", *ties)
    if unique:
        indexed = kept.withColumn("ordinal", F.col("_offset") + F.row_number().over(in_bucket) - 1)
    else:
        grouped = kept.groupBy("_bucket", "_offset", "_digest", *quoted).agg(F.count(F.lit(1)).alias("_copies"))
        before = F.sum("_copies").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies")
        ranked = grouped.withColumn("_start", F.col("_offset") + before)
        if limit is not None:
            ranked = ranked.where(F.col("_start") < limit).withColumn(
                "_copies", F.least("_copies", F.lit(limit) - F.col("_start"))
            )
        hot = grouped.where(F.col("_copies") > _COPIES_PER_BLOCK).select("_bucket", "_digest")
        indexed = _expand_copies(ranked, hot)
    if limit is not None:
        indexed = indexed.where(F.col("ordinal") < limit)
    return indexed.select(*quoted, "ordinal")


def sample_n(df: DataFrame, n: int, seed: int = 0, unique: bool = False) -> DataFrame:
    """A uniform sample of exactly n rows without replacement; all rows when there are fewer."""
    return dense_index(df, seed, limit=n, unique=unique).drop("ordinal")


def ordered_index(df: DataFrame, *order: str) -> DataFrame:
    """Add ``ordinal``: 0, 1, 2, ... in the order of columns that identify a row.

    The rows are written once, range partitioned and sorted, into the shared folder. Each file is
    then one run of the order, so the ordinal is the row's place in its file plus the rows of the
    files before it: a table of one number per file.
    """
    spark = df.sparkSession
    path = new_path(spark, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    rows = (
        spark.read.schema(df.schema)
        .parquet(path)
        .withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    )
    sizes = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    piece = F.regexp_extract("_file", r"-c(\d+)\.", 1).cast("long")
    files = Window.orderBy(number, piece).rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("_file", (F.sum("_n").over(files) - F.col("_n")).alias("_offset"))
    # bounded: one row per file, and files are bounded by the shuffle partitions
    return rows.join(F.broadcast(offsets), "_file").select(
        *[f"`{c}`" for c in df.columns], (F.col("_offset") + F.col("_row")).alias("ordinal")
    )


def shard_lines(
    lines: DataFrame,
    *order: str,
    lines_per_shard: int = 100_000,
    suffix_length: int | None = None,
    prefix: str = "lines-",
) -> DataFrame:
    """Cut an ordered corpus into named shards: adds ``file_id`` (``lines-aaa``, ...) and ``line_no``.

    The names feed the train/test split, so they count in base 26 from ``aaa``. The suffix has three
    letters, or as many as the number of shards needs; running out of letters with a given length is an
    error.
    """
    indexed = ordered_index(lines, *order)
    if suffix_length is None:
        last = indexed.agg(F.max("ordinal")).first()[0] or 0
        suffix_length = 3
        while 26**suffix_length <= last // lines_per_shard:
            suffix_length += 1
    check_positive(lines_per_shard=lines_per_shard, suffix_length=suffix_length)
    shard = F.floor(F.col("ordinal") / lines_per_shard)
    letters = [
        F.char((F.floor(shard / 26**place) % 26 + ord("a")).cast("long")) for place in reversed(range(suffix_length))
    ]
    name = F.when(shard < 26**suffix_length, F.concat(F.lit(prefix), *letters)).otherwise(
        F.raise_error(F.lit("more shards than names: raise suffix_length"))
    )
    return (
        indexed
        .withColumn("file_id", name)
        .withColumn("line_no", F.col("ordinal") % lines_per_shard)
        .drop("ordinal", "path")  # a shard is a file of its own
    )


def shuffle_into_shards(examples: DataFrame, shards_train: int, shards_test: int) -> DataFrame:
    """Spread the rows of each split at random over its own partitions, in one exchange.

    Train rows go to partitions ``0 .. shards_train - 1``, test rows to the ``shards_test`` after
    them. The target is drawn from the row's place in its sorted input partition, so copies of one
    row spread evenly, and a task that runs again draws the same targets.
    """
    check_positive(shards_train=shards_train, shards_test=shards_test)
    by_hash = F.xxhash64(*[f"`{c}`" for c in examples.columns])
    draw = F.xxhash64(F.monotonically_increasing_id())
    target = (
        F.when(F.col("split") == TRAIN, F.pmod(draw, F.lit(shards_train)))
        .when(F.col("split") == TEST, shards_train + F.pmod(draw, F.lit(shards_test)))
        .otherwise(F.raise_error(F.lit("split must be train or test")))
    )
    return (
        examples.sortWithinPartitions(by_hash)
        .withColumn("_target", target.cast("int"))
        .repartitionById(shards_train + shards_test, F.col("_target"))
        .drop("_target")
        .sortWithinPartitions("split", by_hash)
    )
