"""Line de-duplication across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convspark.llm.batches import set_aside
from convspark.workspace import broadcast_if_small, materialise_counting

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _long_lines(docs: DataFrame, id_column: str, text_column: str, min_length: int) -> DataFrame:
    """One row per line whose key is long enough: document, text hash, position, 128 bits of the key."""
    text = F.col(text_column)
    stripped = F.btrim(F.col("_line"), F.lit(BLANKS))
    key = F.translate(stripped, UPPER, LOWER)
    return (
        docs.select(
            F.col(id_column).alias("_doc"),
            F.xxhash64(text).alias("_text"),
            F.posexplode(_lines(text)).alias("_pos", "_line"),
        )
        .where(F.char_length(stripped) >= min_length)
        .select(
            "_doc", "_text", "_pos", F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2")
        )
    )


def drop_repeated_lines(
    docs: DataFrame,
    min_documents: int = 5,
    min_length: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Take lines that stand in many documents out of all of them but one.

    Lines are exploded, normalised (blanks stripped at both ends, A-Z lower-cased) and hashed to 128
    bits; distinct documents are counted per hash. A hash found in ``min_documents`` or more is
    dropped everywhere except in the largest id that holds it. What remains is put together by
    position. Lines with a key under ``min_length`` code points are always kept.

    Only hashes are shuffled for counting: copies inside a task and then per document collapse
    before the count, so a line of a third of all documents is no hot key. The repeated hashes are
    written and broadcast only when their counted number is small; otherwise a sort-merge join (which
    adaptive execution may split) marks positions. A document's positions meet in one row, bounded by
    the document itself.

    Result: the input columns with the text replaced, plus ``n_lines`` (before) and ``n_dropped``;
    input columns of these names are replaced. A null text is one empty line. Rows with one id are
    one document when counting; rows with a null id are one document too, which never is the largest.
    Repeated rows stay repeated. An empty table gives an empty table.
    """
    narrow, back = set_aside(docs, id_column, text_column, ("n_lines", "n_dropped"))
    lines = _long_lines(narrow, "id", "text", min_length)
    holders = lines.select("_h1", "_h2", "_doc").distinct()
    repeated, n = materialise_counting(
        holders.groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_doc").alias("_keeper"))
        .where(F.col("_n") >= min_documents)
        .select("_h1", "_h2", "_keeper"),
        "repeated-lines",
    )
    dropped = (
        lines.join(broadcast_if_small(repeated, n), ["_h1", "_h2"])
        .where(F.col("_doc").isNull() | (F.col("_doc") < F.col("_keeper")))
        .groupBy("_doc", "_text")
        .agg(F.collect_list("_pos").alias("_dropped"))
    )
    rest = narrow.select("id", "row", F.xxhash64("text").alias("_own"), _lines(F.col("text")).alias("_lines"))
    joined = rest.join(dropped, F.col("id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_text")), "left")
    positions = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_dropped")
    kept = F.array_join(F.transform(positions, lambda i: F.get(F.col("_lines"), i)), "\n")
    text = F.when(F.col("_dropped").isNull(), F.array_join("_lines", "\n")).otherwise(kept)
    return back(
        joined.withColumn("text", text),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("_dropped")), F.lit(0)).cast("long").alias("n_dropped"),
    )
