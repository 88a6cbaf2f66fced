"""Question/answer records stored as one Python dict literal per line."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.schema import QA_RECORD

CORRUPT = "_corrupt"
NO_RECORD = "no record"
#: Columns of numbered lines that tell where a line stands.
PLACE = ("path", "file_id", "line_no")


def _fitting(value, kind: T.DataType):
    """The value, if it has the type at every level; text with its surrogate pairs joined. Else a ValueError."""
    if value is None:
        return None
    if isinstance(kind, T.StringType) and isinstance(value, str):
        return value.encode("utf-16", "surrogatepass").decode("utf-16")  # a lone surrogate is no text
    if isinstance(kind, T.ArrayType) and isinstance(value, (list, tuple)):
        return [_fitting(v, kind.elementType) for v in value]
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return {f.name: _fitting(value.get(f.name), f.dataType) for f in kind.fields}
    raise ValueError(f"{value!r} is not of type {kind.simpleString()}")


@F.pandas_udf(QA_RECORD)
def _evaluate(lines: pd.Series) -> pd.DataFrame:
    """Read dict literals the JSON reader cannot; anything else, a value of a wrong type too, gives nulls."""

    def record(line: str | None) -> dict:
        if line is None:
            return {}
        try:
            value = ast.literal_eval(line)
            return {f.name: _fitting(value.get(f.name), f.dataType) for f in QA_RECORD.fields} if isinstance(value, dict) else {}
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return {}

    fields = [f.name for f in QA_RECORD.fields]
    return pd.DataFrame([[r.get(name) for name in fields] for r in map(record, lines)], columns=fields)


def parse_qa_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Records from dict literals, plus ``_corrupt``: the line when it is neither form of record.

    Literals without a backslash that also read as JSON with single quotes stay in the JVM; only the
    rest (escapes, ``u''`` strings, ``True``, ``None``, tuples) goes to Python, in Arrow batches.
    Every line is read once. Columns that say where the line stands (:data:`PLACE`) stay with the record.
    """
    with_corrupt = T.StructType([*QA_RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"allowSingleQuotes": "true", "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    plain = F.when(~F.contains(F.col(column), F.lit("\\")), F.from_json(column, with_corrupt, options))
    known = F.col("_plain").isNotNull() & F.col(f"_plain.{CORRUPT}").isNull() & F.col("_plain.asin").isNotNull()
    places = [c for c in PLACE if c in lines.columns]
    parsed = (
        lines.select(column, *places, plain.alias("_plain"))
        .withColumn("_is_plain", known)
        .withColumn("_literal", _evaluate(F.when(~F.col("_is_plain"), F.col(column))))
    )

    names = [f.name for f in QA_RECORD.fields]
    chosen = [
        F.when(F.col("_is_plain"), F.col(f"_plain.{n}")).otherwise(F.col(f"_literal.{n}")).alias(n) for n in names
    ]
    usable = F.coalesce(F.col("_is_plain"), F.lit(False))
    for n in names:
        usable = usable | F.col(f"_literal.{n}").isNotNull()
    return parsed.select(*chosen, F.when(~usable, F.col(column)).alias(CORRUPT), *places)


def refuse_corrupt(records: DataFrame) -> DataFrame:
    """The records without ``_corrupt``; a line that could not be read is an error that shows its beginning."""
    error = F.raise_error(F.concat(F.lit("unreadable record: "), F.substring(CORRUPT, 1, 200)))
    fine = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(error.cast("boolean"))
    return records.where(fine).drop(CORRUPT)


def corrupt_lines(records: DataFrame) -> DataFrame:
    """The lines of a placed record table that are no record: where each stands, why, and its bytes."""
    return records.where(F.col(CORRUPT).isNotNull()).select(
        *PLACE, F.lit(NO_RECORD).alias("reason"), F.col(CORRUPT).cast("binary").alias("raw")
    )


def read_qa_records(spark: SparkSession, pattern: str) -> DataFrame:
    """Records of all matching text files, plain or compressed."""
    return parse_qa_lines(spark.read.option("lineSep", "\n").text(pattern))
