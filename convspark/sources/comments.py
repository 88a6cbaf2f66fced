"""Comment tables, one per month: partitions of a table, or tables of their own."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.workspace import hadoop_path

# Fixed value: the months of the published data set.
MONTH_PATTERN = "^201[5678]_[01][0-9]$"

#: Number types, each of which holds the ones before it.
_WIDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def union_months(table: DataFrame, pattern: str = MONTH_PATTERN, month: str = "month") -> DataFrame:
    """Rows of all months whose name matches the pattern.

    On a table partitioned by month this prunes partitions before anything is read.
    """
    return table.where(F.col(month).rlike(pattern))


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """One type for a column that two tables have: the wider number, else text."""
    if a == b:
        return a
    ranks = [_WIDER.index(type(t)) if type(t) in _WIDER else None for t in (a, b)]
    if None in ranks:
        return T.StringType()
    wide = max(ranks)
    # a float does not hold every long
    return T.DoubleType() if _WIDER[wide] is T.FloatType else _WIDER[wide]()


def reconcile(schemas: list[T.StructType]) -> T.StructType:
    """All columns of some tables, in order of appearance, each with a type that holds all of its own."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            kinds[field.name] = _common_type(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _aligned(parts: list[DataFrame], name: str) -> DataFrame:
    common = reconcile([T.StructType([f for f in part.schema if f.name != name]) for part in parts])

    def column(part: DataFrame, field: T.StructField):
        value = F.col(f"`{field.name}`") if field.name in part.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return reduce(DataFrame.unionByName, [p.select(*[column(p, f) for f in common], name) for p in parts])


def read_tables(
    spark: SparkSession, root: str, pattern: str = MONTH_PATTERN, name: str = "month", table_format: str = "parquet"
) -> DataFrame:
    """All tables below a folder whose own folder's name matches, as one, with that name in the column ``name``.

    Only matching folders are ever opened: their names are listed first. Tables of one schema are one scan of
    many paths, so the number of scans is that of the schemas, not of the tables. A column that some tables lack
    is null there; types that differ become the wider number, or text. Raises when no name matches.
    """
    target, filesystem = hadoop_path(spark, root)
    names = sorted(s.getPath().getName() for s in filesystem.listStatus(target) if s.isDirectory())
    names = [n for n in names if re.search(pattern, n)]
    if not names:
        raise FileNotFoundError(f"no table below {root} matches {pattern}")
    by_schema: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    for n in names:
        schema = spark.read.format(table_format).load(f"{root}/{n}").schema
        schemas[schema.json()] = schema
        by_schema.setdefault(schema.json(), []).append(f"{root}/{n}")
    # paths come URL-encoded, but for the plus sign
    place = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(place, f"^.*/{re.escape(target.getName())}/([^/]+)/", 1)
    parts = [
        spark.read.schema(schemas[key]).format(table_format).load(paths).withColumn(name, folder)
        for key, paths in by_schema.items()
    ]
    return _aligned(parts, name)


def read_catalog_tables(spark: SparkSession, database: str, pattern: str = MONTH_PATTERN, name: str = "month") -> DataFrame:
    """:func:`read_tables` for the tables of a database in the session's catalog."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if re.search(pattern, t.name))
    if not names:
        raise FileNotFoundError(f"no table of {database} matches {pattern}")
    return _aligned([spark.table(f"`{database}`.`{n}`").withColumn(name, F.lit(n)) for n in names], name)
