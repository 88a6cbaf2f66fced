"""Expressions over whole examples: extra contexts, text rendering, record bytes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convspark.schema import extra_context


def quoted(name: str) -> Column:
    """Column by exact name (``context/0`` needs quoting)."""
    return F.col(f"`{name}`")


def extra_context_columns(array: Column, count: int) -> list[Column]:
    """Spread an array, nearest context first, over ``context/0 .. context/{count-1}``."""
    return [F.get(array, F.lit(i)).alias(extra_context(i)) for i in range(count)]


def extra_context_names(columns: Sequence[str]) -> list[str]:
    """The ``context/i`` columns present, in the order of i."""
    found = [c for c in columns if c.startswith("context/") and c[len("context/"):].isdigit()]
    return sorted(found, key=lambda c: int(c[len("context/"):]))


def required(examples: DataFrame) -> DataFrame:
    """The examples, where a missing context or response is an error."""
    checked = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"an example has no {c}")).cast("string")) for c in ("context", "response")
    }
    return examples.withColumns(checked)


def fixed_width(df: DataFrame, num_extra_contexts: int) -> DataFrame:
    """``context``, ``response`` and exactly n extra contexts, absent ones as the empty string.

    Only extra contexts may be absent: an example without a context or a response is an error.
    """
    df = required(df)
    present = set(df.columns)
    extras = [
        (F.coalesce(quoted(name), F.lit("")) if name in present else F.lit("")).alias(name)
        for name in map(extra_context, range(num_extra_contexts))
    ]
    return df.select("context", "response", *extras)


def mix(*example_sets: DataFrame) -> DataFrame:
    """Union of example sets of different depth and origin; missing features become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), example_sets)


def render_example(columns: Sequence[str]) -> Column:
    """One example as readable text.

    Context and response, then the extra contexts oldest first up to the first gap, then all other
    features by name. Line breaks inside a value are shown as ``\\n``.
    """

    def field(name: str, value: Column, indent: str) -> Column:
        shown = F.replace(value, F.lit("\n"), F.lit("\\n "))
        return F.concat(F.lit(f"{indent}[{name}]:\n{indent}\t"), shown, F.lit("\n"))

    def section(title: str, fields: Column) -> Column:
        body = F.array_join(fields, "")
        return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit(f"\n{title}:\n"), body))

    extras, complete = [], F.lit(True)
    for name in extra_context_names(columns):
        complete = complete & quoted(name).isNotNull()
        extras.append(F.when(complete, field(name, quoted(name), "\t")))
    others = [
        field(name, quoted(name), "\t")
        for name in sorted(columns)
        if name not in ("context", "response") and not name.startswith("context/")
    ]
    empty = F.array().cast("array<string>")
    return F.concat(
        field("Context", F.col("context"), ""),
        field("Response", F.col("response"), ""),
        section("Extra Contexts", F.array(*reversed(extras)) if extras else empty),
        section("Other features", F.array(*others) if others else empty),
    )


def _byte(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("long")), 2, "0"))


def _varint(n: Column) -> Column:
    """Base-128 variable-length integer of a byte count (below 2**31)."""

    def encoded(groups: int) -> Column:
        shifted = [F.shiftright(n, 7 * i) for i in range(groups)]
        return F.concat(
            *[_byte((s % 128) + 128) for s in shifted[:-1]],
            _byte(shifted[-1]),
        )

    out = encoded(5)
    for groups in (4, 3, 2, 1):
        out = F.when(n < 2 ** (7 * groups), encoded(groups)).otherwise(out)
    return out


def _delimited(tag: str, payload: Column) -> Column:
    return F.concat(F.unhex(F.lit(tag)), _varint(F.octet_length(payload)), payload)


def serialize_example(columns: Sequence[str]) -> Column:
    """The example as a serialized ``tf.train.Example``: one single-value bytes list per feature.

    Null features are left out. Features are written in the order of their names, so equal rows
    give equal bytes. Higher-order functions bind each nesting level once.
    """
    first, second = "0A", "12"  # protobuf tags: field 1 and field 2, length delimited
    features = F.filter(
        F.array(
            *[
                F.struct(F.lit(name).cast("binary").alias("key"), quoted(name).cast("binary").alias("value"))
                for name in sorted(columns)
            ]
        ),
        lambda f: f["value"].isNotNull(),
    )

    def nest(column: Column, tag: str) -> Column:
        return F.transform(
            column, lambda f: F.struct(f["key"].alias("key"), _delimited(tag, f["value"]).alias("value"))
        )

    bytes_list = nest(features, first)
    feature = nest(bytes_list, first)
    entry = F.transform(feature, lambda f: F.concat(_delimited(first, f["key"]), _delimited(second, f["value"])))
    entries = F.transform(entry, lambda e: _delimited(first, e))
    joined = F.aggregate(entries, F.lit(b""), lambda acc, e: F.concat(acc, e))
    # a one-element array binds the joined bytes, so they are built once and not once per use
    return F.get(F.transform(F.array(joined), lambda m: _delimited(first, m)), F.lit(0))
