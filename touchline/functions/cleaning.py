"""Config-driven typing of raw staging columns.

A config maps column names to ``int``, ``float``, ``string``, ``bool``, ``date`` or ``json``; columns it
does not name are kept as JSON text. The rules are plain Column expressions, so cleaning any number of
columns is one projection.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import strict_day

NO_BREAK_SPACE = "\u00a0"
TYPES = ("int", "float", "string", "bool", "date", "json")


def load_config(path: str) -> dict[str, str]:
    """The name-to-type mapping of a small JSON file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def _whole_number(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    if not _is_text(kind):
        return F.coalesce(source.try_cast("bigint"), F.lit(0).cast("bigint")), F.lit(False)
    text = F.trim(source)
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    given = source.isNotNull() & (source != "")
    return F.coalesce(number, F.lit(0).cast("bigint")), given & number.isNull()


def _decimal_number(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    if not _is_text(kind):
        return F.nanvl(F.coalesce(source.try_cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(False)
    text = F.replace(F.replace(source, F.lit(","), F.lit(".")), F.lit(NO_BREAK_SPACE), F.lit(""))
    # A cast also reads Java's "1d" and "1f".
    number = F.when(~text.rlike(r"[\d.][dDfF]\s*$"), text.try_cast("double"))
    given = source.isNotNull() & (source != "")
    return F.coalesce(number, F.lit(0.0)), given & number.isNull()


def _text(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    return source.cast("string"), F.lit(False)


def _truth(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    if isinstance(kind, T.BooleanType):
        return source, F.lit(False)
    if _is_text(kind):
        return source != "", F.lit(False)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        source = F.when(~F.isnan(source), source)
    return source != 0, F.lit(False)


def _day(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    if not _is_text(kind):
        return source.cast("date"), F.lit(False)
    day = strict_day(source)
    given = source.isNotNull() & (source != "")
    return day, given & day.isNull()


def _json(source: Column, kind: T.DataType) -> tuple[Column, Column]:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        document = F.to_json(source)
    else:
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            source = F.when(~F.isnan(source), source)
        # to_json takes no scalars: quote inside a one-element array and drop the brackets.
        listed = F.to_json(F.array(source))
        document = F.when(source.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))
    return F.coalesce(document, F.lit('""')), F.lit(False)


_RULES = {
    "int": _whole_number,
    "float": _decimal_number,
    "string": _text,
    "bool": _truth,
    "date": _day,
    "json": _json,
}


def _typed(df: DataFrame, config: Mapping[str, str]) -> list[tuple[str, Column, Column]]:
    typed = []
    for field in df.schema.fields:
        rule = _RULES.get(config.get(field.name, "json"), _json)
        value, bad = rule(F.col(f"`{field.name}`"), field.dataType)
        typed.append((field.name, value, bad))
    return typed


def clean(df: DataFrame, config: Mapping[str, str]) -> DataFrame:
    """Every column coerced by its rule; unreadable cells take the rule's default."""
    return df.select(*[value.alias(name) for name, value, _ in _typed(df, config)])


def mark_rejects(df: DataFrame, config: Mapping[str, str], name: str = "rejected") -> DataFrame:
    """The raw rows plus the array of column names whose cell the rules cannot read."""
    flags = [F.when(bad, F.lit(column)) for column, _, bad in _typed(df, config)]
    return df.withColumn(name, F.array_compact(F.array(*flags)))


def split_rejects(df: DataFrame, config: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined raw rows with the names of the failing columns)."""
    marked = mark_rejects(df, config)
    good = marked.where(F.size("rejected") == 0).drop("rejected")
    return clean(good, config), marked.where(F.size("rejected") > 0)


def reject_counts(df: DataFrame, config: Mapping[str, str]) -> DataFrame:
    """Rows rejected per column."""
    return (
        mark_rejects(df, config)
        .select(F.explode("rejected").alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_rejected"))
    )
