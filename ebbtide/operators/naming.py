"""Names of nested columns, and values as the screens show them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.times import iso_time

#: Labels of the fill status, and the zone of displayed times.
FILL_LABELS = {"confirmed_filled": "明确招满", "suspected_filled": "疑似招满"}
NOT_FILLED_LABEL, NOTHING, ZONE = "未招满", "-", "Asia/Shanghai"


def camel(name: str) -> str:
    return re.sub("_([a-z])", lambda m: m[1].upper(), name)


def snake(name: str) -> str:
    return re.sub("[A-Z]", lambda m: "_" + m[0].lower(), name)


def renamed_type(kind: T.DataType, rule: Callable[[str], str]) -> T.DataType:
    """The type with the names of all its fields made anew; two fields of one new name are an error."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(renamed_type(kind.elementType, rule), kind.containsNull)
    if isinstance(kind, T.MapType):  # keys are data
        return T.MapType(renamed_type(kind.keyType, rule), renamed_type(kind.valueType, rule), kind.valueContainsNull)
    if not isinstance(kind, T.StructType):
        return kind
    names = [rule(n) for n in kind.names]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"more than one field would be named {', '.join(twice)}")
    return T.StructType([T.StructField(n, renamed_type(f.dataType, rule), f.nullable) for n, f in zip(names, kind.fields, strict=True)])


def renamed(df: DataFrame, rule: Callable[[str], str] = camel) -> DataFrame:
    """All columns and nested fields renamed: one cast a column, no value is rebuilt."""
    kind = renamed_type(df.schema, rule)
    return df.select(*[F.col(f"`{old.name}`").cast(new.dataType).alias(new.name) for old, new in zip(df.schema.fields, kind.fields, strict=True)])


def as_percent(score: Column) -> Column:
    return F.when(score.isNull() | F.isnan(score.cast("double")), NOTHING).otherwise(F.concat(F.round(score * 100).cast("long").cast("string"), F.lit("%")))


def fill_label(status: Column) -> Column:
    out = F.lit(NOT_FILLED_LABEL)
    for name, label in FILL_LABELS.items():
        out = F.when(status == name, label).otherwise(out)
    return out


def day_label(pt: Column) -> Column:
    """20260420 as 2026-04-20, a pair of days with a tilde between them, other names as they are."""
    dashed = lambda text: F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    pair = F.concat_ws(" ~ ", dashed(F.substring(pt, 1, 8)), dashed(F.substring(pt, 10, 8)))
    return F.when(pt.rlike(r"^\d{8}_\d{8}$"), pair).otherwise(dashed(pt))


def time_label(text: Column) -> Column:
    """A local time as it is, one with a zone in local time, others unchanged; a dash for none."""
    bare = F.trim(text)
    local = F.convert_timezone(F.current_timezone(), F.lit(ZONE), iso_time(bare).cast("timestamp_ntz"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", NOTHING)
        .when(bare.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), bare)
        .otherwise(F.coalesce(F.date_format(local, "yyyy/M/d HH:mm:ss"), text))
    )


def allow_list(raw: Column, lower: bool = False) -> Column:
    """The items of a comma list: trimmed, without blanks, each once, in order."""
    items = F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda x: F.lower(F.trim(x)) if lower else F.trim(x))
    return F.array_distinct(F.filter(items, lambda x: x != ""))
