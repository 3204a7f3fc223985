"""Replies of a language model: code fences, parsing, and validation against a declared shape."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    kind: str  # boolean, double, long, string, strings
    nullable: bool = False
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None


# The enumerations, and the shapes of the three replies.
TEMPORAL_STATUS = ("has_signal", "no_signal", "cannot_determine", "conflict")
SIGNAL_TYPES = ("absolute_datetime", "date_range", "relative_time", "duration_only", "holiday_window", "vague_time", "no_signal", "conflict")
ANCHOR_TYPES = ("publish_time", "message_time", "call_time", "unknown")
VALIDITY_TYPES = ("exact_date", "fuzzy_time", "no_validity")
DETECTION = {
    "has_temporal_signal": Field("boolean"), "temporal_status": Field("string", values=TEMPORAL_STATUS), "signal_type": Field("string", values=SIGNAL_TYPES),
    "evidence_summary": Field("strings"), "confidence": Field("double", low=0, high=1), "cannot_determine_reason": Field("string", True),
}
NORMALISATION = {
    "normalizable": Field("boolean"), "anchor_type": Field("string", values=ANCHOR_TYPES), "work_start_at": Field("string", True), "recruitment_valid_until": Field("string", True),
    "duration_hours": Field("long", True, low=0), "interpretation": Field("string"), "confidence": Field("double", low=0, high=1),
}
DECISION = {"validity_type": Field("string", values=VALIDITY_TYPES), "estimated_expiry": Field("string", True), "reason": Field("string"), "low_confidence": Field("boolean")}


DEFAULTS = {"temporal_status": "no_signal", "signal_type": "no_signal", "anchor_type": "unknown", "validity_type": "no_validity"}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What is made of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without_fence(text: Column) -> Column:
    def bare(text: Column) -> Column:
        inner = F.regexp_replace(F.regexp_replace(text, r"^```[^\n]*\n?", ""), r"(?s)\n?[^\n]*```$", "")
        return F.when(text.startswith("```") & text.endswith("```"), F.regexp_replace(inner, r"(?U)^\s+|\s+$", "")).otherwise(text)

    return _once(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), bare)


def strict_json(text: Column) -> Column:
    """The value of a text that is one JSON value and nothing else; null for others.

    Spark's parser stops at the end of the first value, so the text is parsed within brackets and
    within braces: what closes one of them early is broken in the other."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = lambda x: F.when(named.isNotNull() & F.try_variant_get(x, "$[1]", "variant").isNull(), F.try_variant_get(x, "$[0]", "variant"))
    return _once(listed, lambda x: F.when(x.isNotNull(), alone(x)))


_VARIANT = {"boolean": ("BOOLEAN",), "string": ("STRING",), "double": ("BIGINT", "DOUBLE", "DECIMAL"), "long": ("BIGINT",), "strings": ("ARRAY<STRING>", "ARRAY<VOID>")}
_TYPE = {"boolean": "boolean", "string": "string", "double": "double", "long": "bigint", "strings": "array<string>"}


def shape_errors(text: Column, shape: dict[str, Field], parsed: Column | None = None) -> Column:
    """Names of fields that are unknown, of the wrong type, out of range or not among the values.
    ``parsed``: the text's value, where it is known."""
    extra = F.filter(F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")), lambda k: ~k.isin(*shape))

    def wrong(parsed: Column, name: str, f: Field) -> Column:
        value = F.try_variant_get(parsed, f"$.{name}", _TYPE[f.kind])

        def good(kind: Column) -> Column:
            fits = F.lit(False)
            for k in _VARIANT[f.kind]:
                fits = fits | kind.startswith(k)
            if f.values:
                fits = fits & value.isin(*f.values)
            if f.low is not None:
                fits = fits & (value >= f.low)
            if f.high is not None:
                fits = fits & (value <= f.high)
            return kind.isNull() | ((kind == "VOID") & F.lit(f.nullable)) | F.coalesce(fits, F.lit(False))

        return _once(F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant")), lambda kind: F.when(~good(kind), F.lit(name)))

    found = lambda parsed: F.filter(F.array(*(wrong(parsed, name, f) for name, f in shape.items())), lambda x: x.isNotNull())
    return F.concat(extra, _once(F.try_parse_json(text), found) if parsed is None else found(parsed))


def reply_error(text: Column, shape: dict[str, Field]) -> Column:
    """Null, parse_error or schema_validation_error."""

    def error(body: Column, parsed: Column) -> Column:
        is_object = F.schema_of_variant(parsed).startswith("OBJECT")
        return (
            F.when((body == "") | parsed.isNull(), F.lit("parse_error"))
            .when(~is_object | (F.size(shape_errors(body, shape, parsed)) > 0), F.lit("schema_validation_error"))
        )

    return _once(without_fence(F.coalesce(text, F.lit(""))), lambda body: _once(strict_json(body), lambda parsed: error(body, parsed)))


def reply_struct(text: Column, shape: dict[str, Field]) -> Column:
    """The reply's fields, for replies without error."""
    defaults = {"boolean": F.lit(False), "double": F.lit(0.0), "long": F.lit(0), "strings": F.array().cast("array<string>")}

    def fields(parsed: Column) -> Column:
        out = []
        for name, f in shape.items():
            value = F.try_variant_get(parsed, f"$.{name}", _TYPE[f.kind])
            default = F.lit(DEFAULTS.get(name, "")) if f.kind == "string" else defaults.get(f.kind)
            out.append((value if f.nullable else F.coalesce(value, default)).alias(name))
        return F.struct(*out)

    return _once(F.try_parse_json(without_fence(F.coalesce(text, F.lit("")))), fields)
