"""Tolerant JSON reading and canonical writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.functions.text import col


def parse_once(df: DataFrame, body: str, ddl: str, name: str) -> DataFrame:
    """Replace a JSON text column by its parsed struct ``name``.

    The struct passes through a one-element explode: filters on its fields then
    stay above it instead of being pushed below with a second parse of the text.
    """
    keep = [c for c in df.columns if c != body]
    return df.select(*keep, F.explode(F.array(F.from_json(body, ddl))).alias(name))


def json_or_empty(c) -> Column:
    """Variant of a JSON text; broken or missing text is the empty object."""
    return F.coalesce(F.try_parse_json(col(c)), F.parse_json(F.lit("{}")))


def field_or(variant, path: str, type_name: str, default) -> Column:
    """Value at ``path`` of a variant, or ``default`` when absent or of another type."""
    got = F.try_variant_get(col(variant), path, type_name)
    return F.coalesce(got, default if isinstance(default, Column) else F.lit(default))


def canonical_json(value) -> Column:
    """JSON of a map, struct or array with the keys of all its objects in order and no blanks."""
    return F.to_json(F.parse_json(F.to_json(col(value), {"ignoreNullFields": "false"})))


def is_truthy_json(text) -> Column:
    """False for empty text and for JSON null, false, zero, "" and empty containers."""
    text = col(text)
    parsed = F.try_parse_json(text)
    compact = F.to_json(parsed)
    falsy = compact.isin("null", "false", '""', "[]", "{}") | (
        F.coalesce(F.try_variant_get(parsed, "$", "double"), F.lit(1.0)) == 0
    ) & ~F.startswith(compact, F.lit('"'))
    return F.coalesce(text != "", F.lit(False)) & (parsed.isNull() | ~falsy)


def any_match(arr, predicate) -> Column:
    """True when an element matches; a missing array has none."""
    return F.coalesce(F.exists(col(arr), predicate), F.lit(False))


def length(arr) -> Column:
    return F.coalesce(F.array_size(col(arr)), F.lit(0))


def first_n(arr, n: int) -> Column:
    return F.slice(col(arr), 1, n)
