"""Small column functions: null handling, parsing, arrays, JSON, arithmetic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp formats of the sources.
INSTANT_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
INSTANT_UTC_OFFSET = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
INSTANT_ANY_OFFSET = "yyyy-MM-dd'T'HH:mm:ssxx"
WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"
DATE_ONLY = "yyyy-MM-dd"
DATE_US = "M/d/yyyy"


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def strip_spaces(c: Column) -> Column:
    return F.translate(c, " ", "")


def coalesce_default(c: Column, default=0) -> Column:
    return F.coalesce(c, F.lit(default))


def safe_int(c: Column) -> Column:
    return c.try_cast("int")


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def parse_instant(c: Column, fmt: str = INSTANT_Z) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def strip_currency(c: Column) -> Column:
    return F.regexp_replace(c, "[$\n]", "")


def array_first(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


def array_joined(c: Column, separator: str = "-") -> Column:
    return F.array_join(c, separator)


def array_has(c: Column, value: str) -> Column:
    return F.array_contains(c, value)


def cardinality_ok(c: Column) -> Column:
    """True when the array has at least one element (a NULL array passes, as a CHECK would)."""
    return F.coalesce(F.size(c) > 0, F.lit(True))


def json_length(c: Column) -> Column:
    return F.json_array_length(c)


def json_object(fields: Mapping[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def json_field(c: Column, *path: str) -> Column:
    """Text of a (nested) JSON field; keys may hold dots."""
    return F.get_json_object(c, "$" + "".join(f"['{p}']" for p in path))


def relative_difference(a: Column, b: Column) -> Column:
    return F.try_divide(F.abs(a - b), b)


def age_factor(model_year: Column, as_of: Column, exponent: float = -0.06) -> Column:
    """Trade-value factor that falls with the age of the vehicle."""
    return F.power(F.year(as_of) - model_year + 2, F.lit(exponent))


def contains_text(haystack: Column, needle: Column) -> Column:
    return F.lower(haystack).contains(F.lower(needle))


def overdue_by(last_run: Column, frequency_seconds: Column, now: Column) -> Column:
    """1 when more than ``frequency`` has passed since ``last_run``, else 0."""
    waited = F.unix_seconds(now) - F.unix_seconds(last_run)
    return F.when(waited > frequency_seconds, 1).otherwise(0)
