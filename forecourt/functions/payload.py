"""JSON payloads: pack rows into them, read typed columns out of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions import scalars as S

UUID_SHAPE = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
LOCAL_ZONE = "America/Toronto"


def as_uuid(c: Column) -> Column:
    return F.when(F.lower(c).rlike(UUID_SHAPE), F.lower(c))


def _json(c: Column) -> Column:
    return F.when(F.try_parse_json(c).isNotNull(), c)


def _offset_instant(c: Column) -> Column:
    # Offsets come as -0500, -05:00 or Z; the separator may be a blank or a T.
    iso = F.regexp_replace(c, r"^(\S+) ", "$1T")
    return F.coalesce(
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssxx")),
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX")),
    )


def _local_instant(c: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_utc_timestamp(c.try_cast("timestamp_ntz"), zone)


# Rule name -> typed column. The input is the field text with '' already NULL.
RULES: dict[str, Callable[[Column], Column]] = {
    "text": lambda c: c,
    "int": lambda c: c.try_cast("int"),
    "numeric": lambda c: c.try_cast("decimal(38,9)"),
    "double": lambda c: c.try_cast("double"),
    "cents": lambda c: c.try_cast("double") / 100,
    "boolean": lambda c: c.try_cast("boolean"),
    "uuid": as_uuid,
    "json": _json,
    "ts_offset": _offset_instant,
    "ts_local": _local_instant,
    "ts_plain": lambda c: F.try_to_timestamp(c, F.lit(S.WALL_CLOCK)),
    "date_us": lambda c: F.try_to_timestamp(c, F.lit(S.DATE_US)),
    "ts_day_text": lambda c: F.try_to_timestamp(c, F.lit(S.DATE_ONLY)).cast("string"),
    "strip_spaces": S.strip_spaces,
    "unescape_json": lambda c: _json(F.replace(c, F.lit('"\\'), F.lit(""))),
}

# Rule name -> whether a value that fits would lose digits. ``numeric`` holds nine decimals.
LOSES: dict[str, Callable[[Column], Column]] = {
    "numeric": lambda c: F.coalesce(c.try_cast("decimal(38,9)") != c.try_cast("decimal(38,20)"), F.lit(False)) | c.rlike(r"\.\d{9}\d*[1-9]"),
}


def _misfit(rule: str, raw: Column, value: Column) -> Column:
    """A non-empty value that does not fit its rule, or not all of it."""
    bad = raw.isNotNull() & value.isNull()
    return bad | F.coalesce(LOSES[rule](raw), F.lit(False)) if rule in LOSES else bad


@dataclass(frozen=True)
class Field:
    key: str
    out: str
    rule: str = "text"


@dataclass(frozen=True)
class ViewSpec:
    """Envelope columns to keep and payload fields to read, in output order."""

    envelope: tuple[str, ...]
    fields: tuple[Field, ...]


def parse_fields(text: str, prefix: str = "") -> tuple[Field, ...]:
    """Read ``key[:rule][=out]`` words; ``out`` defaults to the lower-case key after its last dot."""
    fields = []
    for word in text.split():
        head, _, out = word.partition("=")
        key, _, rule = head.partition(":")
        key = key if "." in key or not prefix else f"{prefix}.{key}"
        fields.append(Field(key, out or key.rsplit(".", 1)[-1].lower(), rule or "text"))
    return tuple(fields)


def pack_payload(df: DataFrame, keep: Iterable[str], out: str = "payload") -> DataFrame:
    """Keep the key columns; all others become one JSON object, non-JSON types as text."""
    keep = list(keep)
    rest = [f for f in df.schema.fields if f.name not in keep]
    plain = (T.StringType, T.NumericType, T.BooleanType, T.StructType, T.ArrayType, T.MapType)
    packed = [
        (F.col(f"`{f.name}`") if isinstance(f.dataType, plain) else F.col(f"`{f.name}`").cast("string")).alias(f.name)
        for f in rest
    ]
    body = F.to_json(F.struct(*packed), {"ignoreNullFields": "false"}) if packed else F.lit("{}")
    return df.select(*[F.col(f"`{k}`") for k in keep], body.alias(out))


def field_text(parsed: Column, key: str) -> Column:
    return S.null_if_empty(parsed.getField(key))


def parse_payload(payload: Column, keys: Iterable[str]) -> Column:
    """Parse only ``keys``, each as text (nested values keep their JSON text)."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in dict.fromkeys(keys)])
    return F.from_json(payload, schema)


def typed_view(
    df: DataFrame,
    spec: ViewSpec,
    payload: str = "payload",
    remaps: Mapping[str, Mapping[str, str]] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Typed columns of a landing table. A value that does not fit its rule is NULL.

    A ``numeric`` of more than nine decimals is rounded; ``count_rejects`` counts it.

    ``remaps`` replaces constant values of an output column. ``strict`` fails
    on the first value that does not fit or loses digits.
    """
    remaps = remaps or {}
    parsed = df.select(*spec.envelope, parse_payload(F.col(payload), [f.key for f in spec.fields]).alias("_p"))
    columns = []
    for f in spec.fields:
        raw = field_text(F.col("_p"), f.key)
        value = RULES[f.rule](raw)
        if strict:
            message = F.concat(F.lit(f"{f.key} is not {f.rule}: "), raw)
            value = F.when(_misfit(f.rule, raw, value), F.raise_error(message)).otherwise(value)
        if f.out in remaps:
            value = remap(value, remaps[f.out])
        columns.append(value.alias(f.out))
    return parsed.select(*spec.envelope, *columns)


def count_rejects(df: DataFrame, spec: ViewSpec, payload: str = "payload") -> DataFrame:
    """Per field: how many non-empty values did not fit their rule or lost digits. One pass, one row per field."""
    parsed = df.select(parse_payload(F.col(payload), [f.key for f in spec.fields]).alias("_p"))
    bad = []
    for f in spec.fields:
        raw = field_text(F.col("_p"), f.key)
        bad.append(F.count_if(_misfit(f.rule, raw, RULES[f.rule](raw))).alias(f.out))
    counts = parsed.agg(*bad)
    pairs = F.array(*[F.struct(F.lit(f.out).alias("field"), F.col(f"`{f.out}`").alias("rejects")) for f in spec.fields])
    return counts.select(F.inline(pairs))


def remap(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, keep all others."""
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def has_key(payload: Column, key: str) -> Column:
    """True when the JSON object has the key at all, even with a JSON null."""
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def add_key(payload: Column, key: str, value: Column) -> Column:
    """Append ``key: value`` to a JSON object; all other fields keep their exact text."""
    entry = F.regexp_replace(F.to_json(F.create_map(F.lit(key), value)), r"^\{", "")
    body = F.regexp_replace(payload, r"\s*\}\s*$", "")
    return F.concat(body, F.when(body.rlike(r"^\s*\{$"), F.lit("")).otherwise(F.lit(",")), entry)


def json_uuid(payload: Column, key: str) -> Column:
    """Untyped quick read of one field as a UUID; a value of another shape is NULL."""
    return as_uuid(S.json_field(payload, key))
