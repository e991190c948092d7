"""Positional typed projection of split fields (the four reader types)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.text import parse_boolean, parse_double, parse_long

READER_TYPES = (T.StringType, T.LongType, T.BooleanType, T.DoubleType)


def as_schema(schema: T.StructType | str | list[tuple[str, str]]) -> T.StructType:
    """Accept a StructType, a DDL string or ``[(name, type), ...]``."""
    if isinstance(schema, T.StructType):
        return schema
    ddl = schema if isinstance(schema, str) else ", ".join(f"{n} {t}" for n, t in schema)
    parsed = T._parse_datatype_string(ddl)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"not a table schema: {ddl!r}")
    return parsed


def needed_positions(schema: T.StructType, columns: list[str] | None) -> list[tuple[int, T.StructField]]:
    """Positions and fields of the selected columns, in schema order.

    Raises ``ValueError`` for names the schema lacks and for selected
    columns whose type the readers do not parse.
    """
    names = [f.name for f in schema.fields]
    if columns is None:
        wanted = set(names)
    else:
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"columns {missing} are not in the table schema {names}")
        wanted = set(columns)
    picked = [(i, f) for i, f in enumerate(schema.fields) if f.name in wanted]
    for _, f in picked:
        if not isinstance(f.dataType, READER_TYPES):
            raise ValueError(f"column '{f.name}' is declared {f.dataType.simpleString()}: readers parse string, bigint, boolean and double")
    return picked


def typed_field(parts: Column, pos: int, field: T.StructField, null_value: str | None = None) -> Column:
    """Field ``pos`` (0-based) of the split array under the field's type; missing fields are null."""
    raw = F.get(parts, pos)
    if null_value is not None:
        raw = F.when(raw == null_value, F.lit(None).cast("string")).otherwise(raw)
    t = field.dataType
    if isinstance(t, T.StringType):
        out = raw
    elif isinstance(t, T.LongType):
        out = parse_long(raw, field.name)
    elif isinstance(t, T.BooleanType):
        out = parse_boolean(raw)
    else:
        out = parse_double(raw, field.name)
    return out.alias(field.name)


def typed_fields(
    parts: Column,
    schema: T.StructType,
    columns: list[str] | None = None,
    null_value: str | None = None,
) -> list[Column]:
    """Typed columns for the selected names, read from the split array by position."""
    return [typed_field(parts, i, f, null_value) for i, f in needed_positions(schema, columns)]
