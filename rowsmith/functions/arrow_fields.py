"""The field rules of the text readers over Arrow arrays, for rows that are made in Python tasks.

The same rules as the column expressions of ``functions.text``: ``String.split`` with its trailing-empty rule, the blank
line, ``Long`` / ``Double`` / ``Boolean`` parsing and the text of a cell. All of it is vectorised but for a delimiter
that is a real regex and for doubles in an unusual spelling.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from rowsmith.functions.text import literal_char

BLANK = r"\A[\x00-\x20]*\z"
_LONG = r"\A[+-]?[0-9]+\z"
_PLAIN_DOUBLE = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_JAVA_DOUBLE = re.compile(
    r"[\x00-\x20]*([+-]?)(?:(NaN|Infinity)|(0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?"
    r"|((?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[fFdD]?)[\x00-\x20]*"
)


def not_blank(lines: pa.Array) -> pa.Array:
    """The lines that are not empty after ``trim``."""
    return lines.filter(pc.invert(pc.match_substring_regex(lines, BLANK)))


def _cut(line: str, delimiter: re.Pattern) -> list[str]:
    """``String.split`` on a regex: no leading field for an empty match at the start, trailing empty ones are dropped later."""
    out, at = [], 0
    for m in delimiter.finditer(line):
        if m.end() == 0:
            continue
        if m.start() == m.end() == len(line):
            break
        out.append(line[at : m.start()])
        at = m.end()
    return [*out, line[at:]]


class Fields:
    """Lines split at a delimiter (Java syntax for one character, else a regex of Python's ``re``): ``field(i)`` gives column i."""

    def __init__(self, lines: pa.Array, delimiter: str):
        one = literal_char(delimiter)
        if one is not None:
            parts = pc.split_pattern(lines, pattern=one)
        else:
            pattern = re.compile(delimiter)
            parts = pa.array([_cut(x, pattern) for x in lines.to_pylist()], pa.list_(pa.string()))
        self.flat = parts.flatten()
        starts = np.asarray(parts.offsets)
        starts = starts - starts[0] if len(starts) else np.zeros(1, np.int64)
        self.first = starts[:-1].astype(np.int64)
        # a field exists if it or a later one is not empty; an empty line, kept by no reader, would be one empty field
        filled = pc.greater(pc.binary_length(self.flat), 0).to_numpy(zero_copy_only=False)
        place = np.where(filled, np.arange(1, len(self.flat) + 1), 0)
        last = np.maximum.reduceat(place, self.first) if len(self.first) else self.first
        self.count = np.maximum(last - self.first, 0)

    def field(self, i: int) -> pa.Array:
        missing = self.count <= i
        return self.flat.take(pa.array(np.where(missing, 0, self.first + i), mask=missing))


def _fail(kind: str, name: str, value: str) -> None:
    raise ValueError(f"{kind} field '{name}' cannot parse: {value}")


def parse_longs(values: pa.Array, name: str) -> pa.Array:
    """``Long.parseLong``: an optional sign and ASCII digits, within 64 bits; anything else fails."""
    bad = pc.invert(pc.match_substring_regex(values, _LONG))
    at = pc.index(bad, True).as_py()
    if at >= 0:
        _fail("BIGINT", name, values[at].as_py())
    try:
        return pc.replace_substring_regex(values, r"\A\+", "").cast(pa.int64())
    except pa.ArrowInvalid:
        worst = max((v for v in values.to_pylist() if v is not None), key=lambda v: abs(int(v)))
        _fail("BIGINT", name, worst)


def java_double(text: str) -> float | None:
    """``Double.parseDouble``; None for what it refuses."""
    m = _JAVA_DOUBLE.fullmatch(text)
    if m is None:
        return None
    sign, named, hexed, plain = m.groups()
    value = float(named.lower()) if named else float.fromhex(hexed) if hexed else float(plain)
    return -value if sign == "-" else value


def parse_doubles(values: pa.Array, name: str) -> pa.Array:
    plain = pc.match_substring_regex(values, _PLAIN_DOUBLE)
    if pc.all(plain, skip_nulls=True).as_py() in (True, None):
        return pc.replace_substring_regex(values, r"\A\+", "").cast(pa.float64())
    out = []
    for v in values.to_pylist():
        x = None if v is None else java_double(v)
        if v is not None and x is None:
            _fail("DOUBLE", name, v)
        out.append(x)
    return pa.array(out, pa.float64())


def typed(values: pa.Array, field: T.StructField, null_value: str | None) -> pa.Array:
    """A column of field texts under the declared type (string, bigint, boolean or double)."""
    if null_value is not None:
        values = pc.if_else(pc.equal(values, null_value), pa.scalar(None, pa.string()), values)
    if isinstance(field.dataType, T.StringType):
        return values
    if isinstance(field.dataType, T.LongType):
        return parse_longs(values, field.name)
    if isinstance(field.dataType, T.BooleanType):
        return pc.equal(pc.utf8_lower(values), "true")
    return parse_doubles(values, field.name)


# ---- cells as text


def double_text(x: float) -> str:
    """A double as the JVM writes it: 1.0, 1.0E10, NaN, Infinity."""
    if 0.001 <= x < 1e7 or -1e7 < x <= -0.001:
        return repr(x)  # both write the shortest digits, here without an exponent
    if x != x:
        return "NaN"
    if x in (float("inf"), float("-inf")):
        return "Infinity" if x > 0 else "-Infinity"
    sign, digits, exponent = ("-" if str(x).startswith("-") else ""), *_digits(abs(x))
    if digits == "0":
        return f"{sign}0.0"
    if -3 <= exponent < 7:  # the value lies in [0.001, 10,000,000)
        if exponent < 0:
            return f"{sign}0.{'0' * (-exponent - 1)}{digits}"
        whole = digits[: exponent + 1].ljust(exponent + 1, "0")
        return f"{sign}{whole}.{digits[exponent + 1 :] or '0'}"
    return f"{sign}{digits[0]}.{digits[1:] or '0'}E{exponent}"


def _digits(x: float) -> tuple[str, int]:
    """The shortest decimal digits of x >= 0 and the power of ten of the first."""
    mantissa, _, power = f"{x!r}".partition("e")
    whole, _, part = mantissa.partition(".")
    digits = (whole + part).lstrip("0")
    leading = len(whole + part) - len(digits)
    digits = digits.rstrip("0") or "0"
    return digits, len(whole) - 1 - leading + int(power or 0)


def cell_texts(values: pa.Array) -> pa.Array:
    """The cells of a column as text, nulls as ``NULL``."""
    t = values.type
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        out = values.cast(pa.string())
    elif pa.types.is_boolean(t) or pa.types.is_integer(t) or pa.types.is_date32(t):
        out = values.cast(pa.string())
    elif pa.types.is_float64(t):
        out = pa.array([None if x is None else double_text(x) for x in values.to_pylist()], pa.string())
    else:
        raise ValueError(f"cells of type {t} can't be written: cast the column to string first")
    return pc.fill_null(out, "NULL")
