"""Column-level building blocks (all built-in Spark expressions)."""

from rowsmith.functions.text import (
    LINE_END_REGEX,
    encode_event,
    format_line,
    is_blank,
    java_split,
    literal_char,
    parse_boolean,
    parse_double,
    parse_long,
    text_lines,
    drop_last_empty,
    tokens,
    within_limit,
)

__all__ = [
    "LINE_END_REGEX",
    "encode_event",
    "format_line",
    "is_blank",
    "java_split",
    "literal_char",
    "parse_boolean",
    "parse_double",
    "parse_long",
    "text_lines",
    "drop_last_empty",
    "tokens",
    "within_limit",
]
