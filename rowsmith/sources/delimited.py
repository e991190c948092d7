"""Folders of delimited text as typed tables.

``read_lines`` is the line scan: Spark's text source (splittable by
``spark.sql.files.maxPartitionBytes``, line-aligned across split boundaries),
file selection by a name regex on ``_metadata`` (files that do not match are
pruned before they are opened), and an optional legacy charset decoded in the
JVM. ``read_delimited`` adds the blank-line rule, the regex field split and the
typed positional projection. Catalyst prunes every field the caller does not
select, so an unused field is never parsed.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.text import is_blank, java_split
from rowsmith.operators.fields import as_schema, needed_positions, typed_fields
from rowsmith.sources.wide import read_wide_lines, wide_encoding

PARTS = "__fields"

# Charsets Spark decodes without the legacy charset flag.
STANDARD_CHARSETS = {"us-ascii", "iso-8859-1", "utf-8", "utf-16be", "utf-16le", "utf-16", "utf-32"}


def name_matches(pattern: str, on: str = "name") -> Column:
    """Whole-match of ``pattern`` against each input file's base name (or full path)."""
    target = F.col("_metadata.file_name") if on == "name" else F.col("_metadata.file_path")
    return target.rlike(f"^(?:{pattern})\\z")


@contextmanager
def _coding_errors(spark: SparkSession, encoding: str, on_bad_bytes: str):
    """Session flags for a legacy-charset decode, held while the plan is analysed."""
    # Both are captured when the decode expression is analysed: set for this plan only.
    flags = {"spark.sql.legacy.codingErrorAction": "true" if on_bad_bytes == "replace" else "false"}
    if encoding.lower() not in STANDARD_CHARSETS:
        flags["spark.sql.legacy.javaCharsets"] = "true"
    with session_flags(spark, flags):
        yield


@contextmanager
def session_flags(spark: SparkSession, flags: dict[str, str]):
    """Set session flags and put back what was there."""
    before = {k: spark.conf.get(k, None) for k in flags}
    for k, v in flags.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str = "UTF-8",
    pattern: str | None = None,
    pattern_on: str = "name",
    strip_cr: bool = False,
    on_bad_bytes: str = "fail",
    with_file: bool = False,
) -> DataFrame:
    """Lines of every file under ``path`` as ``value string``.

    ``strip_cr`` ends lines at ``\\n`` only and removes every ``\\r``;
    otherwise ``\\n``, ``\\r`` and ``\\r\\n`` all end a line. ``on_bad_bytes``:
    bytes that are no text in ``encoding`` fail the query or become U+FFFD.
    ``with_file`` adds ``file_path`` and ``file_name`` columns.
    """
    if on_bad_bytes not in ("fail", "replace"):
        raise ValueError("on_bad_bytes must be 'fail' or 'replace'")
    if wide_encoding(encoding):
        # Spark cuts lines at the bytes \n and \r, which these encodings use inside characters.
        matches = name_matches(pattern, pattern_on) if pattern else None
        return read_wide_lines(
            spark, path, encoding, matches=matches, strip_cr=strip_cr, on_bad_bytes=on_bad_bytes, with_file=with_file
        )
    reader = spark.read
    if strip_cr:
        reader = reader.option("lineSep", "\n")
    df = reader.text(path if isinstance(path, str) else list(path))
    if pattern:  # an empty pattern is the default: every file
        df = df.where(name_matches(pattern, pattern_on))
    value = F.col("value")
    decode = encoding.replace("_", "-").lower() not in ("utf-8", "utf8")
    if decode:
        value = F.decode(value.cast("binary"), encoding)
    else:
        value = F.validate_utf8(value) if on_bad_bytes == "fail" else F.make_valid_utf8(value)
    if strip_cr:
        value = F.replace(value, F.lit("\r"), F.lit(""))
    cols = [value.alias("value")]
    if with_file:
        cols += [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")]
    if not decode:
        return df.select(*cols)
    with _coding_errors(spark, encoding, on_bad_bytes):
        return df.select(*cols)


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType | str,
    *,
    columns: list[str] | None = None,
    delimiter: str = ",",
    null_value: str | None = None,
    keep: list[str] | None = None,
    line_col: str = "value",
) -> DataFrame:
    """Non-blank lines of ``lines`` as typed rows of ``schema`` (fields by position).

    ``delimiter`` is a regex (Java syntax). ``columns`` selects the needed
    fields; ``columns=[]`` gives zero-column rows, one per non-blank line,
    for counting. ``keep`` carries extra columns of ``lines`` through.
    """
    schema = as_schema(schema)
    delimiter = delimiter or ","  # empty: the default
    line = F.col(line_col)
    carried = [F.col(k) for k in (keep or [])]
    picked = needed_positions(schema, columns)
    # With an explicit column list the split stops after the last needed field.
    needed = max(i for i, _ in picked) + 1 if columns is not None and picked else None
    # The split array is its own projection: every field reads it, and
    # Catalyst does not inline a costly expression that is used more than once.
    split = lines.where(~is_blank(line)).select(*carried, java_split(line, delimiter, needed).alias(PARTS))
    fields = typed_fields(F.col(PARTS), schema, columns, null_value)
    return split.select(*carried, *fields)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    columns: list[str] | None = None,
    delimiter: str = ",",
    null_value: str | None = None,
    encoding: str = "UTF-8",
    pattern: str | None = None,
    pattern_on: str = "name",
    strip_cr: bool = False,
    on_bad_bytes: str = "fail",
    with_file: bool = False,
) -> DataFrame:
    """A folder of delimited text files as a typed table (types: string, bigint, boolean, double)."""
    schema = as_schema(schema)
    lines = read_lines(
        spark,
        path,
        encoding=encoding,
        pattern=pattern,
        pattern_on=pattern_on,
        strip_cr=strip_cr,
        on_bad_bytes=on_bad_bytes,
        with_file=with_file,
    )
    keep = ["file_path", "file_name"] if with_file else None
    return parse_delimited(lines, schema, columns=columns, delimiter=delimiter, null_value=null_value, keep=keep)
