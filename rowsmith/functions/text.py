"""Column expressions for the line and field rules of the text readers.

The readers follow the JVM string rules: ``String.split`` with a regex
delimiter, ``BufferedReader.readLine`` line ends, ``String.trim`` blank
detection and the ``Long`` / ``Double`` / ``Boolean`` parse functions. Every
rule here is a built-in Spark expression, so it stays inside whole-stage
codegen (the general-regex field split is the one place that falls back to an
interpreted higher-order function).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The line ends ``readLine`` accepts, in the order they must be
# tried, and the characters that make a delimiter a real regex.
LINE_END_REGEX = "\r\n|\n|\r"
REGEX_META = ".$|()[]{}^?*+\\"


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_char(regex: str) -> str | None:
    """The one character a delimiter regex stands for, or None for a real pattern.

    ``","`` -> ``","``; ``"\\|"`` -> ``"|"``; ``"\\t"`` -> tab; ``"[,;]"`` -> None.
    """
    if len(regex) == 1 and regex not in REGEX_META:
        return regex
    if len(regex) == 2 and regex[0] == "\\":
        if regex[1] in REGEX_META:
            return regex[1]
        if regex[1] == "t":
            return "\t"
    return None


def java_split(c: ColumnOrName, regex: str, needed: int | None = None) -> Column:
    """``String.split(regex)``: trailing empty fields are dropped, ``''`` gives ``['']``.

    Spark's ``split`` keeps trailing empties, so they are cut off here. For a
    one-character delimiter that is ``rtrim`` of the delimiter before
    splitting (codegen only); for a general regex the position of the last
    non-empty field is found with ``transform``.

    ``needed``: only fields ``0 .. needed - 1`` will be read. With a
    one-character delimiter the split then stops after field ``needed``: once
    trailing delimiters are trimmed, the leading fields and whether they exist
    are the same as in the full split, and a wide line is not cut up to its end.
    """
    c = _col(c)
    ch = literal_char(regex)
    if ch is not None:
        body = F.rtrim(c, F.lit(ch))
        limit = -1 if needed is None else needed + 1
        return (
            F.when(c == "", F.array(F.lit("")))
            .when(body == "", _empty_strings())
            .otherwise(F.split(body, regex, limit))
        )

    def cut(parts: Column) -> Column:
        keep = F.array_max(F.transform(parts, lambda e, i: F.when(e != "", i + 1).otherwise(0)))
        return F.slice(parts, 1, F.coalesce(keep, F.lit(0)))

    # A one-element array binds the parts, so the regex runs once a value.
    bound = F.get(F.transform(F.array(F.split(c, regex, -1)), cut), F.lit(0))
    return F.when(c == "", F.array(F.lit(""))).otherwise(bound)


def text_lines(c: ColumnOrName) -> Column:
    """Lines of a whole-file text as ``readLine`` returns them.

    Line ends are ``\\n``, ``\\r`` and ``\\r\\n``; a final line end does not
    open an empty last line; an empty text has no lines.
    """
    return drop_last_empty(F.split(_col(c), LINE_END_REGEX, -1))


def drop_last_empty(parts: Column) -> Column:
    """Drop a final empty element (what a trailing line end leaves after a split)."""
    n = F.size(parts)
    return F.when(F.get(parts, n - 1) == "", F.slice(parts, 1, n - 1)).otherwise(parts)


def is_blank(c: ColumnOrName) -> Column:
    """The blank-line test of the readers.

    True when the line is empty after ``String.trim`` (every char <= U+0020),
    or starts with a carriage return or line feed. (``\\z``, not ``$``: in Java ``$``
    also matches before a final U+0085, U+2028 or U+2029, which ``trim`` keeps.)
    """
    return _col(c).rlike("^(?:[\\r\\n]|[\\x00-\\x20]*\\z)")


def tokens(c: ColumnOrName) -> Column:
    """``line.split(" ")``: one literal space; ``''`` is one empty word, all-space lines none."""
    return java_split(c, " ")


def _ansi() -> bool:
    """Whether the active session casts under ANSI rules (bad text fails instead of giving null)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    try:
        return spark is not None and spark.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"
    except Exception:  # noqa: BLE001
        return False


def _trimmed_end(c: Column) -> Column:
    """First or last char is one Spark's numeric cast trims (U+0000..U+0020, U+007F); true for ''."""
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    return (first <= F.lit(" ")) | (first == F.lit("\x7f")) | (last <= F.lit(" ")) | (last == F.lit("\x7f"))


def parse_long(c: ColumnOrName, name: str = "field") -> Column:
    """``Long.parseLong``: optional sign and ASCII digits only; anything else fails the task.

    Under ANSI rules the cast already fails on everything ``parseLong``
    refuses except surrounding control chars and spaces, which it trims; so
    only the two end chars are checked (no regex per value). Without ANSI the
    cast would truncate ``1.5`` to 1, so the full pattern is checked.
    """
    c = _col(c)
    fail = F.raise_error(F.concat(F.lit(f"BIGINT field '{name}' cannot parse: "), c))
    if _ansi():
        return F.when(c.isNull(), F.lit(None).cast("bigint")).when(_trimmed_end(c), fail).otherwise(c.cast("bigint"))
    return (
        F.when(c.isNull(), F.lit(None).cast("bigint"))
        .when(c.rlike("^[+-]?[0-9]+\\z"), c.cast("bigint"))
        .otherwise(fail)
    )


def parse_double(c: ColumnOrName, name: str = "field") -> Column:
    """``Double.parseDouble``.

    Spark's cast already takes what ``parseDouble`` takes (surrounding
    control chars and spaces, ``d``/``f`` suffixes, hex floats) and rejects
    the rest, except that it also takes ``inf`` and any letter case of
    ``nan`` / ``infinity``; those are refused here. All of them contain an
    ``n``, so the two patterns only run on values holding one. Without ANSI
    rules a rejected value casts to null, which is turned into the failure.
    """
    c = _col(c)
    fail = F.raise_error(F.concat(F.lit(f"DOUBLE field '{name}' cannot parse: "), c))
    special = c.contains("n") | c.contains("N")
    loose = special & c.rlike("(?i)^[\\x00-\\x20]*[+-]?(inf|infinity|nan)[\\x00-\\x20]*\\z")
    exact = c.rlike("^[\\x00-\\x20]*[+-]?(Infinity|NaN)[\\x00-\\x20]*\\z")
    out = F.when(c.isNull(), F.lit(None).cast("double")).when(loose & ~exact, fail)
    if _ansi():
        return out.otherwise(c.cast("double"))
    return out.when(c.cast("double").isNull(), fail).otherwise(c.cast("double"))


def parse_boolean(c: ColumnOrName) -> Column:
    """``Boolean.parseBoolean``: ``true`` in any letter case, everything else false, never an error."""
    return F.lower(_col(c)) == "true"


def format_line(cols: list[ColumnOrName], delimiter: str = ",", null_text: str = "NULL") -> Column:
    """One output line: cells as text, nulls as ``NULL``, joined by a literal delimiter, no quoting."""
    return F.concat_ws(delimiter, *[F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in cols])


def within_limit(c: ColumnOrName, max_bytes: int = 51200) -> Column:
    """Request-body size guard: absent bodies pass, present ones up to ``max_bytes`` bytes (inclusive)."""
    c = _col(c)
    return c.isNull() | (F.octet_length(c) <= F.lit(max_bytes))


def encode_event(**fields: ColumnOrName) -> Column:
    """A JSON object of the given fields; null fields are left out of the object."""
    return F.to_json(
        F.struct(*[_col(v).alias(k) for k, v in fields.items()]),
        {"ignoreNullFields": "true"},
    )
