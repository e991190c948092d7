"""Column functions against models of the JVM string rules."""

import pytest
from conftest import blank_model, java_split_model, read_line_model
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsmith.functions import (
    encode_event,
    format_line,
    is_blank,
    java_split,
    literal_char,
    parse_boolean,
    parse_double,
    parse_long,
    text_lines,
    tokens,
    within_limit,
)

SPLIT_CASES = [
    "a,,b,,",
    ",,",
    ",",
    "",
    ",a",
    "abc",
    "a,b,c",
    " , ",
    "a,b,,c,,,",
    "x;y,z",
    "1|2||",
]


def _eval(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", expr_fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


@pytest.mark.parametrize("regex", [",", "\\|", "[,;]", ",+", "\\s*,\\s*", ";"])
def test_java_split_matches_model(spark, regex):
    got = _eval(spark, SPLIT_CASES, lambda c: java_split(c, regex))
    assert got == [java_split_model(s, regex) for s in SPLIT_CASES]


def test_literal_char_detection():
    assert literal_char(",") == ","
    assert literal_char("\\|") == "|"
    assert literal_char("\\t") == "\t"
    assert literal_char("|") is None
    assert literal_char("[,;]") is None
    assert literal_char(",+") is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab, ", max_size=8), min_size=1, max_size=12))
def test_tokens_property(spark, lines):
    got = _eval(spark, lines, tokens)
    assert got == [java_split_model(s, " ") for s in lines]


def test_tokens_edge_cases(spark):
    cases = ["", "   ", " a", "a  b ", "a", "a b"]
    assert _eval(spark, cases, tokens) == [[""], [], ["", "a"], ["a", "", "b"], ["a"], ["a", "b"]]


TEXTS = ["", "a", "a\n", "a\nb", "a\r\nb\r\n", "\n", "\n\n", "a\rb", "a\r", "x\r\r\ny", "\r\n", "last\n\nline"]


def test_text_lines_matches_read_line(spark):
    assert _eval(spark, TEXTS, text_lines) == [read_line_model(t) for t in TEXTS]


def test_is_blank(spark):
    cases = ["", " ", "\t", " \t\x0b\x0c ", "\x00", "\x1f", "a", " a ", "\ra", "\nb", " ", "　"]
    assert _eval(spark, cases, is_blank) == [blank_model(c) for c in cases]


def test_parse_long(spark):
    assert _eval(spark, ["1", "-12", "+7", "9223372036854775807", None], lambda c: parse_long(c)) == [
        1, -12, 7, 9223372036854775807, None
    ]


@pytest.mark.parametrize("bad", [" 12 ", "1.0", "", "NULL", "12L", "9223372036854775808", "0x10"])
def test_parse_long_fails(spark, bad):
    with pytest.raises(Exception):
        _eval(spark, [bad], lambda c: parse_long(c))


def test_parse_double(spark):
    vals = ["1.5", " 2.5 ", "1.5d", "2f", "-0.0", "1e3", "0x1p3", "NaN", "-Infinity", "+Infinity"]
    got = _eval(spark, vals, lambda c: parse_double(c))
    assert got[:7] == [1.5, 2.5, 1.5, 2.0, -0.0, 1000.0, 8.0]
    assert got[7] != got[7]
    assert got[8] == float("-inf") and got[9] == float("inf")


@pytest.mark.parametrize("bad", ["", "inf", "nan", "INFINITY", "abc", "1,5"])
def test_parse_double_fails(spark, bad):
    with pytest.raises(Exception):
        _eval(spark, [bad], lambda c: parse_double(c))


def test_parse_boolean(spark):
    vals = ["true", "TRUE", "True", "false", "yes", "1", "", "foo", None, " true"]
    assert _eval(spark, vals, parse_boolean) == [True, True, True, False, False, False, False, False, None, False]


def test_format_line(spark):
    df = spark.createDataFrame(
        [(1, "a,b", True, 1.5), (None, None, None, None)], "n bigint, s string, b boolean, d double"
    )
    got = [r.v for r in df.select(format_line(["n", "s", "b", "d"], "|").alias("v")).collect()]
    assert got == ["1|a,b|true|1.5", "NULL|NULL|NULL|NULL"]


def test_within_limit_boundary(spark):
    vals = ["x" * 10, "x" * 11, None, "é" * 5, "é" * 6]
    assert _eval(spark, vals, lambda c: within_limit(c, 10)) == [True, False, True, True, False]


def test_encode_event_omits_nulls(spark):
    df = spark.createDataFrame([("ua", "body"), (None, "b"), ("u", None), (None, None)], "a string, b string")
    got = [r.j for r in df.select(encode_event(http_user_agent="a", request_body="b").alias("j")).collect()]
    assert got == [
        '{"http_user_agent":"ua","request_body":"body"}',
        '{"request_body":"b"}',
        '{"http_user_agent":"u"}',
        "{}",
    ]


def test_parsers_stay_strict_without_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert _eval(spark, ["12", "-3", None], lambda c: parse_long(c)) == [12, -3, None]
        assert _eval(spark, ["1.5", "2d", None], lambda c: parse_double(c)) == [1.5, 2.0, None]
        for bad, fn in [("1.5", parse_long), (" 7", parse_long), ("abc", parse_double), ("inf", parse_double)]:
            with pytest.raises(Exception):
                _eval(spark, [bad], lambda c, fn=fn: fn(c))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
