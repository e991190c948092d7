"""Delimited text reader and writer on generated fixture files."""

import os

import pytest
from conftest import java_split_model
from pyspark.sql import functions as F

from rowsmith.sinks.delimited import format_lines, materialize, write_delimited
from rowsmith.sources.delimited import read_delimited, read_lines

SCHEMA = "name string, n bigint, flag boolean, x double"


def _write(path, name, data: bytes):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as f:
        f.write(data)


def _rows(df, order="n"):
    return [tuple(r) for r in df.orderBy(order).collect()]


def test_typed_rows_short_long_blank_trailing(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(
        d,
        "a.txt",
        b"alpha,1,true,1.5\n"
        b"\n"
        b"   \t \n"
        b"beta,2,TRUE,2\n"
        b"gamma,3\n"
        b"delta,4,no,4.5,extra,fields\n"
        b"eps,5,,,\n"
        b"NULL,6,false,6e1\n",
    )
    got = _rows(read_delimited(spark, d, SCHEMA))
    assert got == [
        ("alpha", 1, True, 1.5),
        ("beta", 2, True, 2.0),
        ("gamma", 3, None, None),
        ("delta", 4, False, 4.5),
        ("eps", 5, None, None),
        ("NULL", 6, False, 60.0),
    ]


def test_line_ends_all_three(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,1\r\nb,2\rc,3\nd,4")
    assert [r.n for r in read_delimited(spark, d, SCHEMA).orderBy("n").collect()] == [1, 2, 3, 4]


def test_strip_cr_mode(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a\r,1\r\nb,2\n")
    got = _rows(read_delimited(spark, d, "name string, n bigint", strip_cr=True))
    assert got == [("a", 1), ("b", 2)]


def test_regex_delimiter(spark, tmp_path):
    d = str(tmp_path / "t")
    lines = ["a;1,x", "b , 2 ,y", "c,,3"]
    _write(d, "a.txt", ("\n".join(lines) + "\n").encode())
    got = [list(r) for r in read_lines(spark, d).select(F.col("value")).collect()]
    df = read_delimited(spark, d, "f1 string, f2 string, f3 string", delimiter="\\s*[,;]\\s*")
    rows = sorted(tuple(r) for r in df.collect())
    expect = sorted(
        tuple((java_split_model(s, "\\s*[,;]\\s*") + [None] * 3)[:3]) for s in lines
    )
    assert got and rows == expect


def test_gbk_with_cjk(spark, tmp_path):
    d = str(tmp_path / "t")
    text = "中文,1\n汉字与其他双字节字符（全角）,2\nascii,3\n"
    _write(d, "g.txt", text.encode("gbk"))
    got = _rows(read_delimited(spark, d, "name string, n bigint", encoding="GBK"))
    assert got == [("中文", 1), ("汉字与其他双字节字符（全角）", 2), ("ascii", 3)]


def test_bad_bytes_fail_and_replace(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "g.txt", "好,1\n".encode("gbk") + b"\xff\xfe,2\n")
    with pytest.raises(Exception):
        read_delimited(spark, d, "name string, n bigint", encoding="GBK").collect()
    got = _rows(read_delimited(spark, d, "name string, n bigint", encoding="GBK", on_bad_bytes="replace"))
    assert got[0] == ("好", 1) and got[1][1] == 2 and "�" in got[1][0]


def test_split_size_does_not_change_result(spark, tmp_path):
    d = str(tmp_path / "big")
    body = "".join(f"name{i} 中,{i},{'true' if i % 3 == 0 else 'false'},{i / 7}\n" for i in range(40000))
    _write(d, "big.txt", body.encode("gbk"))
    results = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ["64k", "100001", "1m", "128m"]:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = read_delimited(spark, d, SCHEMA, encoding="GBK")
            parts = df.rdd.getNumPartitions()
            agg = df.agg(F.count("*"), F.sum("n"), F.sum(F.col("flag").cast("int")), F.bit_xor(F.xxhash64("name"))).first()
            results.append((parts, tuple(agg)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert results[0][0] > 4  # really split
    assert len({r[1] for r in results}) == 1
    assert results[0][1][0] == 40000


def test_file_name_filter_prunes_files(spark, tmp_path):
    d = str(tmp_path / "t")
    for name in ["2017_a.txt", "2018_a.txt", "2018_b.txt", "x2018_c.txt", "2019.txt", "2018_d.csv"]:
        _write(d, name, f"{name},1\n".encode())
    df = read_delimited(spark, d, "name string, n bigint", pattern="2018_.*\\.txt")
    assert sorted(r.name for r in df.collect()) == ["2018_a.txt", "2018_b.txt"]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2  # of 6: the others are not opened


def test_empty_options_are_the_defaults(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,1\n")
    assert _rows(read_delimited(spark, d, "name string, n bigint", delimiter="", pattern="")) == [("a", 1)]


def test_lines_that_only_look_blank_are_kept(spark, tmp_path):
    d = str(tmp_path / "t")
    odd = [s + c for s in ("", " ", "  ") for c in ("\u0085", "\u2028", "\u2029")]
    _write(d, "a.txt", "\n".join([*odd, "", "  ", "x"]).encode())
    assert sorted(r.v for r in read_delimited(spark, d, "v string").collect()) == sorted([*odd, "x"])


def test_bad_bytes_of_utf8_and_session_flags(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"\xff\xfe\nok\n")
    assert sorted(r.value for r in read_lines(spark, d, on_bad_bytes="replace").collect()) == ["ok", "\ufffd\ufffd"]
    with pytest.raises(Exception, match="UTF8|UTF-8"):
        read_lines(spark, d).collect()
    with pytest.raises(ValueError):
        read_lines(spark, d, on_bad_bytes="nonsense")
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, "false")
    _write(d, "b.gbk", "甲\n".encode("gbk"))
    assert [r.value for r in read_lines(spark, d, encoding="GBK", pattern="b.*").collect()] == ["甲"]
    assert spark.conf.get(key, "false") == before


def test_column_pruning_skips_bad_fields(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,notanumber,1\nb,also bad,2\n")
    df = read_delimited(spark, d, "name string, bad bigint, n bigint", columns=["name", "n"])
    assert _rows(df) == [("a", 1), ("b", 2)]
    full = read_delimited(spark, d, "name string, bad bigint, n bigint")
    assert _rows(full.select("name", "n")) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception):
        full.collect()


def test_zero_column_count(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,x\n\nb,y\n  \nc\n")
    df = read_delimited(spark, d, "name string, n bigint", columns=[])
    assert df.columns == [] and df.count() == 3


def test_schema_checks(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,1\n")
    with pytest.raises(ValueError, match="not in the table schema"):
        read_delimited(spark, d, "name string, n bigint", columns=["nope"])
    with pytest.raises(ValueError, match="readers parse"):
        read_delimited(spark, d, "name string, ts timestamp")
    # an unsupported type that is not selected is fine
    assert read_delimited(spark, d, "name string, ts timestamp", columns=["name"]).count() == 1


def test_null_value_option(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"NULL,NULL,NULL,NULL\nx,1,true,2\n")
    got = [tuple(r) for r in read_delimited(spark, d, SCHEMA, null_value="NULL").collect()]
    assert len(got) == 2 and (None, None, None, None) in got and ("x", 1, True, 2.0) in got


def test_write_then_read_identity(spark, tmp_path):
    df = spark.createDataFrame(
        [("a b", 1, True, 1.25), ("c", -2, False, -0.5), ("d|e", 3, True, 1e-9)], SCHEMA
    )
    out = str(tmp_path / "out")
    write_delimited(df, out, delimiter=";")
    back = read_delimited(spark, out, SCHEMA, delimiter=";")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_format_lines_nulls_and_raw_delimiters(spark):
    df = spark.createDataFrame([("a,b", None, None, 1.0)], SCHEMA)
    assert format_lines(df).first().value == "a,b,NULL,NULL,1.0"


def test_materialize(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a,1\nb,2\n")
    m = materialize(read_delimited(spark, d, "name string, n bigint"), str(tmp_path / "m"))
    assert _rows(m) == [("a", 1), ("b", 2)]
    assert "parquet" in m._jdf.queryExecution().executedPlan().toString().lower()


def test_wide_encodings_are_read(spark, tmp_path):
    d = str(tmp_path / "t")
    _write(d, "a.txt", "a,1\n".encode("utf-16"))
    assert _rows(read_delimited(spark, d, "name string, n bigint", encoding="UTF-16")) == [("a", 1)]


def test_named_table_sql_and_write_back(spark, tmp_path):
    from rowsmith.sources.tables import DelimitedTable

    d = str(tmp_path / "t")
    _write(d, "a.txt", b"a|1|true|1.5\nb|2|x|oops\n")
    t = DelimitedTable(d, SCHEMA, delimiter="\\|")
    t.register(spark, "ext_t")
    # x is not selected, so the bad double in line two is never parsed
    got = spark.sql("SELECT name, n FROM ext_t WHERE n >= 1 ORDER BY n").collect()
    assert [tuple(r) for r in got] == [("a", 1), ("b", 2)]
    t.write(spark.createDataFrame([("c", 3, False, 3.0)], SCHEMA))
    assert sorted(r.n for r in t.read(spark, columns=["n"]).collect()) == [1, 2, 3]


def test_limited_split_equals_full_split(spark, tmp_path):
    import random

    rnd = random.Random(7)
    lines = ["".join(rnd.choice(["a", "1", ",", ",", "", "b"]) for _ in range(rnd.randint(0, 14))) for _ in range(300)]
    d = str(tmp_path / "t")
    _write(d, "a.txt", ("\n".join(lines) + "\n").encode())
    schema = ", ".join(f"f{i} string" for i in range(8))
    full = read_delimited(spark, d, schema)
    for cols in (["f0"], ["f1", "f3"], ["f6"], ["f0", "f7"]):
        limited = read_delimited(spark, d, schema, columns=cols)
        a = sorted(tuple("\0" if v is None else v for v in r) for r in limited.collect())
        b = sorted(tuple("\0" if v is None else v for v in r) for r in full.select(*cols).collect())
        assert a == b, cols
