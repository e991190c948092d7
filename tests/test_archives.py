"""Zip archive reader on generated archives, against a model of the continuous-stream rules."""

import os
import zipfile

import pyarrow as pa
import pytest
from conftest import read_line_model

from rowsmith.sources import archives as A
from rowsmith.sources.archives import line_arrays, read_archive_lines, read_archives


def _zip(path, entries, dirs=()):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d in dirs:
            z.writestr(zipfile.ZipInfo(d), b"")
        for name, data in entries:
            z.writestr(name, data if isinstance(data, bytes) else data.encode("utf-8"))


def _model(entries, first=1, sentinel="EOF"):
    text = b"".join(d if isinstance(d, bytes) else d.encode() for _, d in entries).decode("utf-8", "replace")
    out = []
    for no, line in enumerate(read_line_model(text), start=1):
        if no < first:
            continue
        if sentinel is not None and line == sentinel:
            break
        out.append((no, line))
    return out


def _lines(spark, d, **kw):
    df = read_archive_lines(spark, d, **kw)
    return sorted((r.file_name, r.line_no, r.value) for r in df.collect())


def test_entries_run_together_and_directories_skipped(spark, tmp_path):
    d = str(tmp_path / "z")
    entries = [("a.txt", "1,a\n2,b"), ("b.txt", "3,c\n"), ("c.txt", "4,d")]
    _zip(f"{d}/one.zip", entries, dirs=["folder/"])
    got = _lines(spark, d)
    assert got == [("one.zip", n, v) for n, v in _model(entries)]
    assert ("one.zip", 2, "2,b3,c") in got


def test_entry_newline_option(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/one.zip", [("a.txt", "1,a\n2,b"), ("b.txt", "3,c\n")])
    got = [v for _, _, v in _lines(spark, d, entry_newline=True)]
    assert got == ["1,a", "2,b", "3,c"]


def test_header_counts_per_archive_not_per_entry(spark, tmp_path):
    d = str(tmp_path / "z")
    entries = [("a.txt", "h1\nh2\n1,a\n"), ("b.txt", "h1\n2,b\n")]
    _zip(f"{d}/x.zip", entries)
    _zip(f"{d}/y.zip", [("c.txt", "h1\n\nh3\n5,e\n")])
    got = _lines(spark, d, first_data_line=3)
    assert [v for f, _, v in got if f == "x.zip"] == ["1,a", "h1", "2,b"]
    assert [v for f, _, v in got if f == "y.zip"] == ["h3", "5,e"]


def test_sentinel_ends_the_archive_including_later_entries(spark, tmp_path):
    d = str(tmp_path / "z")
    entries = [("a.txt", "1,a\nEOF\n2,b\n"), ("b.txt", "3,c\n")]
    _zip(f"{d}/x.zip", entries)
    _zip(f"{d}/y.zip", [("c.txt", " EOF\nEOF \n4,d\n")])
    got = _lines(spark, d)
    assert [v for f, _, v in got if f == "x.zip"] == ["1,a"]
    assert [v for f, _, v in got if f == "y.zip"] == [" EOF", "EOF ", "4,d"]


def test_sentinel_inside_header_is_skipped_not_stopping(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/x.zip", [("a.txt", "EOF\n1,a\nEOF\n2,b\n")])
    assert [v for _, _, v in _lines(spark, d, first_data_line=2)] == ["1,a"]


def test_name_pattern_bad_and_empty_archives(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/keep_1.zip", [("a.txt", "1,a\n")])
    _zip(f"{d}/drop_1.zip", [("a.txt", "9,z\n")])
    _zip(f"{d}/keep_empty.zip", [])
    with open(f"{d}/keep_bad.zip", "wb") as f:
        f.write(b"not a zip at all")
    with pytest.raises(Exception, match="not a zip"):
        read_archive_lines(spark, d, pattern="keep_.*").collect()
    got = _lines(spark, d, pattern="keep_.*", on_bad_archive="skip")
    assert got == [("keep_1.zip", 1, "1,a")]


def test_typed_archive_scan_and_blank_lines(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/t.zip", [("a.txt", "x,1,true,1.5\n\n  \nY,2,no,2\r\nz,3\n")])
    df = read_archives(spark, d, "name string, n bigint, flag boolean, x double", with_file=True)
    rows = sorted((r.n, r.name, r.flag, r.x, r.file_name) for r in df.collect())
    assert rows == [(1, "x", True, 1.5, "t.zip"), (2, "Y", False, 2.0, "t.zip"), (3, "z", None, None, "t.zip")]


def test_crlf_split_across_entries_and_chunks(spark, tmp_path, monkeypatch):
    d = str(tmp_path / "z")
    entries = [("a.txt", "1,a\r"), ("b.txt", "\n2,b\r"), ("c.txt", "3,c\r\n\r"), ("d.txt", "é,4")]
    _zip(f"{d}/x.zip", entries)
    got = [(n, v) for _, n, v in _lines(spark, d)]
    assert got == _model(entries)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
def test_raw_lines_chunking_matches_model(chunk):
    data = b"a\r\nb\rc\n\n\r\rd\r\n\xc3\xa9e\r"
    pieces = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    got = [p.decode() for lines, closed in line_arrays(iter(pieces)) for p in lines.to_pylist() if closed or p]
    assert got == read_line_model(data.decode())


def test_batches_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(A, "BATCH_LINES", 100)
    monkeypatch.setattr(A, "BATCH_BYTES", 1000)
    lines = [b"x" * n for n in (1, 2000, 3, 999, 1, 0, 500, 500, 500)] + [b""] * 250
    out = A.BatchBuilder("utf-8", True)
    got = list(out.add("u", "n", 5, pa.array(lines[:6], pa.large_binary()))) + list(out.add("u", "n", 11, pa.array(lines[6:], pa.large_binary())))
    got += [out.flush()] if out.rows else []
    assert [v for b in got for v in b.column("value").to_pylist()] == [x.decode() for x in lines]
    assert [v for b in got for v in b.column("line_no").to_pylist()] == list(range(5, 5 + len(lines)))
    for b in got:
        assert b.num_rows <= 100 and (b.num_rows == 1 or sum(map(len, b.column("value").to_pylist())) <= 1000)


def test_long_line_is_read_in_linear_time():
    import time

    def seconds(chunks):
        t = time.process_time()
        (rest, closed), = line_arrays(iter([b"x" * (1 << 20)] * chunks))
        assert not closed and len(rest[0].as_py()) == chunks << 20
        return time.process_time() - t

    seconds(4)
    assert seconds(128) < 16 * max(seconds(32), 0.02)


def _break_entry(path, name):
    """Overwrite the compressed bytes of one entry."""
    with zipfile.ZipFile(path) as z:
        info = z.getinfo(name)
    with open(path, "r+b") as f:
        f.seek(info.header_offset + 30 + len(name))
        f.write(b"\xff" * info.compress_size)


@pytest.mark.parametrize("split_bytes", [0, 1 << 40])
def test_broken_entry_fails_unless_the_sentinel_comes_first(spark, tmp_path, split_bytes):
    body = "".join(f"{i},{i * i % 97}\n" for i in range(300))
    after, before = str(tmp_path / "after"), str(tmp_path / "before")
    _zip(f"{after}/a.zip", [("1.txt", "h\na\nb\nEOF\n" + body), ("2.txt", body), ("3.txt", body)])
    _break_entry(f"{after}/a.zip", "3.txt")
    _zip(f"{before}/b.zip", [("1.txt", body), ("2.txt", body), ("3.txt", "EOF\n" + body)])
    _break_entry(f"{before}/b.zip", "2.txt")
    kw = dict(split_bytes=split_bytes, unit_bytes=1)
    assert [v for _, _, v in _lines(spark, after, **kw)] == ["h", "a", "b"]
    with pytest.raises(Exception, match="zlib|Error -3|BadZip|bad"):
        _lines(spark, before, **kw)


@pytest.mark.parametrize("split_bytes", [0, 1 << 40])
def test_sentinel_with_a_replacement_character_matches_decoded_lines(spark, tmp_path, split_bytes):
    d = str(tmp_path / "z")
    _zip(f"{d}/x.zip", [("a.txt", b"1\nE"), ("b.txt", b"\xff\n2\n"), ("c.txt", b"3\n")])
    assert [v for _, _, v in _lines(spark, d, sentinel="E\ufffd", split_bytes=split_bytes, unit_bytes=1)] == ["1"]


def test_charset_decode_and_bad_bytes(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/x.zip", [("a.txt", "甲,1\n乙丙,2\n".encode("gbk") + b"\xff\n")])
    assert [v for _, _, v in _lines(spark, d, encoding="gbk")][:2] == ["甲,1", "乙丙,2"]
    with pytest.raises(Exception, match="decode"):
        _lines(spark, d, encoding="gbk", on_bad_bytes="fail")


def _random_archives(d, seed, n_archives=4):
    import random

    rnd = random.Random(seed)
    alphabet = ["a", "b", "EOF", "\n", "\r", "\r\n", " ", "é", "", "x,1"]
    for k in range(n_archives):
        entries = []
        for e in range(rnd.randint(0, 9)):
            body = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))
            entries.append((f"e{e}.txt", body))
        if rnd.random() < 0.3:
            entries.insert(rnd.randint(0, len(entries)), (f"lf{k}.txt", "\nEOF\n"))
        _zip(f"{d}/r{seed}_{k}.zip", entries, dirs=["sub/"] if rnd.random() < 0.3 else ())


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("first,sentinel,entry_newline", [(1, "EOF", False), (3, "EOF", False), (2, None, False), (4, "b", True)])
def test_unit_parallel_path_equals_single_task(spark, tmp_path, seed, first, sentinel, entry_newline):
    d = str(tmp_path / "z")
    _random_archives(d, seed)
    kw = dict(first_data_line=first, sentinel=sentinel, entry_newline=entry_newline)
    single = _lines(spark, d, **kw)
    units = _lines(spark, d, split_bytes=0, unit_bytes=1, **kw)
    assert units == single
    # and both equal the model of one continuous stream per archive
    import glob
    import zipfile as zf_

    expect = []
    for path in sorted(glob.glob(f"{d}/*.zip")):
        with zf_.ZipFile(path) as z:
            ents = [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()]
        if entry_newline:
            ents = [(n, b + b"\n" if b and b[-1:] not in (b"\n", b"\r") else b) for n, b in ents]
        for no, line in _model(ents, first, sentinel):
            expect.append((os.path.basename(path), no, line))
    assert single == sorted(expect)


def test_unit_path_crlf_between_units(spark, tmp_path):
    d = str(tmp_path / "z")
    entries = [("a", "x\r"), ("b", ""), ("c", "\ny\r"), ("d", "\r\n"), ("e", "z")]
    _zip(f"{d}/c.zip", entries)
    assert _lines(spark, d, split_bytes=0, unit_bytes=1) == _lines(spark, d) == [
        ("c.zip", n, v) for n, v in _model(entries)
    ]


@pytest.mark.parametrize("chunk", [1, 3, 5])
def test_block_rules_across_tiny_chunks(spark, tmp_path, monkeypatch, chunk):
    import glob
    import zipfile as zf_

    d = str(tmp_path / "z")
    for seed in range(3):
        _random_archives(d, 100 + seed)
    monkeypatch.setattr(A, "CHUNK", chunk)
    for first, sentinel in [(1, "EOF"), (3, "EOF"), (2, None), (5, "a")]:
        got = _lines(spark, d, first_data_line=first, sentinel=sentinel)
        expect = []
        for path in sorted(glob.glob(f"{d}/*.zip")):
            with zf_.ZipFile(path) as z:
                ents = [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()]
            expect += [(os.path.basename(path), no, line) for no, line in _model(ents, first, sentinel)]
        assert got == sorted(expect), (first, sentinel)
        units = _lines(spark, d, first_data_line=first, sentinel=sentinel, split_bytes=0, unit_bytes=7)
        assert units == got, (first, sentinel)


def test_invalid_utf8_is_replaced(spark, tmp_path):
    d = str(tmp_path / "z")
    _zip(f"{d}/b.zip", [("a", b"ok\n\xff\xfebad\n\xc3\xa9\n")])
    assert [v for _, _, v in _lines(spark, d)] == ["ok", "��bad", "é"]


def test_partial_files_of_failed_writes_are_not_read(spark, tmp_path):
    from rowsmith.plans.staging import write_archives

    d = str(tmp_path / "w")
    rows = spark.createDataFrame(
        [(k // 3, f"e{k}.txt", f"{k},x\n", k) for k in range(9)], "archive bigint, entry string, body string, seq bigint"
    )
    write_archives(rows, d, prefix="t")
    names = sorted(os.listdir(d))
    assert names == ["t-000000.zip", "t-000001.zip", "t-000002.zip"]
    # what a lost task would leave behind
    with open(os.path.join(d, ".t-000003.zip.dead.tmp"), "wb") as f:
        f.write(b"PK\x03\x04partial")
    got = read_archives(spark, d, "n bigint, s string")
    assert sorted(r.n for r in got.collect()) == list(range(9))


def test_unit_path_bad_bytes_across_units(spark, tmp_path):
    d = str(tmp_path / "z")
    entries = [("a", b"x\xff"), ("b", b"\xfey\nEOF"), ("c", b"\nz\n")]
    _zip(f"{d}/b.zip", entries)
    single = _lines(spark, d)
    assert single == _lines(spark, d, split_bytes=0, unit_bytes=1)
    assert [v for _, _, v in single] == ["x��y"]


def test_archive_table_sql_and_plain_text_write(spark, tmp_path):
    from rowsmith.sources.delimited import read_delimited
    from rowsmith.sources.tables import ArchiveTable

    d = str(tmp_path / "z")
    _zip(f"{d}/2018_a.zip", [("a.txt", "head\n1|x|true\n2|y|false\nEOF\n9|z|true\n")])
    _zip(f"{d}/2017_a.zip", [("a.txt", "head\n5|q|true\n")])
    t = ArchiveTable(d, "n bigint, s string, f boolean", delimiter="\\|", pattern="2018_.*", first_data_line=2)
    t.register(spark, "zipped")
    assert [tuple(r) for r in spark.sql("SELECT n, s FROM zipped WHERE f OR n > 1 ORDER BY n").collect()] == [(1, "x"), (2, "y")]
    out = str(tmp_path / "out")
    t.write(t.read(spark), out)
    back = read_delimited(spark, out, "n bigint, s string, f boolean", delimiter="\\|")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "x", True), (2, "y", False)]
