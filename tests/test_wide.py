"""UTF-16 and UTF-32: aligned ranges, byte orders, long lines, bad bytes; and the split audit."""

import io
import os

import pytest
from conftest import read_line_model
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsmith.operators.audit import split_audit
from rowsmith.sources import line_ranges, wide
from rowsmith.sources.delimited import read_delimited, read_lines

# U+0A0D, U+0D0A and U+0A0A hold the bytes of line ends inside a character
ODD = "a\r\n਍ഊਊ𝄞é"


@settings(max_examples=300, deadline=None)
@given(
    st.text(ODD, max_size=40),
    st.integers(1, 12),
    st.sampled_from(["UTF-16LE", "UTF-16BE", "utf_32le", "UTF-32BE", "UTF-16", "UTF-32"]),
    st.sampled_from([1, 3, 1 << 16]),
    st.booleans(),
)
def test_ranges_give_every_line_once(text, split, encoding, block, strip_cr):
    data = text.encode(encoding.replace("_", "-"))  # Python writes a mark where no order is named
    width, _ = wide.wide_encoding(encoding)
    split *= width
    f, before, line_ranges.BLOCK = io.BytesIO(data), line_ranges.BLOCK, block
    try:
        got = []
        for start in range(0, max(len(data), 1), split):
            for lines in wide.wide_lines(f, len(data), start, start + split, encoding, strip_cr=strip_cr, chunk=7):
                got += lines.to_pylist()
    finally:
        line_ranges.BLOCK = before
    want = text.split("\n") if strip_cr else read_line_model(text)
    if strip_cr:
        want = [x.replace("\r", "") for x in want]
        want = want[:-1] if want and want[-1] == "" else want
    assert got == want


def test_no_mark_means_high_byte_first():
    data = "é\nx".encode("utf-16-be")
    assert [x for a in wide.wide_lines(io.BytesIO(data), len(data), 0, 99, "UTF-16") for x in a.to_pylist()] == ["é", "x"]
    assert wide.wide_encoding("GBK") is None and wide.wide_encoding("UTF-8") is None


@pytest.mark.parametrize("data", [b"a\x00\x00\xd8\n\x00", b"a\x00\n\x00b"])
def test_bad_units_fail_or_are_replaced(data):
    with pytest.raises(UnicodeDecodeError):
        list(wide.wide_lines(io.BytesIO(data), len(data), 0, 99, "UTF-16LE"))
    got = [x for a in wide.wide_lines(io.BytesIO(data), len(data), 0, 99, "UTF-16LE", "replace") for x in a.to_pylist()]
    assert "�" in "".join(got) and got[0][0] == "a"


def write(path, name, data):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "wb") as f:
        f.write(data)


@pytest.mark.parametrize("split", [4096, 1 << 20])
def test_files_of_both_orders(spark, tmp_path, split, monkeypatch):
    monkeypatch.setattr(wide.read_wide_lines, "__kwdefaults__", {**wide.read_wide_lines.__kwdefaults__, "split_bytes": split})
    d = str(tmp_path / "t")
    long = "ж" * 30_000  # longer than a range and than a batch of bytes
    text = f"one,1\r\n\n{long},2\n𝄞,3"
    write(d, "le x.txt", text.encode("utf-16"))
    write(d, "be.txt", b"\xfe\xff" + text.encode("utf-16-be"))
    write(d, "empty.txt", b"")
    rows = sorted(tuple(r) for r in read_delimited(spark, d, "name string, n bigint", encoding="UTF-16").collect())
    assert rows == sorted([("one", 1), (long, 2), ("𝄞", 3)] * 2)
    named = read_lines(spark, d, encoding="utf-16", pattern="be.*", with_file=True).collect()
    assert {(r.file_name, r.file_path.rsplit("/", 1)[-1]) for r in named} == {("be.txt", "be.txt")} and len(named) == 4
    if split == 4096:
        assert read_lines(spark, d, encoding="UTF-16").rdd.getNumPartitions() > 20


def test_split_audit_adds_up_at_every_size(spark, tmp_path):
    d = str(tmp_path / "t")
    lines = [f"{i}," + "x" * (i % 50) for i in range(4000)]
    write(d, "a.txt", ("\n".join(lines) + "\n").encode())
    write(d, "b-c.txt", ("\r\n".join(lines[:100])).encode())
    write(d, "no.csv", b"x\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size, least in ((1 << 12, 20), (1 << 30, 2)):
        found = split_audit(spark, d, pattern=".*[.]txt", split_bytes=size).collect()
        assert len(found) >= least
        for name, n in (("a.txt", 4000), ("b-c.txt", 100)):
            own = sorted((r for r in found if r.file_name == name), key=lambda r: r.split_start)
            bytes_ = os.path.getsize(f"{d}/{name}")
            assert sum(r.lines for r in own) == n and all(r.file_bytes == bytes_ and r.split_bytes <= size for r in own)
            assert [r.split_start for r in own] == [sum(x.split_bytes for x in own[:i]) for i in range(len(own))]
            assert sum(r.split_bytes for r in own) == bytes_
        assert {r.file_name for r in found} == {"a.txt", "b-c.txt"}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert sum(r.lines for r in split_audit(spark, d).collect()) == 4101


def test_split_audit_reads_many_splits_a_task(spark, tmp_path):
    d = str(tmp_path / "t")
    write(d, "a.txt", b"some line\n" * 100_000)
    spark.sparkContext.setJobGroup("audit", "audit")
    try:
        found = split_audit(spark, d, split_bytes=1 << 12)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found.count() == 245 and found.agg({"lines": "sum"}).first()[0] == 100_000
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("audit") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= spark.sparkContext.defaultParallelism + 1
