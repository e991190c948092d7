"""Scan audit, event envelopes, message values and the body-size guard."""

import os

from pyspark.sql import functions as F

from rowsmith.operators.audit import scan_audit
from rowsmith.operators.events import accepted_bodies, event_envelope, message_values, report_event
from rowsmith.operators.words import lines_of, word_count


def test_scan_audit_matched_and_discarded(spark, tmp_path):
    d = str(tmp_path / "t")
    os.makedirs(d)
    files = {"2018_a.txt": "a\nb\n\n", "2018_b.txt": "c", "2017_a.txt": "x\ny\n"}
    for name, body in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    rows = {r.file_name: r for r in scan_audit(spark, d, pattern="2018_.*").collect()}
    assert rows["2018_a.txt"].matched and rows["2018_a.txt"].lines == 3 and rows["2018_a.txt"].bytes == 5
    assert rows["2018_b.txt"].matched and rows["2018_b.txt"].lines == 1
    assert not rows["2017_a.txt"].matched and rows["2017_a.txt"].lines is None


def test_envelope_keys(spark):
    ev = spark.createDataFrame([(1, "ua", '{"a":1}'), (2, None, None)], "id bigint, event_type string, props string")
    msg = report_event(ev)
    const = event_envelope(ev, msg, keep=["id"]).orderBy("id").collect()
    assert [r.key for r in const] == ["key", "key"] and {r.topic for r in const} == {"test"}
    assert const[0].value == '{"http_user_agent":"ua","request_body":"{\\"a\\":1}"}'
    assert const[1].value == "{}"
    by_col = event_envelope(ev, msg, key=F.col("id").cast("string"), topic="t2").collect()
    assert sorted(r.key for r in by_col) == ["1", "2"]
    assert all(r.key is None for r in event_envelope(ev, msg, key=None).collect())


def test_message_values_and_body_guard(spark):
    m = spark.createDataFrame([(b"k", b"{}"), (None, None)], "key binary, value binary")
    assert sorted((r.value or "") for r in message_values(m).collect()) == ["", "{}"]
    bodies = spark.createDataFrame([("a" * 5,), ("a" * 6,), (None,)], "request_body string")
    assert accepted_bodies(bodies, max_bytes=5).count() == 2


def test_word_count_hot_word_is_pre_aggregated(spark):
    docs = spark.createDataFrame([(i, "the " * 50 + f"w{i}") for i in range(200)], "doc_id bigint, text string")
    counts = word_count(lines_of(docs.repartition(8), "text"))
    got = {r.word: r.cnt for r in counts.collect()}
    assert got["the"] == 200 * 50 and got["w7"] == 1
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_archive_audit_flags_bad_archives(spark, tmp_path):
    import zipfile

    from rowsmith.operators.audit import archive_audit

    d = str(tmp_path / "z")
    os.makedirs(d)
    with zipfile.ZipFile(os.path.join(d, "keep_ok.zip"), "w") as z:
        z.writestr("a.txt", "1,a\n")
        z.writestr("dir/", "")
        z.writestr("b.txt", "22,bb\n")
    with open(os.path.join(d, "keep_bad.zip"), "wb") as f:
        f.write(b"not a zip")
    with open(os.path.join(d, "other.zip"), "wb") as f:
        f.write(b"whatever")
    rows = {r.file_name: r for r in archive_audit(spark, d, pattern="keep_.*").collect()}
    assert rows["keep_ok.zip"].is_zip and rows["keep_ok.zip"].entries == 2 and rows["keep_ok.zip"].text_bytes == 10
    assert rows["keep_bad.zip"].matched and rows["keep_bad.zip"].is_zip is False
    assert not rows["other.zip"].matched and rows["other.zip"].is_zip is None
