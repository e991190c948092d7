"""Stream operators: per-batch counts, interval counts, previews and message values."""

import collections
import datetime as dt
import os

import pytest
from conftest import java_split_model
from pyspark.sql import functions as F

from rowsmith.operators.events import event_envelope, message_values
from rowsmith.streaming import words as S


def _run(q):
    try:
        q.awaitTermination()
    finally:
        q.stop()


def _text(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("".join(x + "\n" for x in lines))


def _count(lines):
    c = collections.Counter()
    for line in lines:
        c.update(java_split_model(line, " "))
    return c


def test_batch_word_count_is_per_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    files = {
        "f1.txt": ["a b a", "", "c"],
        "f2.txt": ["a  a", "b "],
        "f3.txt": ["   ", "z"],
    }
    for n, lines in files.items():
        _text(src, n, lines)
    out = str(tmp_path / "out")
    stream = S.text_stream(spark, src, max_files_per_trigger=1)
    _run(S.batch_word_count(stream, out, str(tmp_path / "ck"), available_now=True))
    rows = S.batches(spark, out).collect()
    per_batch = collections.defaultdict(dict)
    for r in rows:
        per_batch[r.batch_id][r.word] = r.cnt
    assert len(per_batch) == 3
    got = sorted(sorted(b.items()) for b in per_batch.values())
    expect = sorted(sorted(dict(_count(lines)).items()) for lines in files.values())
    assert got == expect


def test_batch_replay_overwrites_its_own_output(spark, tmp_path):
    src = str(tmp_path / "in")
    _text(src, "f1.txt", ["x y"])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    _run(S.batch_word_count(S.text_stream(spark, src), out, ck, available_now=True))
    _run(S.batch_word_count(S.text_stream(spark, src), out, ck, available_now=True))
    assert sorted((r.word, r.cnt) for r in S.batches(spark, out).collect()) == [("x", 1), ("y", 1)]


def test_interval_word_count_stream_equals_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=7 * i), ["a b", "b", "c c c", ""][i % 4]) for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp, value string")
    src = str(tmp_path / "in")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, value string").option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "out")
    _run(S.run_interval_word_count(stream, "ts", out, str(tmp_path / "ck"), interval="1 hour", available_now=True))
    assert not os.path.exists(str(tmp_path / "ck" / "state"))  # no state is kept between batches
    assert len(os.listdir(out + "/data")) > 1
    got = sorted(tuple(r) for r in S.interval_counts(spark, out).collect())
    expect = sorted(tuple(r) for r in S.interval_word_count(df, "ts", interval="1 hour").collect())
    assert got == expect


def test_interval_word_count_append_with_watermark(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    src = str(tmp_path / "in")
    spark.createDataFrame([(base, "a"), (base + dt.timedelta(minutes=10), "a b")], "ts timestamp, value string").write.parquet(f"{src}/1")
    spark.createDataFrame([(base + dt.timedelta(hours=5), "z")], "ts timestamp, value string").write.parquet(f"{src}/2")
    stream = (
        spark.readStream.schema("ts timestamp, value string")
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(src)
    )
    counts = S.interval_word_count(stream, "ts", interval="1 hour", watermark="1 hour")
    out = str(tmp_path / "out")
    q = counts.writeStream.outputMode("append").format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "ck")
    ).trigger(availableNow=True).start()
    _run(q)
    got = sorted((r.word, r.cnt) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2), ("b", 1)]  # the first hour is closed by the watermark; the last is still open


def test_interval_trigger_processes_stops_and_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run_until(total):
        q = S.batch_word_count(S.text_stream(spark, src), out, ck, trigger="200 milliseconds")
        try:
            q.processAllAvailable()
            assert q.isActive
        finally:
            q.stop()
        assert sum(r.cnt for r in S.batches(spark, out).collect()) == total

    _text(src, "f1.txt", ["a b", "a"])
    run_until(3)
    _text(src, "f2.txt", ["b c"])
    run_until(5)  # resumed from its checkpoint: the first file is not counted again


def test_preview_limits_each_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    _text(src, "f1.txt", [f"l{i}" for i in range(25)])
    _text(src, "f2.txt", [f"m{i}" for i in range(3)])
    out = str(tmp_path / "out")
    _run(S.preview(S.text_stream(spark, src, max_files_per_trigger=1), out, str(tmp_path / "ck"), available_now=True))
    sizes = sorted(r["count"] for r in S.batches(spark, out).groupBy("batch_id").count().collect())
    assert sizes == [3, 10]


def test_envelope_stream_values(spark, tmp_path):
    ev = spark.createDataFrame([(1, '{"a":1}'), (2, None)], "id bigint, body string")
    env = event_envelope(ev, F.col("body"), topic="t", key=F.col("id").cast("string"), keep=["id"])
    src = str(tmp_path / "in")
    env.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    ).write.parquet(src)
    out = str(tmp_path / "out")
    _run(S.forward_values(message_values(S.envelope_stream(spark, src)), out, str(tmp_path / "ck"), available_now=True))
    assert sorted((r.value or "") for r in spark.read.parquet(out).collect()) == ["", '{"a":1}']


INTERVAL_SCHEMA = "ts timestamp, value string"


def _events(spark, src, n_files, start=0):
    base = dt.datetime(2024, 1, 1)
    for i in range(start, start + n_files):
        rows = [(base + dt.timedelta(minutes=11 * ((i * 7 + k) % 30)), ["a b", "b", "c c c"][(i + k) % 3]) for k in range(6)]
        spark.createDataFrame(rows, INTERVAL_SCHEMA).coalesce(1).write.mode("append").parquet(src)


def _interval_stream(spark, src, out, ck, **options):
    stream = spark.readStream.schema(INTERVAL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    return S.run_interval_word_count(stream, "ts", out, ck, interval="1 hour", available_now=True, **options)


def _expected(spark, src):
    return sorted(tuple(r) for r in S.interval_word_count(spark.read.parquet(src), "ts", interval="1 hour").collect())


def test_readers_see_nothing_of_a_batch_that_stopped_half_way(spark, tmp_path, monkeypatch):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    _events(spark, src, 2)
    _run(_interval_stream(spark, src, out, ck))
    before = sorted(tuple(r) for r in S.interval_counts(spark, out).collect())
    assert before == _expected(spark, src)
    _events(spark, src, 2, 2)
    commit = S.CommitLog.commit

    def stops(self, *args, **kwargs):  # the rows are written, the commit never comes
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(S.CommitLog, "commit", stops)
    with pytest.raises(Exception, match="lost the driver"):
        _run(_interval_stream(spark, src, out, ck))
    assert len(os.listdir(out + "/data")) == 3
    assert sorted(tuple(r) for r in S.interval_counts(spark, out).collect()) == before
    monkeypatch.setattr(S.CommitLog, "commit", commit)
    _run(_interval_stream(spark, src, out, ck))  # the batch is run again, under another name
    assert sorted(tuple(r) for r in S.interval_counts(spark, out).collect()) == _expected(spark, src)


def test_a_batch_whose_commit_the_stream_did_not_note_counts_once(spark, tmp_path, monkeypatch):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    _events(spark, src, 1)
    commit = S.CommitLog.commit

    def then_stops(self, *args, **kwargs):
        commit(self, *args, **kwargs)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(S.CommitLog, "commit", then_stops)
    with pytest.raises(Exception, match="lost the driver"):
        _run(_interval_stream(spark, src, out, ck))
    monkeypatch.setattr(S.CommitLog, "commit", commit)
    _run(_interval_stream(spark, src, out, ck))
    assert sorted(tuple(r) for r in S.interval_counts(spark, out).collect()) == _expected(spark, src)
    # another stream into the same table has batch numbers of its own
    _run(_interval_stream(spark, src, out, ck + "2"))
    assert sum(r.cnt for r in S.interval_counts(spark, out).collect()) == 2 * sum(r[3] for r in _expected(spark, src))


def test_small_batches_are_merged(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    _events(spark, src, 9)
    _run(_interval_stream(spark, src, out, ck, merge_fan=2))
    log = S.CommitLog(spark, out)
    folders = log.state().folders
    assert sorted(f.level for f in folders) == [0, 3]  # nine batches: eight in one folder, one of its own
    assert sorted((f.first_batch, f.last_batch) for f in folders) == [(0, 7), (8, 8)]
    assert sorted(tuple(r) for r in S.interval_counts(spark, out).collect()) == _expected(spark, src)
    rows = S.batches(spark, out)
    merged = rows.where("batch_id < 8")
    assert merged.count() == merged.select("window_start", "word").distinct().count()  # added up, not piled up
    assert len(os.listdir(out + "/data")) > 2
    assert log.vacuum(0) > 0 and len(os.listdir(out + "/data")) == 2
    assert sorted(tuple(r) for r in S.interval_counts(spark, out).collect()) == _expected(spark, src)


def test_merged_batches_of_word_counts_keep_their_batch(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(5):
        _text(src, f"f{i}.txt", [f"w{i} x"])
    monkeypatch.setattr(S, "MERGE_FAN", 2)
    monkeypatch.setattr(S.per_batch, "__defaults__", (None, 2))
    _run(S.batch_word_count(S.text_stream(spark, src, max_files_per_trigger=1), out, str(tmp_path / "ck"), available_now=True))
    assert sorted(f.level for f in S.CommitLog(spark, out).state().folders) == [0, 2]
    got = sorted((r.batch_id, r.word, r.cnt) for r in S.batches(spark, out).collect())
    assert len(got) == 10 and sorted({r[0] for r in got}) == [0, 1, 2, 3, 4] and all(r[2] == 1 for r in got)


def test_preview_query_shows_lines_of_every_500_documents(spark, tmp_path):
    from rowsmith.plans import queries as Q

    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('a', id, '\n', 'b', id) AS text")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in Q.q_stream_preview(spark, str(tmp_path)).collect())
    assert got == [(0, 10, 10), (1, 10, 10), (2, 10, 10)]
