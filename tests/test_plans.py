"""Plan properties the scale design depends on, checked on the physical plans."""

import os
import zipfile

from rowsmith.functions.text import java_split
from rowsmith.operators.audit import archive_audit
from rowsmith.operators.words import lines_of, word_count
from rowsmith.sources.archives import list_archives
from rowsmith.sources.delimited import read_delimited


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(tmp_path):
    d = str(tmp_path / "t")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("a,1,bad,1.5\nb,2,worse,2.5\n")
    return d


def test_delimited_scan_reads_one_column_and_does_not_shuffle(spark, tmp_path):
    df = read_delimited(spark, _files(tmp_path), "name string, n bigint, junk bigint, x double")
    plan = _plan(df.select("name", "n"))
    assert "ReadSchema: struct<value:string>" in plan
    assert "Exchange" not in plan


def test_unselected_fields_are_not_parsed(spark, tmp_path):
    df = read_delimited(spark, _files(tmp_path), "name string, n bigint, junk bigint, x double")
    plan = _plan(df.select("name", "n"))
    assert "'junk'" not in plan and "'x'" not in plan
    assert "'n'" in plan
    assert sorted(tuple(r) for r in df.select("name", "n").collect()) == [("a", 1), ("b", 2)]


def test_word_count_partial_aggregate_and_one_shuffle_by_word(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} the\nthe") for i in range(50)], "doc_id bigint, text string")
    plan = _plan(word_count(lines_of(docs, "text")))
    assert "partial_count" in plan
    assert plan.count("hashpartitioning(word") == 1


def test_archive_listing_reads_no_content(spark, tmp_path):
    d = str(tmp_path / "z")
    os.makedirs(d)
    with zipfile.ZipFile(os.path.join(d, "a.zip"), "w") as z:
        z.writestr("e", "x\n")
    plan = _plan(list_archives(spark, d))
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_regex_split_runs_once_a_value(spark):
    df = spark.createDataFrame([("a/b??",)], "u string").select(java_split("u", "[/?]").alias("f"))
    assert str(df._jdf.queryExecution().optimizedPlan()).count("split(") == 1
    assert df.first().f == ["a", "b"]


def test_archive_audit_needs_no_join(spark, tmp_path):
    d = str(tmp_path / "z")
    os.makedirs(d)
    with zipfile.ZipFile(os.path.join(d, "a.zip"), "w") as z:
        z.writestr("dir/", "")
        z.writestr("e", "xyz")
    for name in ("b.zip", "c.txt"):
        with open(os.path.join(d, name), "w") as f:
            f.write("no zip")
    audit = archive_audit(spark, d, pattern=".*\\.zip")
    assert "Join" not in _plan(audit)
    got = sorted((r.file_name, r.matched, r.is_zip, r.entries, r.text_bytes) for r in audit.collect())
    assert got == [("a.zip", True, True, 1, 3), ("b.zip", True, False, None, None), ("c.txt", False, None, None, None)]


def test_years_are_staged_without_a_shuffle(spark, tmp_path):
    from rowsmith.plans import staging
    from rowsmith.sinks.delimited import OPEN_FOLDERS

    cells = "'1995-01-01'::date + (id % 900)::int AS l_shipdate, 'R' AS l_returnflag, 'F' AS l_linestatus"
    numbers = ", ".join(f"id AS {c}" for c in staging.LINEITEM_COLUMNS[:8])
    spark.range(3000, numPartitions=3).selectExpr(*numbers.split(", "), *cells.split(", ")).write.parquet(str(tmp_path / "lineitem.parquet"))
    before = spark.conf.get(OPEN_FOLDERS)
    spark.sparkContext.setJobGroup("years", "years")
    try:
        path = staging.lineitem_by_year(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("years")]
    assert jobs and all(len(j.stageIds) == 1 for j in jobs)
    assert spark.read.text(path).groupBy("ship_year").count().count() == 3 and spark.read.text(path).count() == 3000
    assert spark.conf.get(OPEN_FOLDERS) == before


def test_archives_are_written_from_small_batches(spark, tmp_path, monkeypatch):
    from rowsmith.plans import staging

    writer, most = staging._zip_writer, staging.ENTRIES_PER_BATCH

    def checked(target, prefix):
        inner = writer(target, prefix)

        def small(batches):
            for b in batches:
                if b.num_rows > most:
                    raise ValueError(f"a batch of {b.num_rows} entries")
                yield b

        return lambda batches: inner(small(batches))

    monkeypatch.setattr(staging, "_zip_writer", checked)
    rows = spark.range(500).selectExpr("id div 400 AS archive", "concat('e', id) AS entry", "concat(id, '\n') AS body", "id AS seq")
    before = spark.conf.get(staging.BATCH_ROWS)
    staging.write_archives(rows, str(tmp_path / "z"), prefix="z", partitions=1)
    assert spark.conf.get(staging.BATCH_ROWS) == before
    from rowsmith.sources.archives import read_archive_lines

    assert sorted(int(r.value) for r in read_archive_lines(spark, str(tmp_path / "z")).collect()) == list(range(500))


def test_tasks_that_write_document_archives_grow_with_the_table(spark, tmp_path, monkeypatch):
    from rowsmith.plans import staging
    from rowsmith.session import default_parallelism, input_bytes

    docs = str(tmp_path / "documents.parquet")
    texts = {i: f"first {i}\nsecond {i}" for i in range(60)}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(docs)
    size, tasks, write = input_bytes(spark, docs), [], staging.write_archives
    monkeypatch.setattr(staging, "write_archives", lambda *a, partitions, **k: tasks.append(partitions) or write(*a, partitions=partitions, **k))
    monkeypatch.setattr(staging, "WRITER_BYTES", max(1, size // 40))
    path = staging.document_archives(spark, str(tmp_path)).removeprefix("file:")
    assert tasks[0] >= 40 > default_parallelism(spark)
    assert sorted(os.listdir(path)) == [f"docs-{i:06d}.zip" for i in range(3)]
    found = {}
    for name in os.listdir(path):
        with zipfile.ZipFile(f"{path}/{name}") as z:
            found |= {int(n[4:12]): z.read(n).decode() for n in z.namelist() if n.startswith("doc-")}
    assert found == texts
