"""The commit log and the incremental native copy."""

import os
import threading
import time

import pytest

from rowsmith.sinks.commits import SNAPSHOT_EVERY, CommitLog, Conflict, Folder, committed_rows
from rowsmith.sinks.incremental import NativeCopy
from rowsmith.sources.archives import read_archives
from rowsmith.sources.delimited import read_delimited

SCHEMA = "name string, n bigint"


def add(log, value, **options):
    name = log.new_folder()
    log.write(log.spark.createDataFrame([(value,)], "v long"), name)
    return log.commit([Folder(name, value, value)], **options)


def values(spark, root):
    return sorted(r.v for r in committed_rows(spark, root, "v long").collect())


def test_only_committed_folders_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    log = CommitLog(spark, root)
    assert values(spark, root) == [] and log.state().version == -1
    with pytest.raises(ValueError, match="nothing is committed"):
        committed_rows(spark, root)
    add(log, 1)
    log.write(spark.createDataFrame([(99,)], "v long"), log.new_folder())  # never committed
    add(log, 2)
    assert values(spark, root) == [1, 2]
    assert log.vacuum(0) == 1 and values(spark, root) == [1, 2]


def test_batches_are_committed_once_per_writer(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert add(log, 1, writer="a", batch=0) is not None
    assert add(log, 2, writer="a", batch=0) is None
    assert add(log, 3, writer="b", batch=0) is not None
    assert add(log, 4, writer="a", batch=1) is not None
    assert values(spark, log.root) == [1, 3, 4]


def test_a_commit_after_another_one_takes_the_next_number(spark, tmp_path):
    a, b = (CommitLog(spark, str(tmp_path / "t")) for _ in range(2))
    old = a.state()
    add(b, 1)
    add(a, 2, state=old)  # its view of the table is out of date
    assert a.state().version == 1 and values(spark, a.root) == [1, 2]


def test_commits_at_the_same_time_all_count(spark, tmp_path):
    root, errors = str(tmp_path / "t"), []
    log = CommitLog(spark, root)
    names = []
    for i in range(12):
        names.append(log.new_folder())
        log.write(spark.createDataFrame([(i,)], "v long"), names[-1])

    def work(part):
        try:
            own = CommitLog(spark, root)
            for i in part:
                own.commit([Folder(names[i], i, i)])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(range(k, 12, 4),)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and log.state().version == 11
    assert values(spark, root) == list(range(12))


def test_removing_what_is_gone_is_a_conflict(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    name = add(log, 1).folders[0].name
    log.commit([], [name])
    with pytest.raises(Conflict):
        log.commit([], [name])
    assert values(spark, log.root) == []


def test_state_is_the_same_after_a_snapshot(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    for i in range(SNAPSHOT_EVERY + 3):
        log.commit([Folder(f"f{i}", i, i)], [f"f{i - 1}"] if i % 2 else [], writer="w", batch=i)
    assert any(n.endswith(".snapshot") for n in os.listdir(f"{log.root}/_log"))
    state = log.state()
    assert state.version == SNAPSHOT_EVERY + 2 and state.batches == {"w": SNAPSHOT_EVERY + 2}
    assert len(state.folders) == (SNAPSHOT_EVERY + 3 + 1) // 2
    # readers need nothing that is older than the snapshot
    for n in os.listdir(f"{log.root}/_log"):
        if not n.endswith(".snapshot") and n.isdigit() and int(n) < SNAPSHOT_EVERY:
            os.remove(f"{log.root}/_log/{n}")
    assert log.state() == state


# ---- native copy


def put(path, name, text, at=None):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)
    if at is not None:
        os.utime(f"{path}/{name}", (at, at))


class Read:
    """The reader, and the files it was asked for."""

    def __init__(self, spark):
        self.spark, self.asked = spark, []

    def __call__(self, paths):
        self.asked.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        return read_delimited(self.spark, paths, SCHEMA, with_file=True)


def copied(copy):
    return sorted((r.name, r.n) for r in copy.table().collect())


def test_only_new_files_are_read(spark, tmp_path):
    src, read = str(tmp_path / "in"), Read(spark)
    put(src, "a b.txt", "a,1\nb,2\n")
    put(src, "c.txt", "c,3\n")
    copy = NativeCopy(spark, src, str(tmp_path / "copy"), read)
    with pytest.raises(ValueError, match="nothing is copied"):
        copy.table()
    assert copy.refresh() == {"new": 2, "changed": 0, "gone": 0, "commits": 1}
    put(f"{src}/sub", "d.txt", "d,4\n")
    put(src, "empty.txt", "")  # Spark lists no empty file, and it has no row
    assert copy.refresh() == {"new": 1, "changed": 0, "gone": 0, "commits": 1}
    assert copy.refresh() == {"new": 0, "changed": 0, "gone": 0, "commits": 0}
    assert read.asked == [["a b.txt", "c.txt"], ["d.txt"]]
    assert copied(copy) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert copied(NativeCopy(spark, src, str(tmp_path / "copy"), read)) == copied(copy)


def test_changed_and_vanished_files(spark, tmp_path):
    src, read = str(tmp_path / "in"), Read(spark)
    for n in "abc":
        put(src, f"{n}.txt", f"{n},1\n", at=1_600_000_000)
    copy = NativeCopy(spark, src, str(tmp_path / "copy"), read)
    copy.refresh()
    put(src, "a.txt", "a,2\n", at=1_600_000_009)  # as long as before
    os.remove(f"{src}/b.txt")
    with pytest.raises(RuntimeError, match="1 files changed and 1 vanished"):
        copy.refresh()
    assert copied(copy) == [("a", 1), ("b", 1), ("c", 1)]
    again = NativeCopy(spark, src, str(tmp_path / "copy"), read, on_changed="reload")
    assert again.refresh() == {"new": 0, "changed": 1, "gone": 1, "commits": 1}
    assert read.asked[1:] == [["a.txt"]]
    assert copied(again) == [("a", 2), ("c", 1)]
    put(src, "b.txt", "b,7\n")
    assert again.refresh()["new"] == 1
    assert copied(again) == [("a", 2), ("b", 7), ("c", 1)]


def test_a_copy_that_stopped_goes_on_where_it_was(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(5):
        put(src, f"f{i}.txt", f"r{i},{i}\n")
    read = Read(spark)

    def stops(paths):
        if len(read.asked) == 1:
            raise RuntimeError("lost the driver")
        return read(paths)

    options = {"files_per_commit": 2}
    with pytest.raises(RuntimeError, match="lost the driver"):
        NativeCopy(spark, src, str(tmp_path / "copy"), stops, **options).refresh()
    copy = NativeCopy(spark, src, str(tmp_path / "copy"), read, **options)
    assert copied(copy) == [("r0", 0), ("r1", 1)]  # whole commits only
    assert copy.refresh() == {"new": 3, "changed": 0, "gone": 0, "commits": 2}
    assert read.asked == [["f0.txt", "f1.txt"], ["f2.txt", "f3.txt"], ["f4.txt"]]
    assert copied(copy) == [(f"r{i}", i) for i in range(5)]


def test_two_runs_at_once_copy_a_file_once(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "copy")
    put(src, "a.txt", "a,1\n")
    inner = NativeCopy(spark, src, root, Read(spark))

    def meanwhile(paths):
        inner.refresh()
        return Read(spark)(paths)

    with pytest.raises(RuntimeError, match="another run"):
        NativeCopy(spark, src, root, meanwhile).refresh()
    assert copied(inner) == [("a", 1)]


def test_a_copy_of_archives(spark, tmp_path):
    import zipfile

    src = str(tmp_path / "z")
    os.makedirs(src)

    def pack(name, body):
        with zipfile.ZipFile(f"{src}/{name}", "w") as z:
            z.writestr("e", body)

    read = lambda paths: read_archives(spark, paths, SCHEMA, with_file=True)
    copy = NativeCopy(spark, src, str(tmp_path / "copy"), read, pattern=".*\\.zip", on_changed="reload")
    pack("a.zip", "a,1\n")
    put(src, "no.txt", "x,9\n")
    copy.refresh()
    time.sleep(0.01)
    pack("b.zip", "b,2\n")
    pack("a.zip", "a,1\na,5\n")
    assert copy.refresh() == {"new": 1, "changed": 1, "gone": 0, "commits": 1}
    assert copied(copy) == [("a", 1), ("a", 5), ("b", 2)]


@pytest.mark.parametrize("merged_bytes", [64 << 20, 1])
def test_rows_are_merged_as_they_are_without_a_shuffle(spark, tmp_path, monkeypatch, merged_bytes):
    from rowsmith.sinks import commits

    monkeypatch.setattr(commits, "MERGED_BYTES", merged_bytes)
    log = CommitLog(spark, str(tmp_path / "t"))
    for i in range(5):
        name = log.new_folder()
        log.write(spark.createDataFrame([(i, "x" if j % 2 else None) for j in range(3)] * 2, "a int, b string").repartition(3), name)
        log.commit([Folder(name, i, i)])
    spark.sparkContext.setJobGroup(str(tmp_path), "")
    state = log.merge(None, 4)
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup(str(tmp_path)) for s in status.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 2  # the schema, the rows
    assert sorted((f.level, f.first_batch, f.last_batch) for f in state.folders) == [(0, 4, 4), (1, 0, 3)]
    got = sorted(log.read().collect(), key=str)
    assert got == sorted([(i, "x" if j % 2 else None) for i in range(5) for j in range(3)] * 2, key=str)
    merged = next(f for f in state.folders if f.level == 1)
    files = [f for f in os.listdir(log.path(merged.name)) if f.endswith(".parquet")]
    assert len(files) == 1 if merged_bytes > 1 else len(files) > 1
