"""A native copy of a folder of external files that is brought up to date by reading new files only.

The copy is a table with a commit log (``sinks.commits``). Beside the rows every commit keeps a manifest of the files it read: path, length
and time of last change. A later run joins the listing with the manifests and reads what is not in them; rows and manifest become visible in one commit.
A file that changed is read again and one that vanished is forgotten (``on_changed='reload'``), or both stop the run (``'fail'``, the default).

Listing, manifests and their comparison are DataFrames. What reaches the driver is the paths of the files to read, which Spark's reader takes as
a list; they are read ``files_per_commit`` at a time, each time in a commit of its own, so that a first copy of very many files can be taken up where
it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.sinks.commits import CommitLog, Folder, State
from rowsmith.sources.delimited import name_matches

#: Column that the reader must give each row: the file it comes from.
FILE = "file_path"
#: Most files that one commit reads.
FILES_PER_COMMIT = 10_000
MANIFEST_SCHEMA = "file_path string, bytes long, changed timestamp, version long, gone boolean"


def _listing(spark: SparkSession, path: str | list[str], pattern: str | None, pattern_on: str) -> DataFrame:
    """file_path (as rows carry it), path (as readers take it), bytes, changed of the matching files (no content is read)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path if isinstance(path, str) else list(path))
    if pattern:
        found = found.where(name_matches(pattern, pattern_on))
    return found.select(
        F.col("_metadata.file_path").alias(FILE), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed")
    )


class NativeCopy:
    """The copy under ``root`` of the files under ``path``; ``read(paths)`` gives their rows with the column ``file_path``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str | list[str],
        root: str,
        read: Callable[[list[str]], DataFrame],
        *,
        pattern: str | None = None,
        pattern_on: str = "name",
        on_changed: str = "fail",
        files_per_commit: int = FILES_PER_COMMIT,
    ):
        if on_changed not in ("fail", "reload"):
            raise ValueError("on_changed must be 'fail' or 'reload'")
        self.spark, self.path, self.reader = spark, path, read
        self.pattern, self.pattern_on, self.on_changed, self.files_per_commit = pattern, pattern_on, on_changed, files_per_commit
        self.log = CommitLog(spark, root)

    # a commit's folder holds ``rows`` and ``manifest``
    def _parts(self, state: State, part: str) -> list[str]:
        return [f"{self.log.path(f.name)}/{part}" for f in state.folders]

    def _manifest(self, state: State) -> DataFrame:
        """The newest entry of every file that is in the copy."""
        paths = self._parts(state, "manifest")
        if not paths:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        entries = self.spark.read.schema(MANIFEST_SCHEMA).parquet(*paths)
        newest = entries.groupBy(FILE).agg(F.max_by(F.struct("bytes", "changed", "version", "gone"), "version").alias("e"))
        return newest.select(FILE, "e.*").where(~F.col("gone")).drop("gone")

    def refresh(self) -> dict[str, int]:
        """Read what is new; how many files were new, changed and gone, and how many commits that took."""
        state = self.log.state()
        known = self._manifest(state).select(FILE, F.struct("bytes", "changed").alias("was"))
        listed = _listing(self.spark, self.path, self.pattern, self.pattern_on).select(
            FILE, "path", F.struct("bytes", "changed").alias("now")
        )
        both = listed.join(known, FILE, "full_outer")
        kind = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("was") != F.col("now"), "changed")
        todo = both.select(FILE, "path", "now.*", kind.alias("kind")).where(F.col("kind").isNotNull())
        todo = todo.orderBy(FILE).collect()  # the files to read, which the reader takes as a list of paths
        count = {k: sum(r.kind == k for r in todo) for k in ("new", "changed", "gone")}
        if self.on_changed == "fail" and (count["changed"] or count["gone"]):
            first = next(r for r in todo if r.kind != "new")
            raise RuntimeError(f"{count['changed']} files changed and {count['gone']} vanished since they were read, first {first[FILE]}")
        count["commits"] = 0
        for at in range(0, len(todo), self.files_per_commit):
            state = self._take(todo[at : at + self.files_per_commit], state)
            count["commits"] += 1
        return count

    def _take(self, files: list, state: State) -> State:
        name, version = self.log.new_folder(), state.version + 1
        paths = [r.path for r in files if r.kind != "gone"]
        if paths:
            rows = self.reader(paths).withColumn("copy_version", F.lit(version).cast("long"))
            rows.write.parquet(f"{self.log.path(name)}/rows")
        entries = [(r[FILE], r.bytes, r.changed, version, r.kind == "gone") for r in files]
        self.spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1).write.parquet(f"{self.log.path(name)}/manifest")
        # another run that committed in between read some of the same files: this one's version is taken and it must start anew
        done = self.log.commit([Folder(name, version, version)], writer="copy", batch=version, state=state)
        if done is None or done.version != version:
            raise RuntimeError("another run brought the copy up to date at the same time: refresh again")
        return done

    def table(self) -> DataFrame:
        """The rows of all files in the copy, each from its newest reading."""
        state = self.log.state()
        paths = self._parts(state, "rows")
        paths = [p for p in paths if self.log.fs.exists(self.log._path(p))]
        if not paths:
            raise ValueError("nothing is copied yet: refresh first")
        rows = self.spark.read.parquet(*paths)
        entries = self.spark.read.schema(MANIFEST_SCHEMA).parquet(*self._parts(state, "manifest"))
        # readings that a later one replaced: few, and no row is joined where there are none
        read = entries.groupBy(FILE).agg(F.max("version").alias("newest"), F.collect_list("version").alias("versions"))
        old = read.select(FILE, F.explode(F.filter("versions", lambda v: v < F.col("newest"))).alias("copy_version"))
        if old.limit(1).count():
            rows = rows.join(old, [FILE, "copy_version"], "left_anti")
        return rows.drop("copy_version")
