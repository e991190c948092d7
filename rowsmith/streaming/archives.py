"""Archives that arrive in a folder, as a stream of their lines.

The source is Spark's file stream over the listing: its offset is the set of archives seen, kept in the stream's checkpoint, and only paths and
lengths are read by it. Each batch reads the lines of its new archives with ``read_archive_lines`` (large ones in parallel) and commits them
whole (``sinks.commits``): an archive is in one committed batch, also after a failure or a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowsmith.sources.archives import read_archive_lines
from rowsmith.sources.delimited import name_matches, session_flags
from rowsmith.streaming.words import BATCH_INTERVAL, MERGE_FAN, per_batch, start

# Spark keeps listings in the driver's memory, also those of a stream: the whole folder once a stream, then each batch's files.
# Nothing reads them again.
KEEP_NO_LISTINGS = {"spark.sql.hive.manageFilesourcePartitions": "false"}

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def archive_listing(
    spark: SparkSession,
    path: str,
    *,
    pattern: str | None = None,
    pattern_on: str = "name",
    share: str | None = None,
    max_files_per_trigger: int | None = None,
    max_file_age: str = "3650d",
) -> DataFrame:
    """``path, length`` of the archives under ``path`` as a stream; each is given once.

    ``share`` is a glob of base names: other files make no batch, so several streams can take a share each (``pattern`` leaves
    the batches as they are and drops rows from them).

    Write an archive under a name that starts with a dot and rename it when it is whole. An archive whose modification time lies
    more than ``max_file_age`` before that of the newest one seen is passed over (Spark forgets older names).
    """
    r = spark.readStream.format("binaryFile").schema(_LISTING).option("maxFileAge", max_file_age)
    if share:
        r = r.option("pathGlobFilter", share)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    with session_flags(spark, KEEP_NO_LISTINGS):
        listing = r.load(path)
    if pattern:
        listing = listing.where(name_matches(pattern, pattern_on))
    return listing.select("path", "length")


def scanned_files(batch: DataFrame) -> tuple[int, int] | None:
    """Bytes and number of the files that a batch's scan was planned for, without a job; None where it scans no files."""
    size = count = 0
    for part in batch._jdf.queryExecution().toRdd().partitions():
        if part.getClass().getSimpleName() != "FilePartition":
            return None
        files = [f.fileSize() for f in part.files()]
        size, count = size + sum(files), count + len(files)
    return size, count


def stream_archive_lines(
    listing: DataFrame,
    out: str,
    checkpoint: str,
    *,
    compute: Callable[[DataFrame], DataFrame] | None = None,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
    merge_fan: int | None = MERGE_FAN,
    **reader_options,
) -> StreamingQuery:
    """Write the lines of each batch's archives, or ``compute`` of them; read them with ``streaming.words.batches``."""

    def lines(batch: DataFrame) -> DataFrame:
        found = read_archive_lines(batch.sparkSession, batch, listed=scanned_files(batch), **reader_options)
        return compute(found) if compute else found

    sink = per_batch(out, checkpoint, lines, merge_fan=merge_fan)
    with session_flags(listing.sparkSession, KEEP_NO_LISTINGS):  # a stream takes the options that hold when it starts
        return start(listing.writeStream.foreachBatch(sink), checkpoint, trigger, available_now)
