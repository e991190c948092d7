"""Scan audit: which files a scan matched or discarded, their sizes and line counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.session import default_parallelism, input_bytes, scratch_path
from rowsmith.sources.delimited import name_matches

#: Bytes of splits that one task of a split audit reads, at least as many tasks as the cluster has slots.
TASK_BYTES = 32 << 20


def scan_audit(
    spark: SparkSession,
    path: str | list[str],
    *,
    pattern: str | None = None,
    pattern_on: str = "name",
    count_lines: bool = True,
) -> DataFrame:
    """One row per file under ``path``: ``file_path, file_name, bytes, matched, lines``.

    ``lines`` is null for files the pattern discards (they are not read).

    The listing comes from the ``binaryFile`` source without reading content;
    line counts come from a text scan of the matched files only (a partial
    count per task, then one row per file), joined back on the file path.
    """
    listing = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    matched = name_matches(pattern, pattern_on) if pattern else F.lit(True)
    files = listing.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("length").alias("bytes"),
        matched.alias("matched"),
    )
    if not count_lines:
        return files
    text = spark.read.text(path if isinstance(path, str) else list(path))
    if pattern:
        text = text.where(name_matches(pattern, pattern_on))
    counts = text.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("lines"))
    return files.join(counts, "file_path", "left").select(
        "file_path",
        "file_name",
        "bytes",
        "matched",
        F.when(F.col("matched"), F.coalesce("lines", F.lit(0))).alias("lines"),
    )


def split_audit(
    spark: SparkSession,
    path: str | list[str],
    *,
    pattern: str | None = None,
    pattern_on: str = "name",
    split_bytes: int | None = None,
) -> DataFrame:
    """One row per split that the text scan of ``path`` reads lines from: ``file_path, file_name, file_bytes, split_start, split_bytes, lines``.

    The ranges are those of Spark's own file splits (``_metadata``); a line counts in the split in which it starts, so a split that lies inside
    one long line has no row, and the lines of a file's splits add up to the file's. One partial count per task and split, then one row
    per split.

    ``split_bytes`` bounds the splits of this scan alone: it is a setting of the session when the plan runs, so the scan runs at once, in a session
    of its own, and the audit is read back from the shared scratch folder. A task reads many small splits: their number grows with the
    bytes, not with the splits, and so does what tasks report to the driver.
    """
    session = spark
    if split_bytes is not None:
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        tasks = max(default_parallelism(spark), -(-input_bytes(spark, path) // TASK_BYTES))
        session.conf.set("spark.sql.files.maxPartitionNum", str(tasks))  # packs splits, cuts none anew
    text = session.read.text(path if isinstance(path, str) else list(path))
    if pattern:
        text = text.where(name_matches(pattern, pattern_on))
    meta = {
        "file_path": "file_path",
        "file_name": "file_name",
        "file_bytes": "file_size",
        "split_start": "file_block_start",
        "split_bytes": "file_block_length",
    }
    keys = [F.col(f"_metadata.{of}").alias(name) for name, of in meta.items()]
    found = text.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    if split_bytes is None:
        return found
    out = scratch_path(spark, "split-audit")
    found.write.parquet(out)
    return spark.read.parquet(out)


AUDIT_SCHEMA = "file_path string, file_name string, bytes bigint, matched boolean, is_zip boolean, entries bigint, text_bytes bigint"


def _archive_info_task():
    import zipfile

    import pyarrow as pa

    from rowsmith.sources.archives import open_archive

    def run(batches):
        for batch in batches:
            found = []
            for uri, matched in zip(batch.column("file_path").to_pylist(), batch.column("matched").to_pylist(), strict=True):
                if not matched:
                    found.append((None, None, None))
                    continue
                with open_archive(uri) as fh:
                    try:
                        with zipfile.ZipFile(fh) as zf:
                            infos = [i for i in zf.infolist() if not i.is_dir()]
                            found.append((True, len(infos), sum(i.file_size for i in infos)))
                    except zipfile.BadZipFile:
                        found.append((False, None, None))
            columns = zip(*found, strict=True) if found else [()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "is_zip", "entries", "text_bytes"])

    return run


def archive_audit(
    spark: SparkSession,
    path: str | list[str],
    *,
    pattern: str | None = None,
    pattern_on: str = "name",
    partitions: int | None = None,
) -> DataFrame:
    """One row per file: ``file_path, file_name, bytes, matched, is_zip, entries, text_bytes``.

    Files the pattern keeps are opened to read their central directory only
    (no entry is decompressed): a file that is not a zip shows ``is_zip =
    false``, which is what ``on_bad_archive='skip'`` reads as empty. Files the
    pattern discards are not opened (their zip columns are null).
    """
    listing = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    matched = name_matches(pattern, pattern_on) if pattern else F.lit(True)
    files = listing.select(
        F.col("path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("length").alias("bytes"),
        matched.alias("matched"),
    )
    return files.repartition(partitions or default_parallelism(spark)).mapInArrow(_archive_info_task(), AUDIT_SCHEMA)
