"""Tables written back as delimited lines, and materialised copies of scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.functions.text import format_line

#: Spark's setting: files of several folders that a task keeps open instead of sorting its rows by folder.
OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"


def format_lines(df: DataFrame, delimiter: str = ",", columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Each row as one ``value`` line: cells as text, null as ``NULL``, literal delimiter, no quoting.

    ``keep`` carries extra columns (for example partition columns) next to ``value``.
    """
    cols = columns if columns is not None else [c for c in df.columns if c not in (keep or [])]
    return df.select(*(keep or []), format_line(cols, delimiter).alias("value"))


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    delimiter: str = ",",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    compression: str | None = None,
    balance: bool = True,
    open_folders: int = 0,
) -> str:
    """Write ``df`` as delimited text files (one part file per task, ``\\n`` line ends).

    The delimiter is written literally (the readers take a regex: escape
    regex characters such as ``|`` when reading back). ``partition_by``
    columns become folder names and are left out of the lines; with
    ``balance`` the rows are first rebalanced on them, so adaptive execution
    splits a very large folder over several tasks and merges small ones
    instead of every task writing a small file into every folder. Without
    it no row is shuffled; a task that meets at most ``open_folders`` of the
    folders keeps a file open in each, so that its rows need no sort either.
    """
    lines = format_lines(df, delimiter, keep=partition_by)
    if partition_by and balance:
        lines = lines.hint("rebalance", *partition_by)
    writer = lines.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FOLDERS)
    if open_folders:
        conf.set(OPEN_FOLDERS, str(open_folders))
    try:
        writer.text(path)
    finally:
        conf.set(OPEN_FOLDERS, before)
    return path


def materialize(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Copy a scan once into a columnar table of the same columns and read that instead.

    Later queries then read a columnar, pushdown-capable copy rather than
    re-parsing text; the write also cuts the lineage back to the text files.
    """
    df.write.mode(mode).format(fmt).save(path)
    spark = SparkSession.getActiveSession() or df.sparkSession
    return spark.read.format(fmt).load(path)
