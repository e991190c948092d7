"""Lines of text in encodings of 2 and 4 byte units (UTF-16, UTF-32), read in parallel.

Spark's text source cuts lines at single bytes, which these encodings use inside characters. Here files are cut into ranges of ``split_bytes`` that
are aligned to whole units and hold whole lines (``line_ranges``); each task decodes its range a chunk at a time and hands on Arrow
batches, so a file of any size is read by many tasks and no line, however long, is cut. The listing comes from Spark, content never passes
through the driver.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.session import default_parallelism, input_bytes
from rowsmith.sources.line_ranges import line_arrays, line_start, open_archive, range_chunks

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
BATCH_LINES = 8192

_NAME = re.compile(r"(?:x-)?utf[-_]?(16|32)[-_]?(le|be)?", re.IGNORECASE)


def wide_encoding(name: str) -> tuple[int, bool | None] | None:
    """Bytes of a unit and whether the high byte comes first (None: a byte order mark says); None for other encodings."""
    m = _NAME.fullmatch(name.strip())
    if m is None:
        return None
    order = (m.group(2) or "").lower()
    return int(m.group(1)) // 8, {"le": False, "be": True, "": None}[order]


def byte_order(f, width: int) -> tuple[bool, int]:
    """Whether the high byte comes first, and the bytes of the mark; without one it does, as in the JVM."""
    f.seek(0)
    head = f.read(width)
    for big, name in ((True, "be"), (False, "le")):
        if head == "﻿".encode(f"utf-{8 * width}-{name}"):
            return big, width
    return True, 0


def wide_lines(
    f, size: int, start: int, end: int, encoding: str, on_bad_bytes: str = "fail", strip_cr: bool = False, chunk: int = CHUNK
) -> Iterator[pa.Array]:
    """The lines that start in ``start .. end`` of an open file, as arrays of strings."""
    width, big = wide_encoding(encoding)
    mark = 0
    if big is None:
        big, mark = byte_order(f, width)
    first, last = (line_start(f, at, size, width, big, not strip_cr) for at in (start, end))
    errors = "strict" if on_bad_bytes == "fail" else "replace"
    decoder = codecs.getincrementaldecoder(f"utf-{8 * width}-{'be' if big else 'le'}")(errors)

    def decoded() -> Iterator[bytes]:
        for piece in range_chunks(f, max(first, mark), last, chunk):
            yield text_of(decoder.decode(piece))
        yield text_of(decoder.decode(b"", True))  # half a character at the end of the file is bad too

    def text_of(text: str) -> bytes:
        return (text.replace("\r", "") if strip_cr else text).encode("utf-8")

    for lines, closed in line_arrays(decoded()):
        if closed or len(lines[0].as_py()):
            yield lines.cast(pa.large_string()).cast(pa.string())


def _lines_task(encoding: str, on_bad_bytes: str, strip_cr: bool, split_bytes: int, with_file: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_archive(row["path"]) as f:
                    found = wide_lines(f, row["length"], row["start"], row["start"] + split_bytes, encoding, on_bad_bytes, strip_cr)
                    for lines in found:
                        for at in range(0, len(lines), BATCH_LINES):
                            part = lines.slice(at, BATCH_LINES)
                            columns = [part]
                            if with_file:
                                columns += [pa.array([row[c]] * len(part), pa.string()) for c in ("file_path", "file_name")]
                            yield pa.RecordBatch.from_arrays(columns, ["value", "file_path", "file_name"][: len(columns)])

    return run


def read_wide_lines(
    spark: SparkSession,
    path: str | list[str],
    encoding: str,
    *,
    matches=None,
    strip_cr: bool = False,
    on_bad_bytes: str = "fail",
    with_file: bool = False,
    split_bytes: int = SPLIT_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Lines of every file under ``path`` as ``value string`` (see ``delimited.read_lines``, which calls this)."""
    split_bytes = max(4, split_bytes // 4 * 4)  # whole units
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    if matches is not None:
        files = files.where(matches)
    own = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")]
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "length", *own).select("*", starts.alias("start"))
    n = partitions or max(default_parallelism(spark), -(-input_bytes(spark, path) // split_bytes))
    schema = "value string" + (", file_path string, file_name string" if with_file else "")
    return ranges.repartition(n).mapInArrow(_lines_task(encoding, on_bad_bytes, strip_cr, split_bytes, with_file), schema)
