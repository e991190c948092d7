"""Zip archives as tables of lines.

Every archive is one continuous text: the bytes of its non-directory entries,
in order, with no separator (so an entry that does not end in a line end runs
into the next one; ``entry_newline=True`` ends a line at every entry
instead). The header counter (``first_data_line``) and the end sentinel
(``sentinel``: a line equal to it ends the archive, later entries included)
count per archive.

Plan: the ``binaryFile`` listing (``path`` only, so Spark reads no content)
is filtered by name, spread round-robin over ``partitions`` tasks (a
deterministic shuffle of paths, not of data), and each task opens its archives
from the shared file system and streams the entries through ``zipfile`` in
1 MiB chunks. Line ends are found with numpy and every chunk's lines become
one Arrow array, cut into batches of at most ``BATCH_LINES`` rows: no archive
is held whole in memory, none passes through the driver, and no Python runs
per line. Archives above ``split_bytes`` are read in parallel units of
entries instead of in one task (``archive_units``), and those that hold one very
large entry are decoded once and parsed in parallel (``spool``), with the same result.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.operators.fields import as_schema
from rowsmith.session import default_parallelism, input_bytes
from rowsmith.sources.delimited import name_matches, parse_delimited
from rowsmith.sources.line_ranges import line_arrays, open_archive

# What zipfile raises for an entry that can't be decompressed.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)

LINES_SCHEMA = "file_path string, file_name string, line_no bigint, value string"
BATCH_LINES = 8192
BATCH_BYTES = 4 << 20
CHUNK = 1 << 20
# Archives above SPLIT_BYTES (compressed) are read in parallel units of about UNIT_BYTES (uncompressed).
SPLIT_BYTES = 256 << 20
UNIT_BYTES = 256 << 20
# Compressed bytes of archives per task, at least as many tasks as the cluster has slots.
TASK_BYTES = 64 << 20
# Of a listing that is given (a stream's batch): so many bytes or archives are worth a task of their own.
LEAST_BYTES = 4 << 20
LEAST_FILES = 64


def coalesce_chunks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Join small pieces (many small entries) into chunks of about ``CHUNK`` bytes.

    Where reading fails, what was read before is passed on first, so the lines
    before a broken entry are seen whatever the sizes of the entries.
    """
    buf = bytearray()
    try:
        for p in pieces:
            if not buf and len(p) >= CHUNK:
                yield p
                continue
            buf += p
            if len(buf) >= CHUNK:
                yield bytes(buf)
                buf = bytearray()
    except BROKEN:
        if buf:
            yield bytes(buf)
        raise
    if buf:
        yield bytes(buf)


def entry_pieces(infos, zf: zipfile.ZipFile, entry_newline: bool) -> Iterator[bytes]:
    """The bytes of the given entries in order, read in pieces of at most ``CHUNK``."""
    for info in infos:
        last = b""
        with zf.open(info) as f:
            while True:
                b = f.read(CHUNK)
                if not b:
                    break
                last = b
                yield b
        if entry_newline and last and last[-1:] not in (b"\n", b"\r"):
            yield b"\n"


def entry_chunks(zf: zipfile.ZipFile, entry_newline: bool) -> Iterator[bytes]:
    infos = [i for i in zf.infolist() if not i.is_dir()]
    return coalesce_chunks(entry_pieces(infos, zf, entry_newline))


class BatchBuilder:
    """Collects numbered line arrays of many archives into Arrow batches of up to ``BATCH_LINES`` rows and
    ``BATCH_BYTES`` of lines (a longer line is a batch of its own)."""

    def __init__(self, encoding: str, with_file: bool, on_bad_bytes: str = "replace"):
        self.encoding, self.with_file, self.on_bad_bytes = encoding, with_file, on_bad_bytes
        self.parts: list = []
        self.rows = self.bytes = 0

    def add(self, uri: str, name: str, first_no: int, lines) -> Iterator:
        """Add lines numbered from ``first_no``; yields the batches that became full."""
        import numpy as np
        import pyarrow.compute as pc

        if not len(lines):
            return
        ends = np.cumsum(pc.binary_length(lines).to_numpy(zero_copy_only=False))
        i = 0
        while i < len(lines):
            before = int(ends[i - 1]) if i else 0
            fits = int(np.searchsorted(ends, before + BATCH_BYTES - self.bytes, "right")) - i
            take = min(len(lines) - i, BATCH_LINES - self.rows, fits)
            if take <= 0 and self.rows:
                yield self.flush()
                continue
            take = max(take, 1)
            self.parts.append((uri, name, first_no + i, lines.slice(i, take)))
            i += take
            self.rows += take
            self.bytes += int(ends[i - 1]) - before
            if self.rows >= BATCH_LINES or self.bytes >= BATCH_BYTES:
                yield self.flush()

    def flush(self):
        import numpy as np
        import pyarrow as pa

        paths, names, numbers, values = [], [], [], []
        for uri, name, first_no, lines in self.parts:
            fp, fn = file_columns(uri, name, len(lines), self.with_file)
            paths.append(fp)
            names.append(fn)
            numbers.append(np.arange(first_no, first_no + len(lines), dtype=np.int64))
            values.append(lines)
        self.parts, self.rows, self.bytes = [], 0, 0
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(paths),
                pa.concat_arrays(names),
                pa.array(np.concatenate(numbers)),
                decode_array(pa.concat_arrays(values), self.encoding, self.on_bad_bytes),
            ],
            names=["file_path", "file_name", "line_no", "value"],
        )


def decode_array(lines, encoding: str, on_bad_bytes: str = "replace"):
    """Arrow string array of binary lines; bad bytes become U+FFFD as the JVM reader does, or fail."""
    import pyarrow as pa

    if encoding.replace("_", "-").lower() in ("utf-8", "utf8"):
        try:
            return lines.cast(pa.large_string()).cast(pa.string())
        except (pa.ArrowInvalid, UnicodeDecodeError):
            pass
    errors = "strict" if on_bad_bytes == "fail" else "replace"
    raw = lines.to_pylist()
    # One decode for all lines: none holds a line end, and no charset takes one into a character.
    texts = b"\n".join(raw).decode(encoding, errors).split("\n") if raw else []
    if len(texts) != len(raw):
        texts = [x.decode(encoding, errors) for x in raw]
    return pa.array(texts, pa.string())


def is_sentinel(lines, sentinel: str, encoding: str):
    """Boolean array: which of the binary lines are the sentinel. Bytes are compared, or decoded
    lines where the sentinel holds U+FFFD (it can then equal a badly encoded line)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if "\ufffd" in sentinel:
        return pc.equal(decode_array(lines, encoding), pa.scalar(sentinel))
    return pc.equal(lines, pa.scalar(sentinel.encode(encoding), pa.large_binary()))


def numbered_arrays(chunks: Iterator[bytes], first_data_line: int, sentinel: str | None, encoding: str):
    """``(number of the first line, binary array)`` blocks after the header and sentinel rules.

    Nothing after the block that holds the sentinel is read.
    """
    import pyarrow.compute as pc

    start = 1
    for lines, closed in line_arrays(chunks):
        if not closed and not len(lines[0].as_py()):
            return
        n = len(lines)
        skip = min(max(first_data_line - start, 0), n)
        kept = lines.slice(skip)
        stop = -1
        if sentinel is not None and len(kept):
            stop = pc.index(is_sentinel(kept, sentinel, encoding), True).as_py()
            if stop >= 0:
                kept = kept.slice(0, stop)
        if len(kept):
            yield start + skip, kept
        if stop >= 0:
            return
        start += n


def file_columns(uri: str, name: str, n: int, with_file: bool):
    """``file_path, file_name`` of ``n`` lines: the values, or all-null columns when not wanted
    (a Python task's output is not pruned, so unwanted columns should cost nothing)."""
    import pyarrow as pa

    if not with_file:
        return [pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
    return [pa.array([uri] * n, pa.string()), pa.array([name] * n, pa.string())]


def lines_task(opts: dict):
    def run(batches):
        out = BatchBuilder(opts["encoding"], opts["with_file"], opts["on_bad_bytes"])
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                name = unquote(uri.rsplit("/", 1)[-1])
                with open_archive(uri) as fh:
                    try:
                        zf = zipfile.ZipFile(fh)
                    except zipfile.BadZipFile:
                        if opts["on_bad_archive"] == "skip":
                            continue
                        raise ValueError(f"not a zip archive: {uri}") from None
                    with zf:
                        chunks = entry_chunks(zf, opts["entry_newline"])
                        blocks = numbered_arrays(chunks, opts["first_data_line"], opts["sentinel"], opts["encoding"])
                        for start, lines in blocks:
                            yield from out.add(uri, name, start, lines)
        if out.rows:
            yield out.flush()

    return run


def archive_tasks(paths: DataFrame, opts: dict, partitions: int) -> DataFrame:
    """The lines of the archives ``path``, each read by one task in one pass (all by one task: without a shuffle)."""
    dealt = paths.repartition(partitions) if partitions > 1 else paths.coalesce(1)
    return dealt.mapInArrow(lines_task(opts), LINES_SCHEMA)


def list_archives(spark: SparkSession, path: str | list[str], pattern: str | None = None, pattern_on: str = "name") -> DataFrame:
    """``path, length`` of the archives under ``path`` (no content is read)."""
    listing = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    if pattern:  # an empty pattern is the default: every archive
        listing = listing.where(name_matches(pattern, pattern_on))
    return listing.select("path", "length")


def read_archive_lines(
    spark: SparkSession,
    path: str | list[str] | DataFrame,
    *,
    pattern: str | None = None,
    pattern_on: str = "name",
    first_data_line: int = 1,
    sentinel: str | None = "EOF",
    entry_newline: bool = False,
    on_bad_archive: str = "fail",
    encoding: str = "utf-8",
    on_bad_bytes: str = "replace",
    partitions: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    unit_bytes: int = UNIT_BYTES,
    spool_bytes: int | None = None,
    piece_bytes: int | None = None,
    with_file: bool = True,
    listed: tuple[int, int] | None = None,
) -> DataFrame:
    """Lines of every archive: ``file_path, file_name, line_no, value`` (blank lines kept).

    ``path`` may also be a listing, ``path, length`` of the archives to read (then without ``pattern``);
    ``listed`` gives its bytes and number of archives, or more than those, where they are known (else a job adds them up).
    ``line_no`` is the physical line number in the archive's continuous
    text. ``on_bad_archive='skip'`` reads a file that is not a zip as empty.
    An entry that can't be decompressed fails the read, unless the sentinel
    ends the archive before it: so whatever the size of the archive.
    Archives larger than ``split_bytes`` are read in parallel in units of
    about ``unit_bytes`` of entries (see ``archive_units``), or, where an entry holds more than ``spool_bytes``,
    decoded by one task and parsed by many (see ``spool``); the rest are
    read one archive per task in a single pass. ``with_file=False`` leaves
    ``file_path`` and ``file_name`` null.
    """
    if on_bad_archive not in ("fail", "skip"):
        raise ValueError("on_bad_archive must be 'fail' or 'skip'")
    if on_bad_bytes not in ("fail", "replace"):
        raise ValueError("on_bad_bytes must be 'fail' or 'replace'")
    if first_data_line < 1:
        raise ValueError("first_data_line starts at 1")
    if isinstance(path, DataFrame):
        if pattern:
            raise ValueError("filter the listing itself")
        listing = path
        total, files = listed or listing.agg(F.sum("length"), F.count(F.lit(1))).first()
        total = total or 0
        # a small batch is not dealt out to more tasks than it is worth
        least = max(-(-total // LEAST_BYTES), -(-files // LEAST_FILES), 1)
    else:
        listing = list_archives(spark, path, pattern, pattern_on)
        total, least = input_bytes(spark, path), default_parallelism(spark)
    n = partitions or max(min(default_parallelism(spark), least), -(-total // TASK_BYTES))
    opts = {
        "first_data_line": first_data_line,
        "sentinel": sentinel,
        "entry_newline": entry_newline,
        "on_bad_archive": on_bad_archive,
        "encoding": encoding,
        "on_bad_bytes": on_bad_bytes,
        "with_file": with_file,
    }
    # The unit path is planned only when needed: where all files together are small, no
    # job runs for it; else one over the listing (no archive content is read).
    if total <= split_bytes:
        return archive_tasks(listing.select("path"), opts, n)
    lines = archive_tasks(listing.where(F.col("length") <= split_bytes).select("path"), opts, n)
    large = listing.where(F.col("length") > split_bytes).select("path")
    if large.limit(1).count() == 0:
        return lines
    from rowsmith.sources import spool
    from rowsmith.sources.archive_units import read_large_archive_lines

    limit = spool.SPOOL_BYTES if spool_bytes is None else spool_bytes
    entries = spool.largest_entries(large, n)
    counts = entries.agg(F.count_if(F.col("largest") > limit), F.count_if(F.col("largest") <= limit)).first()
    if counts[1]:
        lines = lines.unionByName(read_large_archive_lines(entries.where(F.col("largest") <= limit).select("path"), opts, unit_bytes, n))
    if counts[0]:
        huge = entries.where(F.col("largest") > limit).select("path")
        lines = lines.unionByName(spool.spooled_lines(huge, opts, piece_bytes or spool.PIECE_BYTES, n))
    return lines


def read_archives(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    columns: list[str] | None = None,
    delimiter: str = ",",
    null_value: str | None = None,
    with_file: bool = False,
    **archive_options,
) -> DataFrame:
    """Zip archives of delimited lines as a typed table (blank lines dropped)."""
    lines = read_archive_lines(spark, path, with_file=with_file, **archive_options)
    keep = ["file_path", "file_name"] if with_file else None
    return parse_delimited(lines, as_schema(schema), columns=columns, delimiter=delimiter, null_value=null_value, keep=keep)
