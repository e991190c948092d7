"""Delimited folders and zip archives as registered data sources: ``USING rowsmith_delimited`` / ``rowsmith_archive``.

    register_sources(spark)
    spark.sql("CREATE TEMPORARY VIEW t (name string, n bigint, src string) USING rowsmith_archive "
              "OPTIONS (path '...', pattern '.*5[.]zip', file_column 'src')")
    spark.sql("SELECT name, sum(n) FROM t GROUP BY name")
    spark.sql("INSERT INTO t2 SELECT ...")

Partitions come from the listing: text files are cut into byte ranges of ``split_bytes`` that hold whole lines, small files and archives share a
partition up to that size, and small ranges of a large table share one too. Rows leave a task as Arrow batches. ``file_column`` names a declared column that holds a file's base name instead of a
field; ``pattern`` prunes the listing.

Written rows are lines in files of a hidden folder of the job, which no reader lists; the commit moves them into the table's folder, an abort (a
failed task) deletes the folder, and a commit that fails half-way takes back what it moved. A task that still runs at the abort may write to
the hidden folder again: commits and aborts also clear such folders of other jobs after a day. Overwriting deletes the files from before only when the new ones are in place.

Limits of Python data sources in Spark 4.1, all seen in a probe: the planned reader is kept with the view or DataFrame, so a view shows the listing of its
first query until it is made again, and a filter pushed into the reader by one query would stay for the next one (wrong rows), so filters
are left to Spark; a catalog table (``CREATE TABLE``) doesn't hand its options to the reader, so tables are temporary views.

The readers of ``sources.delimited`` and ``sources.archives`` parse in the JVM and prune columns: they are the way for large scans. These sources
give the same rows through Python tasks, by name, to SQL. A delimiter that is more than one character is a regex of Python's ``re`` here.
"""

from __future__ import annotations

import re
import time
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from rowsmith.functions.arrow_fields import Fields, cell_texts, not_blank, typed
from rowsmith.functions.text import literal_char
from rowsmith.operators.fields import needed_positions
from rowsmith.session import file_system
from rowsmith.sources.archives import decode_array, entry_chunks, line_arrays, numbered_arrays
from rowsmith.sources.line_ranges import line_start, range_chunks
from rowsmith.sources.wide import wide_encoding, wide_lines

SPLIT_BYTES = 128 << 20
READ_BYTES = 1 << 20
#: Beyond so many tasks a task reads several ranges of ``split_bytes``, one after the other.
MANY_TASKS = 256
#: Age at which the hidden folder of a job that never ended its write is deleted.
STALE_NS = 24 * 3600 * 10**9


def register_sources(spark: SparkSession) -> None:
    """Make both sources known to the session by name."""
    spark.dataSource.register(DelimitedSource)
    spark.dataSource.register(ArchiveSource)


@dataclass(frozen=True)
class Piece:
    """A byte range of one file (an archive: all of it)."""

    path: str
    start: int
    end: int
    size: int


class Pieces(InputPartition):
    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces


def _hidden(relative: str) -> bool:
    return any(part.startswith(("_", ".")) for part in relative.split("/"))


def listed_files(path: str) -> list[tuple[str, int]]:
    """(path on its file system, bytes) of every file under a folder, hidden ones left out; a file is itself; sorted."""
    import pyarrow.fs as pafs

    fs, root = file_system(path)
    root = root.rstrip("/")
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    if info.type == pafs.FileType.NotFound:
        return []
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    files = [(i.path, i.size) for i in found if i.type == pafs.FileType.File]
    return sorted((p, n) for p, n in files if not _hidden(p[len(root) :].lstrip("/")))


class _Options:
    """The options of a table: names in any case, blank ones are the defaults."""

    def __init__(self, given: dict[str, str]):
        self.given = {k.lower(): v for k, v in given.items()}
        self.path = self.text("path")
        if not self.path:
            raise ValueError("the table needs an option path")

    def text(self, name: str, default: str | None = None) -> str | None:
        return self.given.get(name) or default

    def number(self, name: str, default: int) -> int:
        value = int(self.text(name, str(default)))
        if value < 1:
            raise ValueError(f"option {name} starts at 1")
        return value

    def flag(self, name: str) -> bool:
        return (self.text(name) or "false").lower() == "true"

    def one_of(self, name: str, *allowed: str) -> str:
        value = self.text(name, allowed[0])
        if value not in allowed:
            raise ValueError(f"option {name} must be one of {', '.join(allowed)}")
        return value


class _Reader(DataSourceReader):
    """What both readers share: options, listing, pruning by name, parsing."""

    def __init__(self, schema: T.StructType, options: dict[str, str], bad_bytes: tuple[str, str]):
        o = _Options(options)
        self.path, self.delimiter = o.path, o.text("delimiter", ",")
        self.encoding, self.null_value = o.text("encoding", "UTF-8"), o.given.get("null_value")
        self.on_bad_bytes = o.one_of("on_bad_bytes", *bad_bytes)
        self.pattern, self.pattern_on = o.text("pattern"), o.one_of("pattern_on", "name", "path")
        self.split_bytes = o.number("split_bytes", SPLIT_BYTES)
        self.schema, self.file_column = schema, o.text("file_column")
        fields = [f for f in schema.fields if f.name != self.file_column]
        if self.file_column and len(fields) == len(schema.fields):
            raise ValueError(f"file_column {self.file_column!r} is not a column of the table")
        needed = o.text("columns")
        names = None if needed is None else [c.strip() for c in needed.split(",")]
        self.picked = needed_positions(T.StructType(fields), names)

    def matched(self) -> list[tuple[str, int]]:
        """The listed files that the pattern leaves: the others make no partition and are never opened."""
        found = listed_files(self.path)
        if not self.pattern:
            return found
        return [(p, n) for p, n in found if re.fullmatch(self.pattern, p.rsplit("/", 1)[-1] if self.pattern_on == "name" else p)]

    def partitions(self) -> list[InputPartition]:
        """The pieces, some a task: tasks of small pieces grow with the table up to ``SPLIT_BYTES``, so that their number stays bounded too."""
        out: list[Pieces] = []
        room = 0
        pieces = list(self.pieces())
        total = sum(p.end - p.start for p in pieces)
        most = max(self.split_bytes, min(SPLIT_BYTES, total // MANY_TASKS))
        for piece in pieces:
            size = piece.end - piece.start
            if size > room or not out:
                out.append(Pieces([]))
                room = most
            out[-1].pieces.append(piece)
            room -= size
        return out or [Pieces([])]

    def pieces(self) -> Iterator[Piece]:
        raise NotImplementedError

    def open(self, path: str):
        fs, _ = file_system(self.path)
        return fs.open_input_file(path)

    def lines(self, piece: Piece) -> Iterator[pa.Array]:
        """Arrays of a piece's lines, as text."""
        raise NotImplementedError

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces if partition is not None else ():
            name = unquote(piece.path.rsplit("/", 1)[-1])
            for lines in self.lines(piece):
                lines = not_blank(lines)
                if len(lines):
                    yield self.batch(lines, name)

    def batch(self, lines: pa.Array, file_name: str) -> pa.RecordBatch:
        n = len(lines)
        columns: dict[str, pa.Array] = {self.file_column: pa.array([file_name] * n, pa.string())} if self.file_column else {}
        if self.picked:
            fields = Fields(lines, self.delimiter)
            columns |= {f.name: typed(fields.field(i), f, self.null_value) for i, f in self.picked}
        kinds = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}
        # a declared column that is not needed is null and never parsed
        arrays = [columns.get(f.name, pa.nulls(n, kinds.get(type(f.dataType), pa.string()))) for f in self.schema.fields]
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in self.schema.fields])


class DelimitedReader(_Reader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        super().__init__(schema, options, ("fail", "replace"))

    def pieces(self) -> Iterator[Piece]:
        for path, size in self.matched():
            for start in range(0, size, self.split_bytes):
                yield Piece(path, start, min(size, start + self.split_bytes), size)

    def lines(self, piece: Piece) -> Iterator[pa.Array]:
        with self.open(piece.path) as f:
            if wide_encoding(self.encoding):
                yield from wide_lines(f, piece.size, piece.start, piece.end, self.encoding, self.on_bad_bytes)
                return
            start, end = (line_start(f, at, piece.size) for at in (piece.start, piece.end))
            for lines, closed in line_arrays(range_chunks(f, start, end, READ_BYTES)):
                if closed or len(lines[0].as_py()):
                    yield decode_array(lines, self.encoding, self.on_bad_bytes)


class ArchiveReader(_Reader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        super().__init__(schema, options, ("replace", "fail"))
        o = _Options(options)
        self.first_data_line, self.entry_newline = o.number("first_data_line", 1), o.flag("entry_newline")
        self.sentinel = o.text("sentinel", "EOF")
        self.on_bad_archive = o.one_of("on_bad_archive", "fail", "skip")

    def pieces(self) -> Iterator[Piece]:
        for path, size in self.matched():
            yield Piece(path, 0, size, size)

    def lines(self, piece: Piece) -> Iterator[pa.Array]:
        with self.open(piece.path) as f:
            try:
                archive = zipfile.ZipFile(f)
            except (zipfile.BadZipFile, pa.ArrowInvalid):  # Arrow's files refuse the seek in a file too short to be a zip
                if self.on_bad_archive == "skip":
                    return
                raise ValueError(f"not a zip archive: {piece.path}") from None
            with archive:
                chunks = entry_chunks(archive, self.entry_newline)
                for _, lines in numbered_arrays(chunks, self.first_data_line, self.sentinel, self.encoding):
                    yield decode_array(lines, self.encoding, self.on_bad_bytes)


@dataclass
class Written(WriterCommitMessage):
    """A task's file, in the job's hidden folder, and its name in the table's."""

    path: str | None
    name: str | None
    rows: int


class LineWriter(DataSourceArrowWriter):
    """Rows as delimited lines, one file a task, moved into the table's folder by the commit."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        o = _Options(options)
        self.path, self.overwrite = o.path, overwrite
        delimiter = o.text("delimiter", ",")
        self.delimiter = o.text("write_delimiter") or literal_char(delimiter) or delimiter
        self.file_column = o.text("file_column")
        self.job = uuid.uuid4().hex

    def folder(self) -> tuple:
        fs, root = file_system(self.path)
        return fs, root.rstrip("/"), f"{root.rstrip('/')}/_writing-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        fs, _, folder = self.folder()
        context = TaskContext.get()
        name = f"part-{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex}.txt"
        rows, out = 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(f"{folder}/{name}")
                cells = [cell_texts(batch.column(i)) for i, f in enumerate(batch.schema.names) if f != self.file_column]
                lines = pc.binary_join_element_wise(*cells, self.delimiter) if cells else pa.array([""] * batch.num_rows)
                out.write(("\n".join(lines.to_pylist()) + "\n").encode())
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(f"{folder}/{name}" if out is not None else None, name, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root, folder = self.folder()
        before = listed_files(self.path) if self.overwrite else []
        moved = []
        try:
            for m in messages:
                if m is not None and m.path is not None:
                    fs.move(m.path, f"{root}/{m.name}")
                    moved.append(f"{root}/{m.name}")
        except Exception:
            for path in moved:
                fs.delete_file(path)
            self._drop(fs, folder)
            raise
        for path, _ in before:
            fs.delete_file(path)
        self._drop(fs, folder)
        self._clear(fs, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root, folder = self.folder()
        self._drop(fs, folder)
        self._clear(fs, root)

    @staticmethod
    def _clear(fs, root: str) -> None:
        """Delete what jobs that ended long ago left behind."""
        import pyarrow.fs as pafs

        for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            left = i.type == pafs.FileType.Directory and i.base_name.startswith("_writing-")
            if left and i.mtime_ns is not None and time.time_ns() - i.mtime_ns > STALE_NS:
                fs.delete_dir(i.path)

    @staticmethod
    def _drop(fs, folder: str) -> None:
        import pyarrow.fs as pafs

        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class _Source(DataSource):
    reads: type[_Reader]

    def schema(self) -> str:
        raise ValueError(f"declare the columns of a {self.name()} table: fields are matched by position")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return self.reads(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> LineWriter:
        return LineWriter(dict(self.options), overwrite)


class DelimitedSource(_Source):
    """A folder of delimited text files."""

    reads = DelimitedReader

    @classmethod
    def name(cls) -> str:
        return "rowsmith_delimited"


class ArchiveSource(_Source):
    """A folder of zip archives of delimited lines; written rows are plain text, as the reader pair of the archives writes them."""

    reads = ArchiveReader

    @classmethod
    def name(cls) -> str:
        return "rowsmith_archive"
