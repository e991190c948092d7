"""Archives with one very large entry: decoded once, spooled as pieces, parsed in parallel.

A deflated entry can only be read from its start, so its bytes are decoded by one task. What follows (the hand-over to the JVM, splitting,
typing) need not be: that task applies the header and sentinel rules to the decoded lines, which costs little, and writes them to shared storage as
Parquet pieces of about ``piece_bytes``. The pieces are then read as any table, a split a task.

Piece names follow from the archive's path and the piece's number, and a piece is renamed into place when it is whole. Decoding gives the same
pieces every time, so a task that is run again, or twice at once, leaves each piece once.
"""

from __future__ import annotations

import hashlib
import uuid
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.session import checkpoint_root, file_system, scratch_path
from rowsmith.sources.archives import LINES_SCHEMA, lines_task
from rowsmith.sources.line_ranges import open_archive

# Entries above SPOOL_BYTES (uncompressed) make their archive a spooled one; a piece holds about PIECE_BYTES of lines.
SPOOL_BYTES = 1 << 30
PIECE_BYTES = 64 << 20


def _largest_task(batches):
    import pyarrow as pa

    for batch in batches:
        largest = []
        for uri in batch.column("path").to_pylist():
            with open_archive(uri) as fh:
                try:
                    with zipfile.ZipFile(fh) as zf:
                        largest.append(max((i.file_size for i in zf.infolist()), default=0))
                except zipfile.BadZipFile:
                    largest.append(0)  # the reader says what is wrong, or skips it
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(largest, pa.int64())], names=["path", "largest"])


def largest_entries(listing: DataFrame, partitions: int) -> DataFrame:
    """``path, largest``: the uncompressed bytes of every archive's largest entry, from the central directories."""
    checkpoint_root(listing.sparkSession)
    found = listing.select("path").repartition(partitions).mapInArrow(_largest_task, "path string, largest bigint")
    return found.checkpoint(eager=True)


def _spool_task(opts: dict, target: str, piece_bytes: int):
    lines_of = lines_task(opts)

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        fs, root = file_system(target)
        fs.create_dir(root, recursive=True)

        def keep(hidden: str, name: str) -> None:
            if fs.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
                fs.move(hidden, f"{root}/{name}")
            else:  # another attempt wrote the same piece
                fs.delete_file(hidden)

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                stem = hashlib.sha256(uri.encode()).hexdigest()[:32]
                pieces = rows = size = 0
                writer = sink = hidden = None
                for lines in lines_of([pa.RecordBatch.from_pydict({"path": [uri]})]):
                    if writer is None:
                        hidden = f"{root}/.{uuid.uuid4().hex}"
                        sink = fs.open_output_stream(hidden)
                        writer = pq.ParquetWriter(sink, lines.schema)
                    writer.write_batch(lines)
                    rows, size = rows + lines.num_rows, size + lines.nbytes
                    if size >= piece_bytes:
                        writer.close()
                        sink.close()
                        keep(hidden, f"{stem}-{pieces:06d}.parquet")
                        pieces, size, writer = pieces + 1, 0, None
                if writer is not None:
                    writer.close()
                    sink.close()
                    keep(hidden, f"{stem}-{pieces:06d}.parquet")
                    pieces += 1
                yield pa.RecordBatch.from_pydict({"path": [uri], "pieces": pa.array([pieces], pa.int64()), "n": pa.array([rows], pa.int64())})

    return run


def spooled_lines(listing: DataFrame, opts: dict, piece_bytes: int, partitions: int) -> DataFrame:
    """``file_path, file_name, line_no, value`` of the archives in ``listing`` (a ``path`` column), by way of pieces on shared storage."""
    spark = listing.sparkSession
    target = scratch_path(spark, "archive-spool")
    task = _spool_task(opts, target, piece_bytes)
    done = listing.repartition(partitions).mapInArrow(task, "path string, pieces bigint, n bigint")
    written = done.agg(F.sum("pieces")).first()[0]
    if not written:
        return spark.createDataFrame([], LINES_SCHEMA)
    return spark.read.schema(LINES_SCHEMA).parquet(target)
