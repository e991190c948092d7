"""Vector code compression: product codes whose codebooks are learned by active-entry Lloyd rounds, exactly.

Integer vectors are cut into equal parts; every part position has a codebook of ``entries``, and a vector's code is the number of
the nearest entry of each part.

**Active entries.** Each part stores its entry and the exact squared distance to it. When a round moved only some entries, a part
whose own entry stayed compares the moved ones with its stored distance and nothing else: the entries that stayed were not nearer before and
are not now. A part whose entry moved rescans the whole codebook. Comparisons are by (distance, entry number), so that ties go
to the lower number on both ways, and the result is that of rescanning everything.

**On the cluster.** Vectors, codes and distances lie in blocks, one row each, written to shared storage every round with the sums per entry
beside them; the round before is then deleted. Spark adds up the sums, so ``parts * entries`` vectors reach the driver and the vectors
are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import vectors as V
from rowsmith.session import scratch_path

_HEX = np.array([f"{i:02x}" for i in range(256)])


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lower number of equals) and squared distance of the rows of x."""
    apart = np.stack([np.square(x - entry).sum(axis=1) for entry in book], axis=1)
    near = apart.argmin(axis=1)
    return near, apart[np.arange(len(x)), near]


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of the rows of x under ``book``, from those under the book before its ``moved`` entries (a mask) moved."""
    if not moved.any():
        return code, distance
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    stay = np.flatnonzero(~lost)
    active = np.flatnonzero(moved)
    if len(stay):
        near, apart = scan(x[stay], book[active])
        near = active[near]
        better = (apart < distance[stay]) | (apart == distance[stay]) & (near < code[stay])
        code[stay[better]], distance[stay[better]] = near[better], apart[better]
    lost = np.flatnonzero(lost)
    if len(lost):
        code[lost], distance[lost] = scan(x[lost], book)
    return code, distance


def _sums(x: np.ndarray, codes: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Per part and entry: the sum of its parts (parts, entries, width) and their number. x: (parts, n, width)."""
    parts, _, width = x.shape
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for p in range(parts):
        np.add.at(sums[p], codes[p], x[p])
        counts[p] = np.bincount(codes[p], minlength=entries)
    return sums, counts


def _block_row(kept: list[pa.Array], x: np.ndarray, codes: np.ndarray, apart: np.ndarray, entries: int) -> pa.RecordBatch:
    # the narrowest width that holds every value: most vectors take two bytes a component
    width = next(w for w in (np.int16, np.int32) if x.size == 0 or np.abs(x).max() <= np.iinfo(w).max)
    sums, counts = _sums(x, codes, entries)
    packed = [x.astype(width).tobytes(), codes.astype(np.uint8).tobytes(), apart.tobytes(), sums.tobytes(), counts.tobytes()]
    names = ["ids", "labels", "wide", "ints", "codes", "apart", "sums", "counts"]
    return pa.RecordBatch.from_arrays([*kept, pa.array([width is np.int32]), *[pa.array([p], pa.binary()) for p in packed]], names)


def _first_round(book: np.ndarray, dims: int, scale: int):
    """Rows (id, vector, label) to blocks, every part assigned by a full scan."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ints in V.blocks_of(batches, dims, scale):
            x = np.ascontiguousarray(ints.reshape(-1, parts, width).transpose(1, 0, 2))
            found = [scan(x[p], book[p]) for p in range(parts)]
            codes, apart = np.stack([c for c, _ in found]), np.stack([d for _, d in found])
            yield _block_row([V.as_list(block.column(0)), V.as_list(block.column(2))], x, codes, apart, entries)

    return run


def _unpacked(row: dict, parts: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.int32 if row["wide"] else np.int16
    x = np.frombuffer(row["ints"], kind).astype(np.int64).reshape(parts, -1, width)
    codes = np.frombuffer(row["codes"], np.uint8).astype(np.int64).reshape(parts, -1)
    return x, codes, np.frombuffer(row["apart"], np.int64).reshape(parts, -1)


def _next_round(book: np.ndarray, moved: np.ndarray):
    """Blocks to blocks: only what the moved entries can change is compared."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["wide", "ints", "codes", "apart"]).to_pylist()):
                x, codes, apart = _unpacked(row, parts, width)
                found = [reassign(x[p], book[p], moved[p], codes[p], apart[p]) for p in range(parts)]
                codes, apart = np.stack([c for c, _ in found]), np.stack([d for _, d in found])
                yield _block_row([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1)], x, codes, apart, entries)

    return run


def _added(shape: tuple[int, int, int]):
    """The sums of a task's blocks, one row per part and entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = shape
        sums, counts = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                sums += np.frombuffer(row["sums"], np.int64).reshape(shape)
                counts += np.frombuffer(row["counts"], np.int64).reshape(parts, entries)
        at = np.arange(parts * entries * width)
        columns = [at.astype(np.int32), sums.ravel(), counts.ravel()[at // width]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "s", "n"])

    return run


def _moved_book(blocks: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each entry the floor of the mean of its parts, unused entries as they were."""
    parts, entries, width = book.shape
    added = blocks.select("sums", "counts").mapInArrow(_added(book.shape), "place int, s long, n long")
    found = added.groupBy("place").agg(V.exact_sum("s").alias("s"), F.sum("n").alias("n")).collect()  # parts * entries * width rows
    sums, counts = np.zeros(book.size, object), np.zeros(parts * entries, object)
    for r in found:
        sums[r.place], counts[r.place // width] = int(r.s), int(r.n)
    return V.floor_means(sums.reshape(book.shape), counts.reshape(parts, entries), book.astype(object)).astype(np.int64)


def _codes_out(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["codes", "apart"]).to_pylist()):
                codes = np.frombuffer(row["codes"], np.uint8).reshape(parts, -1)
                text = _HEX[codes[0]]
                for p in range(1, parts):
                    text = np.char.add(text, _HEX[codes[p]])
                error = np.frombuffer(row["apart"], np.int64).reshape(parts, -1).sum(axis=0)
                ids, labels = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of our own that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def compress_vectors(
    table: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    *,
    dims: int = 64,
    scale: int = 4096,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per kept row of ``table``: vec_id, code, error, label_error, codebooks_sha256.

    Kept are vectors without null or not finite components; those of another length than ``dims`` can't be cut alike and go too. Components become
    ``floor(scale * x)``. Codebooks start as the parts of the vectors of the ``entries`` smallest ids (null ids last, ties by vector);
    each of ``rounds`` rounds assigns every part to its nearest entry and moves every used entry to the componentwise floor of
    the mean of its parts; then parts are assigned again. ``error`` is a vector's squared distance summed over its parts, ``label_error``
    its sum over the rows of an equal label, nulls together.

    Ties go to the lower entry. Repeated rows and ids are rows of their own. With fewer kept rows than ``entries`` the codebooks
    have as many entries as rows; a table without a kept row gives no rows. Components beyond 2**27 / scale raise an error
    (a distance would not fit a long). Other columns are not read. ``entries`` is at most 256 (two hex digits).
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("dims must be a multiple of parts, entries 1 to 256")
    spark = table.sparkSession
    rows = V.whole_vectors(table, id_col, vec_col, dims, label_col)
    label_type = rows.schema["label"].dataType.simpleString()
    least = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not least:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    start = V.integers(np.array([r.vector for r in least], np.float64), scale)
    book = np.ascontiguousarray(start.reshape(len(least), parts, dims // parts).transpose(1, 0, 2))
    packed = "wide boolean, ints binary, codes binary, apart binary, sums binary, counts binary"
    schema = f"ids array<long>, labels array<{label_type}>, {packed}"
    blocks, path = _write(rows.mapInArrow(_first_round(book, dims, scale), schema), "codes-blocks")
    for _ in range(rounds):
        new = _moved_book(blocks, book)
        moved = (new != book).any(axis=2)
        book = new
        if not moved.any():
            break  # every later round would give the same codes
        blocks, later = _write(blocks.mapInArrow(_next_round(book, moved), schema), "codes-blocks")
        _drop(spark, path)
        path = later
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    found = blocks.select("ids", "labels", "codes", "apart").mapInArrow(
        _codes_out(parts), f"vec_id long, label {label_type}, code string, error long"
    )
    coded, _ = _write(found, "codes-assigned")
    _drop(spark, path)
    # summed before the shuffle and joined back as one row a label: a hot label's rows are split by adaptive execution
    by_label = coded.groupBy(F.col("label").alias("same")).agg(V.exact_sum("error").cast("long").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
