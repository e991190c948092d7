"""Large zip archives read in parallel, in units of whole entries, with exact archive-wide rules.

An archive's entries form one continuous text, and its header counter and end
sentinel run across entries. Reading a large archive in one task would put a
whole hot archive on one core, so archives above ``split_bytes`` are cut into
units of consecutive entries (from the central directory only), and:

1. pass A decodes every unit in parallel and returns a small summary per
   unit: the bytes before its first line end (``head``) and after its last
   (``tail``), the number of lines in between, whether it starts with ``\\n``
   or ends with ``\\r`` (a ``\\r\\n`` split between units), and where the
   sentinel occurs (at most ``first_data_line`` positions);
2. Spark stitches the lines that cross unit boundaries (``tail`` of one unit,
   whole units without a line end, ``head`` of the next) with a running sum
   over units and one grouped text per boundary, numbers every unit's lines with a
   running sum of line counts, and finds the archive's first sentinel line
   after the header; all of this is over one row per unit. A unit that can't be
   decompressed reports its error, which fails the read only if the sentinel does
   not end the archive before that place;
3. pass B decodes the units in parallel again and emits the numbered lines
   that survive the header and sentinel rules (units after the sentinel are
   not decompressed at all).

The output equals the single-task read of the same archive line for line.
A single entry is not split (a deflate stream has to be read from its start).
"""

from __future__ import annotations

import zipfile
from urllib.parse import unquote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.session import checkpoint_root
from rowsmith.sources.archives import (
    BROKEN,
    LINES_SCHEMA,
    BatchBuilder,
    archive_tasks,
    coalesce_chunks,
    entry_pieces,
    is_sentinel,
    line_arrays,
    open_archive,
)

UNITS_SCHEMA = "file_path string, unit int, first_entry int, last_entry int, units int"
SUMMARY_SCHEMA = (
    "file_path string, unit int, first_entry int, last_entry int, has_term boolean, head binary, tail binary, n_inner bigint, "
    "starts_lf boolean, ends_cr boolean, hits array<bigint>, error string"
)


def _entries(zf: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [i for i in zf.infolist() if not i.is_dir()]


def _unit_chunks(zf: zipfile.ZipFile, first: int, last: int, entry_newline: bool):
    return coalesce_chunks(entry_pieces(_entries(zf)[first : last + 1], zf, entry_newline))


def _open_zip(uri: str, on_bad_archive: str):
    fh = open_archive(uri)
    try:
        return fh, zipfile.ZipFile(fh)
    except zipfile.BadZipFile:
        fh.close()
        if on_bad_archive == "skip":
            return None, None
        raise ValueError(f"not a zip archive: {uri}") from None


def _units_task(unit_bytes: int, on_bad_archive: str):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                fh, zf = _open_zip(uri, on_bad_archive)
                if zf is None:
                    continue
                with fh, zf:
                    sizes = [i.file_size for i in _entries(zf)]
                found, start, acc = [], 0, 0
                for i, size in enumerate(sizes):
                    acc += size
                    if acc >= unit_bytes or i == len(sizes) - 1:
                        found.append((start, i))
                        start, acc = i + 1, 0
                n = len(found)
                columns = [[uri] * n, range(n), [a for a, _ in found], [b for _, b in found], [n] * n]
                types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["file_path", "unit", "first_entry", "last_entry", "units"])

    return run


def _summary_task(opts: dict):
    import pyarrow as pa
    import pyarrow.compute as pc

    first_data_line, sentinel, enc = opts["first_data_line"], opts["sentinel"], opts["encoding"]

    def summary(uri, unit, first, last):
        first_byte, last_byte, error = b"", b"", None
        head, rest, n_closed, hits = None, b"", 0, []
        fh, zf = _open_zip(uri, opts["on_bad_archive"])
        if zf is None:
            return None
        with fh, zf:

            def watched():
                nonlocal first_byte, last_byte
                for c in _unit_chunks(zf, first, last, opts["entry_newline"]):
                    if not first_byte:
                        first_byte = c[:1]
                    last_byte = c[-1:]
                    yield c

            try:
                for lines, closed in line_arrays(watched()):
                    if not closed:
                        rest = lines[0].as_py()
                        break
                    if head is None:
                        head = lines[0].as_py()
                    # closed line number c (1-based in the unit) is inner line c - 1; the first is the head
                    if sentinel is not None:
                        for pos in pc.indices_nonzero(is_sentinel(lines, sentinel, enc)).to_pylist():
                            if n_closed or pos:
                                hits.append(n_closed + pos)
                                if hits[-1] >= first_data_line:
                                    break
                    n_closed += len(lines)
                    if hits and hits[-1] >= first_data_line:
                        break  # ends the archive here at the latest: nothing after it is read
            except BROKEN as e:
                error = f"{uri}: {type(e).__name__}: {e}"
        has_term = n_closed > 0
        ends_cr = has_term and rest == b"" and last_byte == b"\r"
        return (
            uri, unit, first, last, has_term, head if has_term else rest, rest, max(n_closed - 1, 0),
            first_byte == b"\n", ends_cr, hits, error,
        )

    types = pa.schema([
        ("file_path", pa.string()), ("unit", pa.int32()), ("first_entry", pa.int32()), ("last_entry", pa.int32()),
        ("has_term", pa.bool_()), ("head", pa.binary()), ("tail", pa.binary()), ("n_inner", pa.int64()),
        ("starts_lf", pa.bool_()), ("ends_cr", pa.bool_()), ("hits", pa.list_(pa.int64())), ("error", pa.string()),
    ])

    def run(batches):
        for batch in batches:
            for key in zip(*(batch.column(c).to_pylist() for c in ("file_path", "unit", "first_entry", "last_entry")), strict=True):
                row = summary(*key)
                if row is not None:
                    arrays = [pa.array([v], f.type) for v, f in zip(row, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=types)

    return run


def _concat(pieces):
    return F.aggregate(pieces, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x))


def _plan(summary: DataFrame, first_data_line: int, sentinel: str | None, encoding: str) -> DataFrame:
    """Per unit: where its lines start, the stitched line it closes, the final line, the stop line.

    One shuffle by archive; every step after it is a window over the units of
    one archive (hash partitioning by ``file_path`` serves all of them).
    """
    has_term = F.col("has_term")
    by_arch = Window.partitionBy("file_path")
    by_unit = by_arch.orderBy("unit")
    upto = by_unit.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_unit.rowsBetween(Window.unboundedPreceding, -1)

    u = summary.repartition("file_path")
    # seg: line ends seen so far. A boundary group (same seg) is the tail of the unit
    # that opens it plus the whole units without a line end after it; the next unit
    # with a line end closes it with its head: that is one stitched line.
    u = u.withColumn("seg", F.sum(has_term.cast("int")).over(upto))
    # The text of each group is put together once, for the unit that closes it and for the archive's end.
    contrib = F.when(has_term, F.col("tail")).otherwise(F.col("head"))
    parts = F.array_sort(F.collect_list(F.struct("unit", contrib.alias("part"))))
    groups = u.groupBy("file_path", "seg").agg(_concat(F.transform(parts, lambda p: p["part"])).alias("group_text"))
    closed = groups.select("file_path", (F.col("seg") + 1).alias("seg"), F.lit(True).alias("has_term"), F.col("group_text").alias("prev_text"))
    u = u.withColumn("is_last", F.col("unit") == F.max("unit").over(by_arch))
    final = groups.select("file_path", "seg", F.lit(True).alias("is_last"), F.col("group_text").alias("f_text"))
    u = u.join(closed, ["file_path", "seg", "has_term"], "left").join(final, ["file_path", "seg", "is_last"], "left")
    empty = F.lit(b"").cast("binary")
    u = u.withColumn("s_text", F.when(has_term, F.concat(F.coalesce("prev_text", empty), F.col("head"))))
    prev_ends_cr = F.last(F.when(has_term, F.col("ends_cr")), ignorenulls=True).over(before)
    # A \r closing one unit and a \n opening the next are one line end, not an empty line.
    crlf = (F.col("seg") > 1) & (F.octet_length("s_text") == 0) & F.coalesce(prev_ends_cr, F.lit(False)) & F.col("starts_lf")
    u = u.withColumn("s_exists", has_term & ~crlf)
    owned = F.when(has_term, F.col("n_inner") + F.col("s_exists").cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    u = u.withColumn("owned", owned)
    u = u.withColumn("offset", F.coalesce(F.sum("owned").over(before), F.lit(0).cast("bigint")))
    u = u.withColumn("s_no", F.col("offset") + 1)
    u = u.withColumn("f_no", F.sum("owned").over(by_arch) + 1)
    u = u.withColumn("emits_final", F.col("is_last") & (F.octet_length("f_text") > 0))

    d = F.lit(first_data_line)
    if sentinel is None:
        u = u.withColumn("stop_no", F.lit(None).cast("bigint"))
    else:
        # The same comparison as in pass A: a line with bad bytes never fails the plan.
        same = _equals(sentinel, encoding)
        s_cand = F.when(F.col("s_exists") & same(F.col("s_text")) & (F.col("s_no") >= d), F.col("s_no"))
        base = F.col("offset") + F.col("s_exists").cast("bigint")
        i_cand = F.array_min(F.filter(F.transform("hits", lambda h: base + h), lambda n: n >= d))
        f_cand = F.when(F.col("emits_final") & same(F.col("f_text")) & (F.col("f_no") >= d), F.col("f_no"))
        u = u.withColumn("stop_no", F.min(F.least(s_cand, i_cand, f_cand)).over(by_arch))
    # A unit that can't be read to its end fails the archive, unless the sentinel comes before that place.
    read_on = F.col("stop_no").isNull() | (F.col("stop_no") > F.col("offset") + F.col("owned"))
    u = u.withColumn("has_term", F.when(F.col("error").isNotNull() & read_on, F.raise_error(F.col("error"))).otherwise(has_term))
    return u.select(
        "file_path", "unit", "first_entry", "last_entry", "has_term", "s_exists", "s_text", "s_no",
        "offset", "emits_final", "f_text", "f_no", "stop_no",
    )


def _equals(sentinel: str, encoding: str):
    if "\ufffd" not in sentinel:
        return lambda c: c == F.lit(sentinel.encode(encoding))

    @F.pandas_udf("boolean")
    def decoded(lines):
        return lines.map(lambda x: x is not None and bytes(x).decode(encoding, "replace") == sentinel)

    return decoded


def _one(raw: bytes):
    import pyarrow as pa

    return pa.array([raw], pa.large_binary())


def _lines_task(opts: dict):
    d, enc = opts["first_data_line"], opts["encoding"]
    wf = opts.get("with_file", True)

    def run(batches):
        out = BatchBuilder(enc, wf, opts["on_bad_bytes"])
        fields = ["file_path", "unit", "first_entry", "last_entry", "has_term", "s_exists", "s_text", "s_no",
                  "offset", "emits_final", "f_text", "f_no", "stop_no"]
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in fields)):
                uri, _, first, last, has_term, s_exists, s_text, s_no, offset, emits_final, f_text, f_no, stop = row
                name = unquote(uri.rsplit("/", 1)[-1])

                def keep(no):
                    return no >= d and (stop is None or no < stop)

                if s_exists and keep(s_no):
                    yield from out.add(uri, name, s_no, _one(s_text))
                start = offset + (1 if s_exists else 0)
                if has_term and (stop is None or start + 1 < stop):
                    fh, zf = _open_zip(uri, opts["on_bad_archive"])
                    if zf is not None:
                        with fh, zf:
                            n_closed = 0
                            for closed, whole in line_arrays(_unit_chunks(zf, first, last, opts["entry_newline"])):
                                if not whole:
                                    break
                                # closed line c (1-based) is line start + c - 1; the first is the head
                                lo = 1 if n_closed == 0 else 0
                                first_no = start + n_closed + lo
                                lines = closed.slice(lo)
                                n_closed += len(closed)
                                if d > first_no:
                                    skip = min(d - first_no, len(lines))
                                    lines, first_no = lines.slice(skip), first_no + skip
                                done = stop is not None and first_no + len(lines) >= stop
                                if done:
                                    lines = lines.slice(0, max(stop - first_no, 0))
                                yield from out.add(uri, name, first_no, lines)
                                if done:
                                    break
                if emits_final and keep(f_no):
                    yield from out.add(uri, name, f_no, _one(f_text))
        if out.rows:
            yield out.flush()

    return run


def read_large_archive_lines(listing: DataFrame, opts: dict, unit_bytes: int, partitions: int) -> DataFrame:
    """``file_path, file_name, line_no, value`` of the archives in ``listing`` (a ``path`` column), unit-parallel."""
    units = listing.repartition(partitions).mapInArrow(_units_task(unit_bytes, opts["on_bad_archive"]), UNITS_SCHEMA)
    # An archive of one unit needs no stitching: one decode, as for small archives.
    single = archive_tasks(units.where("units = 1").select(F.col("file_path").alias("path")), opts, partitions)
    parts = units.where("units > 1").repartition(partitions)
    summary = parts.mapInArrow(_summary_task(opts), SUMMARY_SCHEMA)
    # Pass A runs once: its small per-unit output is checkpointed to the shared
    # checkpoint folder, and every step of the stitching plan reads that copy.
    checkpoint_root(summary.sparkSession)
    summary = summary.checkpoint(eager=True)
    plan = _plan(summary, opts["first_data_line"], opts["sentinel"], opts["encoding"])
    return single.unionByName(plan.repartition(partitions).mapInArrow(_lines_task(opts), LINES_SCHEMA))
