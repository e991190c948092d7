"""Files derived from the given tables, for the queries that read files.

Every staged set is written by Spark tasks into the shared scratch folder
(under ``spark.checkpoint.dir``) and grows with the tables. A staged set is
written once per process and folder, then reused by later queries.
"""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators.words import lines_of
from rowsmith.plans.tables import table
from rowsmith.session import checkpoint_root, default_parallelism, file_system, input_bytes, scratch_path
from rowsmith.sinks.delimited import format_lines, write_delimited
from rowsmith.sources.delimited import session_flags

# Fixed values of the staged sets (the oracle SQL uses the same numbers).
ORDERS_PER_ARCHIVE = 2000
ORDERS_PER_ENTRY = 100
DOCS_PER_ARCHIVE = 25
YEARS_AT_ONCE = 16
DOCS_PER_BUCKET = 100
PREVIEW_DOCS_PER_BUCKET = 500
# Two bytes each in GBK.
TWO_BYTE_CHARS = "甲乙丙丁"
# One, two and four bytes in UTF-16.
WIDE_SIGNS = "zé甲𝄞"
# Characters that end no line and that trim keeps, though a regex's $ stands before them.
NEAR_LINE_ENDS = "\u0085\u2028\u2029"
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINEITEM_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate string"
)

_lock = threading.Lock()
_staged: dict[tuple[str, str, str], str] = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    key = (checkpoint_root(spark), os.path.abspath(sf_dir), name)
    with _lock:
        if key not in _staged:
            path = scratch_path(spark, name)
            build(path)
            _staged[key] = path
        return _staged[key]


def lineitem_text(spark: SparkSession, sf_dir: str, delimiter: str = ",") -> str:
    """``lineitem`` as delimited text (one part file per scan task)."""
    tag = {",": "comma", "|": "pipe"}.get(delimiter, "custom")

    def build(path: str) -> None:
        write_delimited(table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS), path, delimiter=delimiter)

    return _memo(spark, sf_dir, f"lineitem-text-{tag}", build)


def lineitem_by_year(spark: SparkSession, sf_dir: str) -> str:
    """``lineitem`` as delimited text in one folder per ship year (``ship_year=YYYY``)."""

    def build(path: str) -> None:
        df = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS).withColumn("ship_year", F.year("l_shipdate"))
        # a handful of years: each scan task writes a file a year, and no row is shuffled or sorted
        write_delimited(df, path, partition_by=["ship_year"], balance=False, open_folders=YEARS_AT_ONCE)

    return _memo(spark, sf_dir, "lineitem-by-year", build)


def document_lines(spark: SparkSession, sf_dir: str) -> str:
    """The lines of every document as text files."""

    def build(path: str) -> None:
        lines_of(table(spark, sf_dir, "documents", spread_rows=True), "text").write.text(path)

    return _memo(spark, sf_dir, "document-lines", build)


def document_lines_by_bucket(spark: SparkSession, sf_dir: str, docs_per_bucket: int = DOCS_PER_BUCKET) -> str:
    """Document lines in one file per bucket of ``docs_per_bucket`` consecutive doc ids
    (folders ``bucket=N``): buckets are bounded, and each is written by one task."""

    def build(path: str) -> None:
        docs = table(spark, sf_dir, "documents", spread_rows=True).select(
            F.floor(F.col("doc_id") / docs_per_bucket).cast("bigint").alias("bucket"), "text"
        )
        lines = lines_of(docs, "text", keep=["bucket"])
        lines.repartition("bucket").write.partitionBy("bucket").text(path)

    return _memo(spark, sf_dir, f"document-lines-by-{docs_per_bucket}", build)


def preview_lines_by_bucket(spark: SparkSession, sf_dir: str) -> str:
    return document_lines_by_bucket(spark, sf_dir, PREVIEW_DOCS_PER_BUCKET)


def gbk_order_lines(spark: SparkSession, sf_dir: str) -> str:
    """One line per order in GBK: its key, a two-byte character that follows from it, its status."""

    def build(path: str) -> None:
        sign = F.substring(F.lit(TWO_BYTE_CHARS), F.pmod("o_orderkey", F.lit(4)).cast("int") + 1, F.lit(1))
        line = F.concat_ws(",", F.col("o_orderkey").cast("string"), sign, F.col("o_orderstatus"))
        with session_flags(spark, {"spark.sql.legacy.javaCharsets": "true"}):
            # The encoded bytes are written as they are: a string column holds raw bytes.
            lines = table(spark, sf_dir, "orders").select(F.encode(line, "GBK").cast("string").alias("value"))
        lines.write.text(path)

    return _memo(spark, sf_dir, "order-lines-gbk", build)


def utf16_order_lines(spark: SparkSession, sf_dir: str) -> str:
    """One line per order in UTF-16, a folder per byte order: even keys with the low byte first (``le``), odd ones with the high byte first (``be``)."""

    def build(path: str) -> None:
        sign = F.substring(F.lit(WIDE_SIGNS), F.pmod("o_orderkey", F.lit(4)).cast("int") + 1, F.lit(1))
        line = F.concat_ws(",", F.col("o_orderkey").cast("string"), sign, F.col("o_orderstatus"))
        for i, (name, end) in enumerate((("le", "\n\0"), ("be", "\0\n"))):
            half = orders.where(F.pmod("o_orderkey", F.lit(2)) == i)
            # The encoded bytes, line ends too, are written as they are: a string column holds raw bytes.
            half.select(F.encode(line, f"UTF-16{name.upper()}").cast("string").alias("value")).write.option("lineSep", end).text(f"{path}/{name}")

    orders = table(spark, sf_dir, "orders", spread_rows=True)
    return _memo(spark, sf_dir, "order-lines-utf16", build)


def document_paragraphs(spark: SparkSession, sf_dir: str) -> str:
    """Documents as text files, each followed by a blank line (paragraph-separated records) and a line that
    only looks blank: one of ``NEAR_LINE_ENDS``, after no, one or two spaces."""

    def build(path: str) -> None:
        docs = table(spark, sf_dir, "documents")
        spaces = F.repeat(F.lit(" "), F.pmod("doc_id", F.lit(4)).cast("int") % 3)
        odd = F.substring(F.lit(NEAR_LINE_ENDS), F.pmod("doc_id", F.lit(3)).cast("int") + 1, F.lit(1))
        docs.select(F.concat("text", F.lit("\n\n"), spaces, odd).alias("value")).write.text(path)

    return _memo(spark, sf_dir, "document-paragraphs", build)


def encoded_document_lines(spark: SparkSession, sf_dir: str, encoding: str) -> str:
    """Document lines written in a legacy single- or double-byte charset."""

    def build(path: str) -> None:
        lines = lines_of(table(spark, sf_dir, "documents", spread_rows=True), "text")
        with session_flags(spark, {"spark.sql.legacy.javaCharsets": "true"}):
            # The encoded bytes are written as they are: a string column holds raw bytes.
            encoded = lines.select(F.encode("value", encoding).cast("string").alias("value"))
        encoded.write.text(path)

    return _memo(spark, sf_dir, f"document-lines-{encoding.lower()}", build)


def event_envelopes(spark: SparkSession, sf_dir: str, topic: str = "test") -> str:
    """``events`` as message-queue records (the Kafka source's columns), in parquet files."""
    from rowsmith.operators.events import event_envelope, report_event

    def build(path: str) -> None:
        ev = table(spark, sf_dir, "events", spread_rows=True)
        env = event_envelope(ev, report_event(ev), topic=topic, keep=["ts"])
        (
            env.select(
                F.col("key").cast("binary").alias("key"),
                F.col("value").cast("binary").alias("value"),
                F.col("topic"),
                F.spark_partition_id().alias("partition"),
                F.monotonically_increasing_id().alias("offset"),
                F.col("ts").cast("timestamp").alias("timestamp"),
            ).write.parquet(path)
        )

    return _memo(spark, sf_dir, f"event-envelopes-{topic}", build)


# --- zip archives --------------------------------------------------------


#: Entries that a task of the archive writer holds (about 30 kB each in the archives of ``lineitem``).
ENTRIES_PER_BATCH = 64
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of the documents that a task of the archive writer takes, at least as many tasks as the cluster has slots.
WRITER_BYTES = 32 << 20


def _zip_writer(target: str, prefix: str):
    import zipfile

    import pyarrow as pa

    def run(batches):
        current = None
        zf = fh = None
        tmp = final = None
        entries = size = 0
        out_keys, out_paths, out_entries, out_bytes = [], [], [], []

        def close():
            nonlocal zf, fh
            if zf is None:
                return
            zf.close()
            fh.close()
            fs.move(tmp, final)
            out_keys.append(current)
            out_paths.append(final)
            out_entries.append(entries)
            out_bytes.append(size)
            zf = fh = None

        fs, root = file_system(target)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            keys = batch.column("archive").to_pylist()
            names = batch.column("entry").to_pylist()
            for k, n, body in zip(keys, names, batch.column("body"), strict=True):
                if k != current:
                    close()
                    current = k
                    base = f"{prefix}-{k:06d}.zip"
                    final = f"{root}/{base}"
                    # Hidden while written: file listings skip names starting with a dot,
                    # so a failed attempt's partial file is never read as an archive.
                    tmp = f"{root}/.{base}.{uuid.uuid4().hex}.tmp"
                    fh = fs.open_output_stream(tmp)
                    zf = zipfile.ZipFile(fh, "w", zipfile.ZIP_DEFLATED)
                    entries = size = 0
                data = body.as_buffer().to_pybytes()
                zf.writestr(n, data)
                entries += 1
                size += len(data)
        close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(out_keys, pa.int64()),
                pa.array(out_paths, pa.string()),
                pa.array(out_entries, pa.int64()),
                pa.array(out_bytes, pa.int64()),
            ],
            names=["archive", "path", "entries", "bytes"],
        )

    return run


def write_archives(df: DataFrame, path: str, *, prefix: str, partitions: int | None = None) -> None:
    """Write rows ``(archive bigint, entry string, body string, seq)`` as one zip per ``archive``.

    Rows are hash-partitioned by archive and sorted by ``(archive, seq)``
    inside each task, so a task streams its archives one after another and
    holds ``ENTRIES_PER_BATCH`` entries at a time. A zip is written under a temporary name and
    renamed when complete, so a retried task leaves no partial archive.
    """
    spark = df.sparkSession
    n = partitions or default_parallelism(spark)
    staged = df.repartition(n, "archive").sortWithinPartitions("archive", "seq").select("archive", "entry", "body")
    summary = staged.mapInArrow(_zip_writer(path, prefix), "archive bigint, path string, entries bigint, bytes bigint")
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= ENTRIES_PER_BATCH:
        spark.conf.set(BATCH_ROWS, str(ENTRIES_PER_BATCH))
    try:
        summary.agg(F.sum("entries")).collect()
    finally:
        spark.conf.set(BATCH_ROWS, before)


def lineitem_archives(spark: SparkSession, sf_dir: str) -> str:
    """``lineitem`` lines in zip archives: ``ORDERS_PER_ARCHIVE`` order keys per archive,
    ``ORDERS_PER_ENTRY`` per entry; every entry ends with a line end."""

    def build(path: str) -> None:
        li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
        lines = format_lines(li, ",", columns=LINEITEM_COLUMNS, keep=["l_orderkey", "l_linenumber"])
        per_entry = lines.groupBy(
            F.floor(F.col("l_orderkey") / ORDERS_PER_ARCHIVE).cast("bigint").alias("archive"),
            F.floor(F.col("l_orderkey") / ORDERS_PER_ENTRY).cast("bigint").alias("seq"),
        ).agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "value"))),
                    lambda s: s["value"],
                ),
                "\n",
            ).alias("body")
        )
        entries = per_entry.select(
            "archive",
            F.format_string("orders-%08d.txt", F.col("seq") * ORDERS_PER_ENTRY).alias("entry"),
            F.concat(F.col("body"), F.lit("\n")).alias("body"),
            "seq",
        )
        write_archives(entries, path, prefix="lineitem")

    return _memo(spark, sf_dir, "lineitem-archives", build)


def document_archives(spark: SparkSession, sf_dir: str) -> str:
    """Documents in zip archives: ``DOCS_PER_ARCHIVE`` consecutive doc ids per archive,
    one entry per document holding its text as is (entries run into each other), after a directory entry."""

    def build(path: str) -> None:
        docs = table(spark, sf_dir, "documents")
        entries = docs.select(
            F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE).cast("bigint").alias("archive"),
            F.format_string("doc-%08d.txt", F.col("doc_id")).alias("entry"),
            F.col("text").alias("body"),
            F.col("doc_id").alias("seq"),
        )
        folders = entries.select(
            "archive", F.lit("texts/").alias("entry"), F.lit("").alias("body"), F.lit(-1).cast("bigint").alias("seq")
        ).distinct()
        size = input_bytes(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
        tasks = max(default_parallelism(spark), -(-size // WRITER_BYTES))
        write_archives(entries.unionByName(folders), path, prefix="docs", partitions=tasks)

    return _memo(spark, sf_dir, "document-archives", build)
