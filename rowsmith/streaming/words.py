"""Streams of lines and messages: per-batch and per-interval word counts, previews.

Sources are Structured Streaming sources: a folder of text files (any file
source; the socket source is only a debugging aid), Kafka, or a folder of
files holding Kafka's record columns. Sinks write through ``foreachBatch``
into a table with a commit log (``sinks.commits``): a batch is written under a
name of its own and then committed with the stream's id and its number. Readers
(``batches``, ``interval_counts``, ``latest_counts``) see committed batches
only, a batch that is run again after a failure is committed once, and small
batches are merged as they pile up.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowsmith.functions.text import tokens
from rowsmith.operators.words import word_count
from rowsmith.session import default_parallelism
from rowsmith.sinks.commits import CommitLog, Folder, committed_rows

# Batch interval and preview size of the stream jobs.
BATCH_INTERVAL = "3 seconds"
PREVIEW_ROWS = 10

#: So many folders of one size are merged into one of the next.
MERGE_FAN = 16
#: How long folders that a merge replaced are kept for readers that still use them.
KEEP_SECONDS = 24 * 3600

ENVELOPE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def text_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files under ``path`` as a stream of ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines read from a TCP socket (Spark's socket source: a debugging aid, not fault tolerant)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def message_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str,
    *,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    min_partitions: int | None = None,
) -> DataFrame:
    """Records of Kafka ``topics`` (needs the Spark Kafka connector on the classpath)."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return r.load()


def envelope_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Records with Kafka's columns read from parquet files (a stand-in source without a broker)."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def start(writer, checkpoint: str, trigger: str | None, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger or BATCH_INTERVAL)
    return writer.start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: batch numbers count within it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def per_batch(out: str, checkpoint: str, compute, combine=None, merge_fan: int | None = MERGE_FAN):
    """Write ``compute`` of every batch, with its ``batch_id``, and commit it; merge folders by ``combine`` (default: rows as they are)."""

    # The stream's log and id, and the table after its last batch: a commit that another writer made since is met by its number.
    known: dict = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if "log" not in known:
            known.update(log=CommitLog(spark, out), writer=_stream_id(spark, checkpoint))
        log, writer = known["log"], known["writer"]
        state = known.pop("state", None) or log.state()
        if batch_id <= state.batches.get(writer, -1):
            return  # committed before the stream could note it
        name = log.new_folder()
        log.write(compute(batch).withColumn("batch_id", F.lit(batch_id).cast("long")), name)
        state = log.commit([Folder(name, batch_id, batch_id)], writer=writer, batch=batch_id, state=state)
        if merge_fan and state is not None:
            state = log.merge(combine, merge_fan, state)
            if any(f.level > 1 for f in state.folders) and batch_id % merge_fan**2 == 0:
                log.vacuum(KEEP_SECONDS)
        known["state"] = state

    return run


def batches(spark: SparkSession, out: str | list[str], schema=None) -> DataFrame:
    """The rows of all committed batches of the streams that write to ``out`` (one or several tables), with their ``batch_id``."""
    return committed_rows(spark, out, schema)


def _added(rows: DataFrame) -> DataFrame:
    """Counts of several batches added up per window and word."""
    keys = ["window_start", "window_end", "word"]
    return rows.groupBy(*keys).agg(F.sum("cnt").alias("cnt"), F.max("batch_id").alias("batch_id"))


def _latest(rows: DataFrame) -> DataFrame:
    """Of several counts of a window and word the one of the latest batch."""
    keys = ["window_start", "window_end", "word"]
    return rows.groupBy(*keys).agg(F.max_by("cnt", "batch_id").alias("cnt"), F.max("batch_id").alias("batch_id"))


def batch_word_count(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    *,
    col: str = "value",
    by: list[str] | None = None,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Word counts of every micro-batch on its own (no running total); read them with ``batches``.

    ``by`` adds grouping columns inside each batch (for example the source a
    line came from).
    """
    return start(
        lines.writeStream.foreachBatch(per_batch(out, checkpoint, lambda b: word_count(b, col, by=by))),
        checkpoint,
        trigger,
        available_now,
    )


def forward_values(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    *,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to parquet files (the file sink keeps exactly-once output via its log)."""
    return start(stream.writeStream.format("parquet").option("path", out), checkpoint, trigger, available_now)


def preview(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    *,
    rows: int = PREVIEW_ROWS,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """The first ``rows`` rows of every batch (what a console print shows); read them with ``batches``."""
    return start(stream.writeStream.foreachBatch(per_batch(out, checkpoint, lambda b: b.limit(rows))), checkpoint, trigger, available_now)


def console_preview(stream: DataFrame, *, rows: int = PREVIEW_ROWS, trigger: str = BATCH_INTERVAL) -> StreamingQuery:
    """Print the head of every batch on the driver's console."""
    return stream.writeStream.format("console").option("numRows", str(rows)).trigger(processingTime=trigger).start()


def interval_word_count(
    lines: DataFrame,
    ts_col: str,
    *,
    interval: str = BATCH_INTERVAL,
    col: str = "value",
    watermark: str | None = None,
) -> DataFrame:
    """Word counts per tumbling ``interval`` of ``ts_col``: ``window_start, window_end, word, cnt``.

    Works on a batch or a streaming DataFrame; a stream in append mode needs
    ``watermark`` (how late a row may arrive) to close its windows.
    """
    src = lines.withWatermark(ts_col, watermark) if watermark else lines
    windowed = src.select(F.window(ts_col, interval).alias("w"), F.explode(tokens(col)).alias("word"))
    return windowed.groupBy("w", "word").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "word", "cnt"
    )


def run_interval_word_count(
    lines: DataFrame,
    ts_col: str,
    out: str,
    checkpoint: str,
    *,
    interval: str = BATCH_INTERVAL,
    col: str = "value",
    watermark: str | None = None,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
    state_partitions: int | None = None,
    merge_fan: int | None = MERGE_FAN,
) -> StreamingQuery:
    """Stream the interval counts; read them with ``interval_counts``.

    Without ``watermark`` every batch counts its own rows per window and
    writes them: no state is kept, no row is ever late, and the counts of a
    window are added when they are read. With one, Spark keeps the open
    windows in its state store and each batch writes the windows it changed
    (read with ``latest_counts``); rows older than the watermark are dropped. The state is split into
    ``state_partitions`` (default: the cluster's task slots); a stream fixes
    that number when it first starts, so it is set for the start only.
    """
    if watermark is None:
        count = lambda b: interval_word_count(b, ts_col, interval=interval, col=col)
        sink = per_batch(out, checkpoint, count, _added, merge_fan)
        return start(lines.writeStream.foreachBatch(sink), checkpoint, trigger, available_now)
    counts = interval_word_count(lines, ts_col, interval=interval, col=col, watermark=watermark)
    writer = counts.writeStream.outputMode("update").foreachBatch(per_batch(out, checkpoint, lambda b: b, _latest, merge_fan))
    spark = lines.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or default_parallelism(spark)))
    try:
        return start(writer, checkpoint, trigger, available_now)
    finally:
        spark.conf.set(key, before)


def interval_counts(spark: SparkSession, out: str) -> DataFrame:
    """Count per window and word: the sum over all committed batches of a stream without a watermark."""
    return _added(batches(spark, out)).drop("batch_id")


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """Count per window and word of a stream with a watermark: the row of the latest committed batch."""
    return _latest(batches(spark, out)).drop("batch_id")
