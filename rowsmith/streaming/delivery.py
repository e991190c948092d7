"""Delivery of keyed records with an outcome for each: where it was put, or why not.

Spark's Kafka sink reports nothing per record. Here each task opens a sender and hands it blocks of records; what the sender says of
each record becomes a row of a report, committed with its batch: ``place`` of a record that was sent, ``error`` of one that was not. Failed
records are tried again up to ``attempts`` times, except where the sender refuses one (``Refused``). A batch that is committed is not sent again; one that
stops half-way is, so the receiver gets a record at least once and the report lists it once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowsmith.session import file_system
from rowsmith.streaming.words import BATCH_INTERVAL, batches, per_batch, start

REPORT_SCHEMA = "key string, value string, topic string, place string, attempts int, error string"


class Refused(Exception):
    """The record can't be sent, however often it is tried."""


class Sender(Protocol):
    """One per task, opened there. ``records`` is an Arrow batch of key, value, topic."""

    def send(self, records, attempt: int) -> list[str | Exception]:
        """The place or the failure of every record, in order; raising fails them all."""

    def close(self) -> None: ...


class FolderSender:
    """Puts blocks of records as Parquet files into a shared folder; a place is ``file:row``. For use without a broker.

    Values of more than ``max_bytes`` are refused, as a broker does. Files of attempts that were lost are in no committed
    report: ``arrived`` leaves them out.
    """

    def __init__(self, path: str, max_bytes: int | None = None):
        self.path, self.max_bytes = path, max_bytes

    def send(self, records, attempt: int) -> list[str | Exception]:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        sizes = pc.fill_null(pc.binary_length(records.column("value")), 0).to_pylist()
        fits = [self.max_bytes is None or n <= self.max_bytes for n in sizes]
        out: list[str | Exception] = [Refused(f"record of {n} bytes, at most {self.max_bytes}") for n in sizes]
        if any(fits):
            fs, root = file_system(self.path)
            fs.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.parquet"
            with fs.open_output_stream(f"{root}/.{name}") as sink:
                pq.write_table(pa.Table.from_batches([records.filter(pa.array(fits))]), sink)
            fs.move(f"{root}/.{name}", f"{root}/{name}")
            rows = iter(range(sum(fits)))
            out = [f"{name}:{next(rows)}" if fit else x for fit, x in zip(fits, out, strict=True)]
        return out

    def close(self) -> None:
        pass


def _deliver_task(open_sender: Callable[[], Sender], attempts: int):
    def run(blocks):
        import pyarrow as pa

        sender = None
        try:
            for block in blocks:
                sender = sender or open_sender()
                outcome: list = [None] * block.num_rows
                tried = [0] * block.num_rows
                pending = list(range(block.num_rows))
                for attempt in range(1, attempts + 1):
                    if not pending:
                        break
                    part = pa.Table.from_batches([block]).take(pa.array(pending)).combine_chunks().to_batches()[0]
                    try:
                        said = sender.send(part, attempt)
                    except Exception as e:  # noqa: BLE001 - whatever the sender raises is the outcome of its records
                        said = [e] * len(pending)
                    for i, x in zip(pending, said, strict=True):
                        outcome[i], tried[i] = x, attempt
                    pending = [i for i in pending if isinstance(outcome[i], Exception) and not isinstance(outcome[i], Refused)]
                failed = [isinstance(x, Exception) for x in outcome]
                columns = [
                    *block.columns,
                    pa.array([None if f else x for f, x in zip(failed, outcome, strict=True)], pa.string()),
                    pa.array(tried, pa.int32()),
                    pa.array([(str(x) or type(x).__name__) if f else None for f, x in zip(failed, outcome, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "value", "topic", "place", "attempts", "error"])
        finally:
            if sender is not None:
                sender.close()

    return run


def deliver(envelope: DataFrame, open_sender: Callable[[], Sender], *, attempts: int = 3) -> DataFrame:
    """The report of sending ``envelope`` (key, value, topic). Sending happens when the report is written: write it once."""
    if attempts < 1:
        raise ValueError("at least one attempt")
    records = envelope.select(*(F.col(c).cast("string").alias(c) for c in ("key", "value", "topic")))
    return records.mapInArrow(_deliver_task(open_sender, attempts), REPORT_SCHEMA)


def deliver_stream(
    envelope: DataFrame,
    open_sender: Callable[[], Sender],
    out: str,
    checkpoint: str,
    *,
    attempts: int = 3,
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Send a stream of records and commit the report of every batch to ``out``."""
    sink = per_batch(out, checkpoint, lambda batch: deliver(batch, open_sender, attempts=attempts))
    return start(envelope.writeStream.foreachBatch(sink), checkpoint, trigger, available_now)


def report(spark: SparkSession, out: str) -> DataFrame:
    """A row per record of the committed batches."""
    return batches(spark, out, REPORT_SCHEMA + ", batch_id bigint")


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """The records that were not sent, with the last error of each."""
    return report(spark, out).where(F.col("error").isNotNull())


def arrived(spark: SparkSession, out: str, path: str) -> DataFrame:
    """The records in a ``FolderSender``'s folder that the committed report lists."""
    block = F.substring_index("place", ":", 1)
    blocks = report(spark, out).where(F.col("place").isNotNull()).select(block.alias("block")).distinct()
    records = spark.read.schema("key string, value string, topic string").parquet(path)
    return records.withColumn("block", F.col("_metadata.file_name")).join(blocks, "block", "left_semi").drop("block")
