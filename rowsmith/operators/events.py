"""Report events: JSON encoding, message-queue envelopes, value projection and the body-size guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.text import encode_event, within_limit

# Fixed values of the event capture: field names, topic, record key and body limit.
USER_AGENT_FIELD = "http_user_agent"
BODY_FIELD = "request_body"
DEFAULT_TOPIC = "test"
DEFAULT_KEY = "key"
BODY_LIMIT_BYTES = 50 * 1024


def report_event(df: DataFrame, user_agent: str = "event_type", body: str = "props") -> Column:
    """The report message of a row: ``{"http_user_agent": ..., "request_body": ...}`` (nulls left out)."""
    return encode_event(**{USER_AGENT_FIELD: df[user_agent], BODY_FIELD: df[body]})


def event_envelope(
    df: DataFrame,
    message: Column,
    *,
    topic: str = DEFAULT_TOPIC,
    key: Column | str | None = DEFAULT_KEY,
    keep: list[str] | None = None,
) -> DataFrame:
    """``key, value, topic`` records ready for the Kafka sink.

    ``key`` is a literal (the capture used one constant key) or a column; a
    constant key sends every record to one topic partition, so pass a
    column (or ``None`` for the producer's own spreading) on a large topic.
    """
    if key is None:
        k = F.lit(None).cast("string")
    elif isinstance(key, str):
        k = F.lit(key)
    else:
        k = key
    return df.select(*(keep or []), k.alias("key"), message.alias("value"), F.lit(topic).alias("topic"))


def write_events(envelope: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Send envelope records to Kafka (needs the Spark Kafka connector on the classpath)."""
    w = envelope.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def stream_events(envelope: DataFrame, bootstrap_servers: str, checkpoint: str, **options: str):
    """Send a stream of envelope records to Kafka (at-least-once; needs the Spark Kafka connector)."""
    w = (
        envelope.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("checkpointLocation", checkpoint)
    )
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()


def message_values(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Drop the record key and keep the value as text."""
    return messages.select(*(keep or []), F.col("value").cast("string").alias("value"))


def accepted_bodies(df: DataFrame, body: str = BODY_FIELD, max_bytes: int = BODY_LIMIT_BYTES) -> DataFrame:
    """Rows whose body is absent or at most ``max_bytes`` bytes long."""
    return df.where(within_limit(body, max_bytes))
