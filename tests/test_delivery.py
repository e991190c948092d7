"""Outcomes of sent records."""

import pytest

from rowsmith.streaming import delivery as D
from rowsmith.streaming.words import ENVELOPE_SCHEMA, envelope_stream


def memory_sender():
    """The class is made here, so that it travels with the task."""

    class Memory:
        """Fails as its records say: ``ok``, ``once`` (the first attempt), ``never``, ``refused``, and a whole block with ``down``."""

        def send(self, records, attempt):
            values = records.column("value").to_pylist()
            if "down" in values and attempt < 3:
                raise OSError("no connection")
            out = []
            for i, v in enumerate(values):
                if v == "never" or (v == "once" and attempt == 1):
                    out.append(ConnectionError("lost"))
                elif v == "refused":
                    out.append(D.Refused("too large"))
                else:
                    out.append(f"{attempt}:{i}")
            return out

        def close(self):
            pass

    return Memory()


def outcomes(spark, values, **options):
    made = type(memory_sender())
    open_sender = lambda: made()
    env = spark.createDataFrame([("k", v, "t") for v in values], "key string, value string, topic string").coalesce(1)
    return {r.value: (r.place is not None, r.attempts, r.error) for r in D.deliver(env, open_sender, **options).collect()}


def test_every_record_has_an_outcome(spark):
    got = outcomes(spark, ["ok", "once", "never", "refused", None])
    assert got == {
        "ok": (True, 1, None),
        "once": (True, 2, None),
        "never": (False, 3, "lost"),
        "refused": (False, 1, "too large"),
        None: (True, 1, None),
    }
    assert outcomes(spark, ["once"], attempts=1) == {"once": (False, 1, "lost")}
    assert outcomes(spark, ["down", "ok"]) == {"down": (True, 3, None), "ok": (True, 3, None)}
    assert outcomes(spark, ["down", "ok"], attempts=2) == {"down": (False, 2, "no connection"), "ok": (False, 2, "no connection")}
    assert outcomes(spark, []) == {}
    with pytest.raises(ValueError, match="at least one"):
        outcomes(spark, ["ok"], attempts=0)


def records(spark, path, values):
    row = lambda i, v: (b"k", v, "t", 0, i, None)
    spark.createDataFrame([row(i, v) for i, v in enumerate(values)], ENVELOPE_SCHEMA).write.mode("append").parquet(path)


def run(spark, path, out, sender):
    D.deliver_stream(envelope_stream(spark, path), sender, out, out + "-ck", available_now=True).awaitTermination()


def test_stream_reports_each_record_once(spark, tmp_path):
    path, out, topic = (str(tmp_path / x) for x in ("in", "out", "topic"))
    sender = lambda: D.FolderSender(topic, 5)
    records(spark, path, [b"a", b"bb", b"too long", None])
    run(spark, path, out, sender)
    records(spark, path, [b"a", b"c"])
    run(spark, path, out, sender)
    run(spark, path, out, sender)
    found = sorted((r.value or "", r.error) for r in D.report(spark, out).collect())
    assert found == [("", None), ("a", None), ("a", None), ("bb", None), ("c", None), ("too long", "record of 8 bytes, at most 5")]
    assert [r.value for r in D.dead_letters(spark, out).collect()] == ["too long"]
    assert sorted(r.value or "" for r in D.arrived(spark, out, topic).collect()) == ["", "a", "a", "bb", "c"]


def test_a_batch_that_stops_half_way_is_reported_once(spark, tmp_path, monkeypatch):
    path, out, topic = (str(tmp_path / x) for x in ("in", "out", "topic"))
    sender = lambda: D.FolderSender(topic)
    records(spark, path, [b"a", b"b"])

    def stop(*args, **kwargs):
        raise RuntimeError("stopped before the commit")

    with monkeypatch.context() as m:
        m.setattr("rowsmith.streaming.words.CommitLog.commit", stop)
        with pytest.raises(Exception, match="stopped before the commit"):
            run(spark, path, out, sender)
    assert D.report(spark, out).count() == 0
    run(spark, path, out, sender)
    assert sorted(r.value for r in D.report(spark, out).collect()) == ["a", "b"]
    assert spark.read.parquet(topic).count() == 4  # sent at least once
    assert sorted(r.value for r in D.arrived(spark, out, topic).collect()) == ["a", "b"]
