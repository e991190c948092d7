"""Secret scans with corpus-wide ownership frequency.

Every text is scanned once for candidate spans:

- the base kinds ``assign`` (a password-like name, a sign, a value), ``access`` (access key ids) and ``hex``
  (long lower-case hex runs);
- kinds of the method: ``pem`` (a private-key header) and ``token`` (a free-standing run of 20 or more key
  characters with a digit, an upper and a lower-case letter and at least ``TOKEN_BITS`` bits of entropy per character)
  outside the base spans.

The candidates' values are hashed, and over the whole corpus the hashes are counted by
distinct repositories and distinct owners. A value that at least ``copied_owners`` owners hold, or at least
``copied_repos`` repositories of one owner, is a widely copied example; a value of fewer owners that looks live (entropy of at least ``LIVE_BITS`` bits per
character) is an owner-specific live-looking credential; the rest is weak.

Only spans and hashes leave the scan; texts are never shuffled. Counts are keyed by (hash, owner) before
they are keyed by hash, so a value in a third of all documents is no hot key.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import bounded_batches, stored

KINDS = ("assign", "access", "hex", "pem", "token")
TOKEN_BITS = 3.5
LIVE_BITS = 3.0

_NAMES = ("password", "passwd", "secret", "token", r"api_?key")
_EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in _NAMES)
_ASSIGN = re.compile(rf"(?:{_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs of under 32 characters fail, and a longer run is one match either way
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")



def entropy(value: str) -> float:
    """Bits per character of the value's own character frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def spans_of(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of all spans of a text, by start and then by kind as listed; code points."""
    if not text:
        return []
    base = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= 8:
                base.append((m.start(), m.end(), "assign", m[1]))
    if "AKIA" in text:
        base += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    added = []
    if "PRIVATE KEY-----" in text:
        added = [(m.start(), m.end(), "pem", m[0]) for m in _PEM.finditer(text)]
    taken = sorted((a, b) for a, b, *_ in base + added)
    k, reach = 0, -1
    for m in _TOKEN.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][1])
            k += 1
        if reach > m.start():
            continue
        v = m[0]
        if re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v) and entropy(v) >= TOKEN_BITS:
            added.append((m.start(), m.end(), "token", v))
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_SCANNED = (
    "doc_id long, owner string, repo string, "
    "spans array<struct<kind:string,start:int,end:int,value:long,live:boolean>>"
)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """doc_id, owner, repo, spans of every text (null: empty text, no spans)."""
    types = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("owner", pa.string()),
            ("repo", pa.string()),
            (
                "spans",
                pa.list_(
                    pa.struct(
                        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64()), ("live", pa.bool_())]
                    )
                ),
            ),
        ]
    )

    def found(text: str | None) -> list[dict]:
        return [
            {
                "kind": kind,
                "start": a,
                "end": b,
                "value": xxhash.xxh64_intdigest(v.encode()) - (1 << 63),
                "live": kind == "pem" or entropy(v) >= LIVE_BITS,
            }
            for a, b, kind, v in spans_of(text)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([found(t.as_py()) for t in batch.column(3)], types.field("spans").type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], spans], schema=types)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.col(text_col).alias("text"),
    )
    return bounded_batches(rows).mapInArrow(run, _SCANNED)


def value_owners(scanned: DataFrame, copied_owners: int = 3, copied_repos: int = 100) -> DataFrame:
    """value, repos, owners, verdict ('example', 'live' or 'weak') of every candidate hash."""
    cand = scanned.select("owner", "repo", F.explode("spans").alias("s")).select("owner", "repo", "s.value", "s.live")
    per_owner = (
        cand.groupBy("value", "owner", "repo").agg(F.max("live").alias("live"))
        .groupBy("value", "owner").agg(F.count("*").alias("repos"), F.max("live").alias("live"))
    )
    return (
        per_owner.groupBy("value")
        .agg(F.sum("repos").alias("repos"), F.max("repos").alias("most"), F.count("*").alias("owners"), F.max("live").alias("live"))
        .select(
            "value",
            "repos",
            "owners",
            F.when((F.col("owners") >= copied_owners) | (F.col("most") >= copied_repos), "example").when(F.col("live"), "live").otherwise("weak").alias("verdict"),
        )
    )


def secret_report(
    docs: DataFrame,
    copied_owners: int = 3,
    copied_repos: int = 100,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and the
    number of its spans by verdict: n_live, n_example, n_weak; repos and owners: the most that hold one of its values.

    Null text is empty; null owners are one owner ''; a null id is an id; repeated rows give repeated rows (and
    count as one repository); an empty table gives none; other columns are not read.
    """
    scanned = stored(
        scan(docs, id_col=id_col, text_col=text_col, owner_col=owner_col, repo_col=repo_col), "secrets-scanned"
    )
    with_span = scanned.where(F.size("spans") > 0).select(
        "doc_id", F.xxhash64("spans").alias("spans_key"), F.posexplode("spans").alias("k", "s")
    )
    one = with_span.join(value_owners(scanned, copied_owners, copied_repos), F.col("s.value") == F.col("value"))
    judged = (
        # equal rows (same id and spans) are judged once
        one.groupBy("doc_id", "spans_key", "k").agg(*[F.first(c).alias(c) for c in ("verdict", "repos", "owners")])
        .groupBy("doc_id", "spans_key")
        .agg(F.max("repos").alias("repos"), F.max("owners").alias("owners"), *[F.count(F.when(F.col("verdict") == v, 1)).alias(f"n_{v}") for v in ("live", "example", "weak")])
    )
    text_of = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, text_of))
    columns = [
        "doc_id",
        F.xxhash64("spans").alias("spans_key"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(of(*KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    ]
    # Only rows with spans have anything to look up; the others, which may share one null id, are not moved.
    found = scanned.where(F.size("spans") > 0).select(*columns)
    none = scanned.where(F.size("spans") == 0).select(*columns)
    same = found["doc_id"].eqNullSafe(judged["doc_id"]) & (found["spans_key"] == judged["spans_key"])
    base = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    counts = ["n_live", "n_example", "n_weak", "repos", "owners"]
    return (
        found.join(judged, same, "left")
        .select(found["doc_id"], *base, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
        .unionByName(none.select("doc_id", *base, *[F.lit(0).cast("long").alias(c) for c in counts]))
    )
