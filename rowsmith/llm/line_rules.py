"""Quality rules from cross-document line frequency, beside four per-document counts.

The method: every line is normalised (lower case, white space runs as one space) and hashed;
per host the number of distinct documents that hold a line is counted over the whole corpus;
lines in more than ``max(min_docs, share * documents of the host)`` documents are
boilerplate and removed; a document that keeps less than ``min_left`` of its words is
depleted and rejected. ``most_texts`` is an absolute limit beside the share, for hosts so large
that the share allows thousands of documents: lines in more than that many different texts of a
host go too. It counts texts, since the lines of a page copied thousands of times are no boilerplate.

All DataFrame operations. Only line hashes and word counts are shuffled, never texts; the
count is keyed by (host, line, document) first, so neither a hot host nor a hot line lands in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import SPACES, let, stored, words_of

MIN_DOCS, SHARE, MIN_LEFT = 20, 0.10, 0.3
WINDOW = 8


def _repeat_words(words: Column) -> Column:
    """Words of the text that lie in a ``WINDOW``-word window found twice or more in it."""

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n"), s.alias("last")
        )
        return F.aggregate(starts, zero, step, lambda acc: acc["n"])

    def starts_of(sorted_pairs: Column) -> Column:
        last = F.size(sorted_pairs) - 1
        same = lambda p, k, other: F.coalesce(F.get(sorted_pairs, other)["h"] == p["h"], F.lit(False))
        flagged = F.transform(
            sorted_pairs,
            lambda p, k: F.when(((k > 0) & same(p, k, k - 1)) | ((k < last) & same(p, k, k + 1)), p["i"]),
        )
        return F.sort_array(F.filter(flagged, lambda i: i.isNotNull()))

    def of_hashes(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        slow = let(F.sort_array(pairs), lambda p: let(starts_of(p), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(slow)

    def of_words(hashed: Column) -> Column:
        n = F.size(hashed)
        windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))
        return F.when(n < WINDOW, F.lit(0)).otherwise(let(windows, of_hashes))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _dup_lines(text: Column) -> Column:
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def document_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document: doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    no_space = F.translate(text, SPACES, "")
    counted = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")),
    )
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
            F.xxhash64(text).alias("text_key"),
            F.char_length(no_space).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            _dup_lines(text).cast("long").alias("n_dup_lines"),
            counted.alias("c"),
        )
        .select("*", "c.*")
        .drop("c")
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    )


def document_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per line with a word: doc_id, host, text_key, line_no, line (hash of the normalised line), line_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.transform(F.split(F.lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))
    normal = lambda x: F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")
    spaces = lambda x: F.char_length(x) - F.char_length(F.translate(x, " ", ""))
    lines = F.transform(
        F.filter(trimmed, lambda x: x != ""),
        lambda x: let(normal(x), lambda y: F.struct(F.xxhash64(y).alias("line"), (spaces(y) + 1).alias("words"))),
    )
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_key"),
        F.posexplode(lines).alias("line_no", "l"),
    ).select("doc_id", "host", "text_key", "line_no", F.col("l.line").alias("line"), F.col("l.words").alias("line_words"))


def line_frequency_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = MIN_DOCS,
    share: float = SHARE,
    min_left: float = MIN_LEFT,
    most_texts: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_boilerplate_words, kept.

    Null text has no words; a null host is the host named ''; a null id is an id of its own;
    repeated rows count as one document and get equal results; an empty table
    gives no rows. Other columns are not read.
    """
    names = {"id_col": id_col, "text_col": text_col, "host_col": host_col}
    counts = document_counts(docs, **names)
    lines = stored(document_lines(docs, **names), "line-rules")  # hashed once, read for the counts and for the removal
    one_null = F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    hosts = (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))
        .groupBy("host")
        .agg((F.count_distinct("doc_id") + one_null).alias("host_docs"))
    )
    per_line = [(F.count_distinct("doc_id") + one_null).alias("line_docs")]
    too_many_texts = F.lit(False)
    if most_texts is not None:
        per_line.append(F.count_distinct("text_key").alias("line_texts"))
        too_many_texts = F.col("line_texts") > most_texts
    above = F.col("line_docs") > F.greatest(F.lit(float(min_docs)), F.lit(share) * F.col("host_docs"))
    common = (
        lines.groupBy("host", "line")
        .agg(*per_line)
        .where((F.col("line_docs") > min_docs) | too_many_texts)
        .join(hosts, "host")
        .where(above | too_many_texts)
        .select("host", "line")
    )
    removed = (
        lines.join(common, ["host", "line"], "left_semi")
        # equal rows of one document (same id, host and text) give the same lines: count them once
        .groupBy("doc_id", "host", "text_key", "line_no")
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("doc_id", "host", "text_key")
        .agg(F.sum("line_words").alias("removed_words"))
    )
    same = [counts[c].eqNullSafe(removed[c]) for c in ("doc_id", "host", "text_key")]
    left = F.col("n_words") - F.coalesce(F.col("removed_words"), F.lit(0))
    return counts.join(removed, same, "left").select(
        counts["doc_id"],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.coalesce(F.col("removed_words"), F.lit(0)).cast("long").alias("n_boilerplate_words"),
        (~F.col("base_failed") & (left >= F.lit(min_left) * F.col("n_words"))).alias("kept"),
    )
