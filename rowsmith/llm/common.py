"""Shared pieces of the corpus operators: column contracts, scratch tables, Arrow batch size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.session import scratch_path

#: Rows per Arrow batch for the operators that hand whole texts to Python: a batch of
#: 256 texts stays small even where every text is long. It changes no result.
TEXT_ROWS_PER_BATCH = 256

#: Where ids are ordered, rows without an id come from here on, in the order of a hash of their texts.
NO_ID = 1 << 62


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(df: DataFrame, rows: int = TEXT_ROWS_PER_BATCH) -> DataFrame:
    """Lower the session's Arrow batch size to ``rows`` (never raise it) before texts go to Python.

    The setting is read when the plan runs, so it stays set; it only bounds memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    return df


def order_key(id_col: str, text_col: str) -> Column:
    """The id as a long; for a null id a long from NO_ID on that tells its text apart. Never null."""
    by_text = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 2)
    return F.coalesce(F.col(id_col).cast("long"), by_text)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame, name: str, dictionary: bool = True) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and read it back.

    Cuts lineage on shared storage: a lost executor costs no recomputation. Without ``dictionary`` no dictionaries
    of values are tried, which is cheaper for columns of hashes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text leaves 2 modulo 4: such labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def known_labels(labels: DataFrame, label_col: str) -> DataFrame:
    """id, label of the rows that may be learned from: label 0 or 1, an id, not held out."""
    return labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most: tuple[int, int]) -> DataFrame:
    """doc_id, text, label of at most ``most[y]`` ids of each label y: those of the smallest hash of the id.

    One row per id and label (the text of the smallest hash), so an id that repeats can't pass the bound or weigh more than others.
    """
    known = known_labels(labels, label_col)
    parts = [known.where(F.col("label") == y).distinct().orderBy(F.xxhash64("id"), "id").limit(most[y]) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most sum(most) rows
    found = docs.join(chosen, docs["doc_id"] == F.col("id")).select("doc_id", "text", "label")
    one = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("doc_id", F.col("one.text").alias("text"), "label")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a one-element array binds it)."""
    return F.transform(F.array(value), body).getItem(0)


#: The bytes of ``[\x20\x09-\x0D]`` as a Java string for trim and translate.
SPACES = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: no words)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))
