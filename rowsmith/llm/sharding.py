"""Range sharding by sampled splitters: equal shards in bytes, whatever the sizes and ties.

1. Every record gets a range key (hash of its text, so equal texts lie together) and a size.
2. Records are drawn with a chance proportional to their size; the quantiles of the drawn
   keys are the splitters of ``ranges`` key ranges.
3. Records are range-partitioned by the splitters. A range that holds more than
   ``overfull`` times its share (a hot key, which no splitter can cut) or more than
   ``piece_rows`` records (a large table) is subdivided by a stored salt, so that every
   piece, the work of one task, is about within both.
4. Exact sums per piece give every piece's place on the line of all bytes; inside a
   piece a running sum gives each record's. A record goes to the shard in whose
   equal stretch of the line the middle of its bytes lies.

Everything is DataFrame operations. What reaches the driver is bounded by parameters: the
drawn keys (about ``ranges * draws``), one row per range, and one per piece.

The salt of a record is drawn from its place in the input files: where the same rows lie in
other files, the records of a subdivided range can get other shards. The law holds either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowsmith.llm.common import stored

#: Salt values stored with every record; the most pieces into which one range can be cut.
SALTS = 4096


def _range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters <= key."""
    if not splitters:
        return F.lit(0)
    cuts = F.array(*[F.lit(x) for x in splitters])
    return F.size(F.filter(cuts, lambda x: x <= key))


def shard_by_splitters(
    docs: DataFrame,
    shards: int = 16,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges: int = 256,
    draws: int = 32,
    overfull: float = 2.0,
    piece_rows: int = 1 << 22,
) -> DataFrame:
    """One row per record: id, ``size`` (UTF-8 bytes plus 1; null text: 1), ``text_crc32``
    (null text: that of no bytes), ``law`` 'bytes', ``shard`` and ``slot`` (gapless from 0
    in each shard), ``grown_shard`` null.

    Two shards' bytes differ by at most two records' sizes. Null ids and repeated
    rows are records like any other (equal rows are interchangeable); an empty table gives no
    rows; columns other than the id and the text are not read, so their names can't clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            # stored below, so a recomputed task can't deal a record anew
            F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"),
        ),
        "sharding-base",
    )
    total = base.agg(F.sum("size")).first()[0] or 0
    # Size-weighted draw: a record is drawn if its own uniform number is under its share of the draws.
    chance = F.col("size") * F.lit(float(ranges * draws)) / F.lit(float(max(total, 1)))
    uniform = F.pmod(F.xxhash64("key", "doc_id", "salt"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = sorted(r[0] for r in base.where(uniform < chance).select("key").collect())
    splitters = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []

    placed = base.withColumn("range_no", _range_of(F.col("key"), splitters))
    share = max(1.0, total / ranges)
    by_bytes, by_rows = F.ceil(F.sum("size") / F.lit(share * overfull)), F.ceil(F.count("*") / F.lit(piece_rows))
    pieces = F.least(F.lit(SALTS), F.greatest(by_bytes, by_rows)).cast("int")
    cuts = dict(placed.groupBy("range_no").agg(pieces.alias("n")).collect())
    of_range = F.array(*[F.lit(cuts.get(r, 1)) for r in range(len(splitters) + 1)])
    piece = F.pmod("salt", F.get(of_range, F.col("range_no")))
    placed = placed.withColumn("piece", piece)

    # One row per piece (at most 2 * ranges + rows / piece_rows): its place on the line of all bytes.
    sums = sorted(tuple(r) for r in placed.groupBy("range_no", "piece").agg(F.sum("size"), F.count("*")).collect())
    before, at_byte, at_row = [], 0, 0
    for range_no, piece_no, n_bytes, n_rows in sums:
        before.append((range_no, piece_no, at_byte, at_row))
        at_byte, at_row = at_byte + n_bytes, at_row + n_rows
    spark = docs.sparkSession
    starts = spark.createDataFrame(before, "range_no int, piece int, byte_start long, row_start long")

    order = Window.partitionBy("range_no", "piece").orderBy("key", "doc_id", "size", "text_crc32", "salt")
    lined = (
        placed.withColumn("end_byte", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("row_no", F.row_number().over(order))
        .join(F.broadcast(starts), ["range_no", "piece"])
        .withColumn("row_no", F.col("row_start") + F.col("row_no") - 1)
        # twice the middle of the record's bytes, so that it stays a whole number
        .withColumn("middle", 2 * (F.col("byte_start") + F.col("end_byte")) - F.col("size"))
        .withColumn(
            "shard", F.expr(f"cast(least({shards - 1}L, (middle * {shards}L) div {2 * max(total, 1)}L) as int)")
        )
        .select("doc_id", "size", "text_crc32", "shard", "row_no")
    )
    lined = stored(lined, "sharding-lined")
    firsts = lined.groupBy("shard").agg(F.min("row_no").alias("first_row"))  # one row per shard
    return lined.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_no") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
