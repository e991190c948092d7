"""Word splitting and word counts over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.text import LINE_END_REGEX, drop_last_empty, tokens


def lines_of(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, with_number: bool = False) -> DataFrame:
    """Explode a whole-file text column into ``value`` lines (``readLine`` rules).

    ``with_number`` adds ``line_no`` (1-based physical line number).
    """
    keep_cols = [F.col(k) for k in (keep or [])]
    # Split once in its own projection; the last-empty check reads the array three times.
    split = df.select(*keep_cols, F.split(text_col, LINE_END_REGEX, -1).alias("__pieces"))
    lines = drop_last_empty(F.col("__pieces"))
    if with_number:
        return split.select(*keep_cols, F.posexplode(lines).alias("line_no", "value")).withColumn(
            "line_no", (F.col("line_no") + 1).cast("bigint")
        )
    return split.select(*keep_cols, F.explode(lines).alias("value"))


def words(lines: DataFrame, col: str = "value", keep: list[str] | None = None, with_number: bool = False) -> DataFrame:
    """One row per word of each line (``split(" ")``); ``with_number`` adds 1-based ``word_no``."""
    keep_cols = [F.col(k) for k in (keep or [])]
    if with_number:
        return lines.select(*keep_cols, F.posexplode(tokens(col)).alias("word_no", "word")).withColumn(
            "word_no", (F.col("word_no") + 1).cast("bigint")
        )
    return lines.select(*keep_cols, F.explode(tokens(col)).alias("word"))


def word_count(lines: DataFrame, col: str = "value", by: list[str] | None = None) -> DataFrame:
    """``(word, cnt)`` over all lines; ``by`` adds grouping columns (for example a batch or window).

    Planned as a partial hash aggregate in every map task, then one shuffle
    by word: a very frequent word reaches each reducer as one row per map
    task, so hot words do not skew the shuffle.
    """
    group = [*(by or []), "word"]
    return words(lines, col, keep=by).groupBy(*group).agg(F.count(F.lit(1)).alias("cnt"))
