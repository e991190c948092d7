"""The given tables, read from a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.session import default_parallelism

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the table has fewer files than that.

    A table stored as one file with one row group scans in a single task;
    heavy per-row work after it (splitting texts, parsing lines) would then
    run on one core. A table of many files already has enough tasks
    and is returned unchanged, so large inputs get no extra shuffle.
    """
    cores = default_parallelism(df.sparkSession)
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str, *, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df
