"""Named external tables: one object ties a folder, its schema, the reader and the writer.

``register`` makes the table a temporary view, so it is queried with
``spark.sql`` like a warehouse table; Catalyst still prunes the fields a query
does not use, through the view, down to the positional parse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowsmith.functions.text import literal_char
from rowsmith.sinks.delimited import write_delimited
from rowsmith.sources.archives import read_archives
from rowsmith.sources.delimited import read_delimited


@dataclass(frozen=True)
class DelimitedTable:
    """A folder of delimited text files.

    ``delimiter`` is the reader's regex; lines are written with
    ``write_delimiter``, by default the character the regex stands for
    (``"\\\\|"`` reads and ``"|"`` is written) or the regex text itself.
    """

    path: str
    schema: str | T.StructType
    delimiter: str = ","
    write_delimiter: str | None = None
    encoding: str = "UTF-8"
    pattern: str | None = None
    pattern_on: str = "name"
    strip_cr: bool = False
    null_value: str | None = None
    on_bad_bytes: str = "fail"

    def read(self, spark: SparkSession, columns: list[str] | None = None) -> DataFrame:
        return read_delimited(
            spark,
            self.path,
            self.schema,
            columns=columns,
            delimiter=self.delimiter,
            null_value=self.null_value,
            encoding=self.encoding,
            pattern=self.pattern,
            pattern_on=self.pattern_on,
            strip_cr=self.strip_cr,
            on_bad_bytes=self.on_bad_bytes,
        )

    def write(self, df: DataFrame, mode: str = "append") -> None:
        delimiter = self.delimiter or ","
        out = self.write_delimiter or literal_char(delimiter) or delimiter
        write_delimited(df, self.path, delimiter=out, mode=mode)

    def register(self, spark: SparkSession, name: str) -> DataFrame:
        df = self.read(spark)
        df.createOrReplaceTempView(name)
        return df


@dataclass(frozen=True)
class ArchiveTable:
    """A folder of zip archives of delimited lines; written back as plain delimited text."""

    path: str
    schema: str | T.StructType
    delimiter: str = ","
    write_delimiter: str | None = None
    pattern: str | None = None
    pattern_on: str = "name"
    first_data_line: int = 1
    sentinel: str | None = "EOF"
    entry_newline: bool = False
    on_bad_archive: str = "fail"
    encoding: str = "utf-8"
    on_bad_bytes: str = "replace"
    null_value: str | None = None

    def read(self, spark: SparkSession, columns: list[str] | None = None) -> DataFrame:
        return read_archives(
            spark,
            self.path,
            self.schema,
            columns=columns,
            delimiter=self.delimiter,
            null_value=self.null_value,
            pattern=self.pattern,
            pattern_on=self.pattern_on,
            encoding=self.encoding,
            on_bad_bytes=self.on_bad_bytes,
            first_data_line=self.first_data_line,
            sentinel=self.sentinel,
            entry_newline=self.entry_newline,
            on_bad_archive=self.on_bad_archive,
        )

    def write(self, df: DataFrame, path: str, mode: str = "append") -> None:
        delimiter = self.delimiter or ","
        out = self.write_delimiter or literal_char(delimiter) or delimiter
        write_delimited(df, path, delimiter=out, mode=mode)

    def register(self, spark: SparkSession, name: str) -> DataFrame:
        df = self.read(spark)
        df.createOrReplaceTempView(name)
        return df
