"""Parquet, CSV and text writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.sources.files import NULL_MARK


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    max_records_per_file: int = 0,
    compression: str | None = None,
) -> None:
    """Parquet, optionally in one folder per partition value.

    Rows are first gathered by partition value so that each value ends up in few
    files. The rebalance splits a value that holds much of the table over several
    tasks and merges small ones; a plain repartition would put a hot value on one
    task. A null value goes to the default partition folder. ``compression`` is the session's
    unless it is named.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *partition_by)
    out = writer.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if compression:
        out = out.option("compression", compression)
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    quote_all: bool = False,
    mode: str = "overwrite",
    max_records_per_file: int = 1_000_000,
    compression: str = "none",
) -> None:
    """CSV files with a header each, written by the executors.

    Text comes back as it is, with line breaks, quotes and blanks at its ends. Null is
    written as nothing and empty text as two quotes; with ``quote_all`` null is
    ``NULL_MARK``, the only text that does not come back. ``max_records_per_file`` bounds
    what one task has to read, since text with line breaks cannot be split. ``read_csv`` takes
    compressed files as they are.
    """
    out = df.write.mode(mode).option("header", True).option("sep", sep).option("lineSep", "\n")
    out = out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    out = out.option("maxRecordsPerFile", max_records_per_file).option("compression", compression)
    out = out.option("nullValue", NULL_MARK if quote_all else "")
    out.option("quoteAll", quote_all).option("escape", '"').csv(path)


def write_text(
    df: DataFrame, path: str, separator: str = "\n", max_records_per_file: int = 0
) -> None:
    """One text column; ``max_records_per_file`` bounds what a whole-file read has to hold."""
    out = df.write.mode("overwrite").option("lineSep", separator)
    out.option("maxRecordsPerFile", max_records_per_file).text(path)
