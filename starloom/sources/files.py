"""File sources: JSON lines, CSV, text, parquet and pluggable landing formats."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from starloom.functions import truncated

_TOP_LEVEL = re.compile(r"^\$(?:\.([A-Za-z_][A-Za-z0-9_]*)|\['([^']+)'\])$")


# What becomes of records that do not fit the declared schema.
MODES = ("fail", "keep")
BAD_RECORD = "_bad_record"
# Stands for null in CSV where every field is quoted.
NULL_MARK = "\\N"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _strict(spark: SparkSession, schema: T.StructType, mode: str) -> DataFrameReader:
    """A reader that stops at the first bad record, or keeps its text in ``_bad_record``."""
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    if mode == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST")
    kept = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None):
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_json(
    spark: SparkSession, root: str, schema: T.StructType, depth: int = 0, mode: str = "fail"
) -> DataFrame:
    """JSON lines below ``root``, ``depth`` folders down.

    ``mode`` "fail" stops at a line that is no JSON or does not fit the schema; "keep"
    adds the column ``_bad_record`` with the text of such lines, null in good ones.
    """
    return _strict(spark, schema, mode).json("/".join([root.rstrip("/")] + ["*"] * depth + ["*.json"]))


def read_json_tree(
    spark: SparkSession, root: str, schema: T.StructType, suffix: str = "*.json", mode: str = "fail"
) -> DataFrame:
    """JSON lines of all files below ``root`` whose name ends as asked, at any depth."""
    reader = _strict(spark, schema, mode).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", suffix).json(root)


def cut_to_widths(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    return df.withColumns({name: truncated(name, width) for name, width in widths.items()})


def conform_types(df: DataFrame, schema: T.StructType, tolerant: bool = False) -> DataFrame:
    """Select the columns of ``schema`` by name and cast each to its declared type.

    ``tolerant`` turns values that cannot be cast into nulls.
    """
    def typed(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        return (c.try_cast(kind) if tolerant else c.cast(kind)).alias(field.name)

    return df.select([typed(field) for field in schema.fields])


def stage_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    json_paths: Sequence[str] | None = None,
    widths: Mapping[str, int] | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Bulk load of JSON lines.

    Without ``json_paths`` fields are taken by name. With it, path ``i`` fills
    column ``i`` of ``schema``, whatever the field is called. ``widths`` cuts text
    to its declared width; without it long text is kept as it is. ``mode`` is that of
    ``read_json``.
    """
    if json_paths is None:
        staged = _strict(spark, schema, mode).json(path)
    else:
        staged = pick_json_paths(spark.read.text(path), "value", json_paths, schema, mode)
    return cut_to_widths(staged, widths) if widths else staged


def pick_json_paths(
    df: DataFrame,
    column: str,
    json_paths: Sequence[str],
    schema: T.StructType,
    mode: str = "fail",
) -> DataFrame:
    """Read typed columns out of a JSON text column by position in a path list.

    A record is bad when it is no JSON or a value does not fit its type; a path that
    leads nowhere gives null. Blank lines are no records.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    if len(json_paths) != len(schema.fields):
        raise ValueError(f"{len(json_paths)} paths for {len(schema.fields)} columns")
    names = [_TOP_LEVEL.match(path) for path in json_paths]
    df = df.filter(F.col(column).isNull() | (F.trim(column) != ""))
    if all(names):
        # One parse of the text for all fields.
        fields = [m.group(1) or m.group(2) for m in names]
        raw = df.select(F.col(column).alias(BAD_RECORD), F.json_tuple(F.col(column), *fields).alias(*schema.names))
    else:
        raw = df.select(
            F.col(column).alias(BAD_RECORD),
            *[F.get_json_object(column, p).alias(n) for p, n in zip(json_paths, schema.names)],
        )
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields]
    lost = reduce(or_, [t.isNull() & F.col(f"`{f.name}`").isNotNull() for t, f in zip(typed, schema.fields)])
    bad = lost | (F.col(BAD_RECORD).isNotNull() & F.get_json_object(BAD_RECORD, "$").isNull())
    picked = [t.alias(f.name) for t, f in zip(typed, schema.fields)]
    if mode == "keep":
        return raw.select(*picked, F.when(bad, F.col(BAD_RECORD)).alias(BAD_RECORD))
    stopped = F.raise_error(F.concat(F.lit("bad record: "), BAD_RECORD)).cast("boolean")
    return raw.filter(F.when(bad, stopped).otherwise(True)).select(*picked)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    mode: str = "fail",
    multiline: bool = True,
    **options,
) -> DataFrame:
    """CSV with a header per file. A doubled quote inside quoted text is one quote.

    Unquoted nothing and ``NULL_MARK`` are null, quoted nothing is empty text (pass
    ``nullValue=""`` for files that quote their nulls). ``multiline`` keeps line
    breaks inside quotes; such a file is read by one task, so writers keep files small
    (``write_csv``). Turn it off for large files without such text, to have them split.
    ``mode`` is that of ``read_json``.
    """
    reader = _strict(spark, schema, mode).option("header", True).option("sep", sep)
    reader = reader.option("multiLine", multiline).option("lineSep", "\n")
    reader = reader.option("nullValue", NULL_MARK).option("quote", '"').option("escape", '"')
    return reader.options(**options).csv(path)


def select_positions(df: DataFrame, positions: Sequence[int], names: Sequence[str] | None = None):
    """Columns by position, optionally renamed."""
    picked = df.select([F.col(f"`{df.columns[i]}`") for i in positions])
    return picked.toDF(*names) if names else picked


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Any installed format by name, so that a binary landing zone needs no code here."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_whole_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file, the text uncut."""
    return spark.read.text(path, wholetext=True)
