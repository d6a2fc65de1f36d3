"""Physical layout: co-location by key and order on storage.

Replication of small tables is left to Spark, which broadcasts by measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def cluster(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Range-partition by key, then order inside each partition.

    The clustering columns take part in the range bounds, so a key with very many
    rows spans several partitions instead of one. Row groups then have narrow
    key ranges, which point and range reads skip by. ``unique`` keeps one row of those that are
    equal in all columns; where these are the clustering columns, that needs no shuffle of its own.
    """
    columns = [*keys, *order]
    spread = df.repartitionByRange(*columns)
    return (spread.distinct() if unique else spread).sortWithinPartitions(*columns)


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    order: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Bucketed table: joins and groupings on the keys need no shuffle of this side."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    writer = writer.sortBy(*(order or keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
