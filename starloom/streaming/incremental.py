"""Incremental load: new files only, merged by key.

Each micro-batch is stored under its batch number, so its cost follows the size of
the batch and a retried batch replaces its own output. The keyed merge with the
target runs once per run, over the batches it has not merged yet, and writes their
newest rows beside the buckets that hold their keys. The manifest of the target carries
the last merged batch number, which makes "not merged yet" a comparison.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from starloom.operators.aggregate import dedupe
from starloom.session import child_dirs, delete_path
from starloom.sinks.upsert import DEFAULT_BUCKETS, current_version, read_version, upsert_into

_BATCH = "batch="


@dataclass(frozen=True)
class FileFeed:
    """A folder that files keep arriving in."""

    path: str
    schema: T.StructType
    fmt: str = "parquet"
    files_per_batch: int = 1000
    options: dict = field(default_factory=dict)

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(self.schema).format(self.fmt).options(**self.options)
        return reader.option("maxFilesPerTrigger", self.files_per_batch).load(self.path)


def incremental_upsert(
    spark: SparkSession,
    feed: FileFeed,
    target: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Take in all files that arrived since the last run and return the merged table.

    Progress, stored batches and versions all live below ``target``. A row that
    arrives late but is older by ``order`` does not replace a newer one. A run without
    new files writes nothing.
    """
    def store(batch: DataFrame, number: int) -> None:
        newest = dedupe(batch, keys, keep="last", order=order)
        newest.write.mode("overwrite").parquet(_batch_path(target, number))

    query = (
        feed.stream(spark)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return merge_batches(spark, target, feed.schema, keys, order, buckets)


def merge_batches(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Merge stored batches beyond the current version's mark into a new one."""
    now = current_version(spark, target)
    stored = [int(d[len(_BATCH):]) for d in child_dirs(spark, f"{target}/batches")]
    fresh = [n for n in stored if now is None or n > now.mark]
    if not fresh:
        return read_version(spark, target, now, schema) if now is not None else spark.createDataFrame([], schema)
    changes = spark.read.schema(schema).parquet(*[_batch_path(target, n) for n in fresh])
    return upsert_into(changes, target, keys, order, buckets, mark=max(fresh))


def prune_batches(spark: SparkSession, target: str) -> list[int]:
    """Delete stored batches that the current version already holds."""
    now = current_version(spark, target)
    stored = [int(d[len(_BATCH):]) for d in child_dirs(spark, f"{target}/batches")]
    merged = [n for n in stored if now is not None and n <= now.mark]
    for number in merged:
        delete_path(spark, _batch_path(target, number))
    return merged


def _batch_path(target: str, number: int) -> str:
    return f"{target}/batches/{_BATCH}{number:012d}"
