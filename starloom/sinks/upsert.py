"""Keyed upsert: insert, and on a key conflict the later row replaces the earlier one.

A table is cut into buckets by a hash of its key. A merge writes the batch alone, as
a delta sorted by key beside each bucket's base; a reader takes the newest row per key
of both. So a merge costs what the batch holds, however many buckets its keys are
spread over. A bucket whose deltas have grown past a share of its base is folded into
a new base by the next merge, which spreads rewriting thinly over many merges.

A manifest is a small file that names the base and the deltas of every bucket. It is
the commit mark: what has none does not count, so a write that fails half-way leaves
the table as it was. Files are never changed, and versions share them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.operators.aggregate import dedupe
from starloom.session import child_dirs, child_files, create_file, delete_path, read_file

_VERSION, _BUCKET = "version=", "_bucket"
DEFAULT_BUCKETS = 16
FOLD_SHARE = 0.5  # deltas with more rows than this share of their base are folded into it
FOLD_DELTAS = 16  # so are deltas that are more than this many
ONE_SHUFFLE_SHARE = 0.1  # from this share on, reading sorts base and deltas together instead of joining them


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class Part(NamedTuple):
    """Files of one bucket: the data folder that holds them, and their rows."""

    written_by: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    """One version of a table: for each bucket a base with one row per key, then deltas."""

    number: int
    keys: list[str]
    order: list[str]
    buckets: int
    parts: dict[int, list[Part]] = field(default_factory=dict)
    mark: int = -1  # how far a caller's own input is merged

    def to_text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_text(text: str) -> Manifest | None:
        """None when the text was cut off while it was written."""
        try:
            found = json.loads(text)
        except ValueError:
            return None
        parts = {int(b): [Part(*p) for p in stack] for b, stack in found["parts"].items()}
        return Manifest(**found | {"parts": parts})

    @property
    def written_by(self) -> dict[int, int]:
        """The data folder that each bucket was last written to."""
        return {b: stack[-1].written_by for b, stack in self.parts.items()}

    def due(self, share: float = FOLD_SHARE, deltas: int = FOLD_DELTAS) -> list[int]:
        """Buckets whose deltas are too large or too many."""
        return sorted(
            b for b, (base, *rest) in self.parts.items()
            if rest and (len(rest) > deltas or sum(p.rows for p in rest) > share * base.rows)
        )


def upsert(
    target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows of both, one per key: the highest by ``order``.

    Rows that tie in ``order`` are ranked by their other columns, so the result does
    not depend on how rows are spread or on how often a batch is applied. Target rows
    whose key is not in the batch pass through: with a batch small enough to broadcast
    they are not shuffled, otherwise both joins share one shuffle of the target.
    """
    if target is None:
        return dedupe(batch, keys, keep="last", order=order)
    touched = batch.select([F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    )
    contested = target.join(touched, same, "left_semi").unionByName(batch)
    newest = dedupe(contested, keys, keep="last", order=order)
    return target.join(touched, same, "left_anti").unionByName(newest)


def _data(root: str, number: int) -> str:
    return f"{root}/data/{_VERSION}{number:012d}"


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/manifests/{number:012d}.json"


def _bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def current_version(spark: SparkSession, root: str) -> Manifest | None:
    """The newest committed version."""
    for name in sorted(child_files(spark, f"{root}/manifests"), reverse=True):
        if found := Manifest.from_text(read_file(spark, f"{root}/manifests/{name}")):
            return found
    return None


def _scan(spark: SparkSession, root: str, parts: Sequence[tuple[int, Part]], schema: T.StructType) -> DataFrame:
    """All rows of some (bucket, part) pairs, older versions of a key too."""
    paths = [f"{_data(root, part.written_by)}/{_BUCKET}={b}" for b, part in parts]
    return spark.read.schema(schema).parquet(*paths)


def read_version(
    spark: SparkSession, root: str, manifest: Manifest, schema: T.StructType, buckets: Iterable[int] | None = None
) -> DataFrame:
    """Rows of a version, or of some of its buckets: the newest per key.

    Buckets without deltas are a plain scan. Of the others, small deltas are joined to
    their bases, whose other rows pass through; large ones go through one shuffle with them.
    """
    wanted = sorted(manifest.parts if buckets is None else set(buckets) & set(manifest.parts))
    stacks = {b: manifest.parts[b] for b in wanted}
    still = [(b, stack[0]) for b, stack in stacks.items() if len(stack) == 1]
    bases = [(b, stack[0]) for b, stack in stacks.items() if len(stack) > 1]
    deltas = [(b, part) for b, stack in stacks.items() for part in stack[1:]]
    found = [_scan(spark, root, still, schema)] if still else []
    if sum(p.rows for _, p in deltas) > ONE_SHUFFLE_SHARE * sum(p.rows for _, p in bases):
        rows = _scan(spark, root, bases + deltas, schema)
        found.append(dedupe(rows, manifest.keys, keep="last", order=manifest.order))
    elif deltas:
        base, changes = (_scan(spark, root, parts, schema) for parts in (bases, deltas))
        found.append(upsert(base, changes, manifest.keys, manifest.order))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _write(rows: DataFrame, root: str, number: int, keys: Sequence[str], buckets: int) -> dict[int, Part]:
    """Write rows as one data folder, sorted by key inside each bucket; what each bucket got."""
    spark, path = rows.sparkSession, _data(root, number)
    placed = rows.withColumn(_BUCKET, _bucket_of(keys, buckets)).hint("rebalance", _BUCKET)
    placed.sortWithinPartitions(_BUCKET, *keys).write.mode("error").partitionBy(_BUCKET).parquet(path)
    # No column is read: file footers hold the row counts. One row per bucket at most.
    written = spark.read.schema(f"{_BUCKET} int").parquet(path).groupBy(_BUCKET).count()
    return {b: Part(number, n) for b, n in written.collect()}


def _next_folder(spark: SparkSession, root: str, fresh: bool = True) -> int:
    """A data folder that nobody wrote to: a failed write may have left files under a number."""
    used = [int(d[len(_VERSION):]) for d in child_dirs(spark, f"{root}/data")]
    if used and not fresh:
        raise RuntimeError(f"{root} holds data but no manifest; pass fresh=True to start over")
    return max(used, default=0) + 1


def _commit(spark: SparkSession, root: str, made: Manifest) -> Manifest:
    if not create_file(spark, _manifest_path(root, made.number), made.to_text()):
        raise Conflict(f"version {made.number} of {root} was committed by another writer")
    return made


def upsert_into(
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = DEFAULT_BUCKETS,
    mark: int = -1,
    fresh: bool = False,
    share: float = FOLD_SHARE,
) -> DataFrame:
    """Merge a batch into the table at ``root`` and return the new version.

    The batch is written once: as deltas, and in buckets that were due before it
    (deltas with more rows than ``share`` of the base) together with all that the bucket
    holds, as a new base. ``buckets`` counts for a new table only; choose it so that a
    bucket fits a few tasks. Data without any manifest is no empty table: a manifest was
    lost or the first write failed, and ``fresh`` says to start over. Two merges at once:
    the second to commit raises ``Conflict`` and can be run again. Key and order are the
    table's own and cannot change. ``mark`` is kept in the manifest for the caller.
    """
    spark = batch.sparkSession
    now = current_version(spark, root)
    if now is None:
        number = _next_folder(spark, root, fresh)
        now = Manifest(0, list(keys), list(order), buckets)
    else:
        number = max(_next_folder(spark, root), now.number + 1)
    for name, own, given in (("key", now.keys, list(keys)), ("order", now.order, list(order))):
        if own != given:
            raise ValueError(f"the table's {name} is {own}, not {given}")
    due, rows = now.due(share), batch
    if due:
        rows = batch.unionByName(_scan(spark, root, [(b, p) for b in due for p in now.parts[b]], batch.schema))
    written = _write(dedupe(rows, keys, keep="last", order=order), root, number, keys, now.buckets)
    parts = dict(now.parts)
    for b, part in written.items():
        parts[b] = [part] if b in due else [*parts.get(b, []), part]
    made = Manifest(now.number + 1, now.keys, now.order, now.buckets, parts, max(mark, now.mark))
    return read_version(spark, root, _commit(spark, root, made), batch.schema)


def compact(spark: SparkSession, root: str, schema: T.StructType, share: float = 0.0) -> Manifest | None:
    """Fold the deltas of all buckets where they have more rows than ``share`` of the base; the current version."""
    now = current_version(spark, root)
    due = now.due(share) if now is not None else []
    if not due:
        return now
    number = max(_next_folder(spark, root), now.number + 1)
    written = _write(read_version(spark, root, now, schema, due), root, number, now.keys, now.buckets)
    parts = now.parts | {b: [part] for b, part in written.items()}
    return _commit(spark, root, Manifest(now.number + 1, now.keys, now.order, now.buckets, parts, now.mark))


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions, and files that no kept one refers to.

    Readers of an older version and all writers must be done.
    """
    names = sorted(child_files(spark, f"{root}/manifests"))
    old, kept = (names[:-keep], names[-keep:]) if keep else (names, [])
    manifests = [Manifest.from_text(read_file(spark, f"{root}/manifests/{n}")) for n in kept]
    used = {(part.written_by, b) for m in manifests if m for b, stack in m.parts.items() for part in stack}
    for name in old:
        delete_path(spark, f"{root}/manifests/{name}")
    for folder in child_dirs(spark, f"{root}/data"):
        number = int(folder[len(_VERSION):])
        if not any(v == number for v, _ in used):
            delete_path(spark, f"{root}/data/{folder}")
            continue
        for part in child_dirs(spark, f"{root}/data/{folder}"):
            if part.startswith(f"{_BUCKET}=") and (number, int(part[len(_BUCKET) + 1:])) not in used:
                delete_path(spark, f"{root}/data/{folder}/{part}")
    return [int(n.removesuffix(".json")) for n in old]
