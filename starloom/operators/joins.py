"""Joins: natural keys, code lookups, first match, bands.

No join here forces a broadcast. Spark broadcasts a side when its known or measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides
otherwise; a hot key on the fact side is then split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.aggregate import dedupe, pivot_values


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def natural_key_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    out: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join on several descriptive columns (fact column -> dimension column).

    Adds the ``out`` columns of the dimension. Rows that match more than one
    dimension row come out once per match.
    """
    keyed = dim.select(
        [F.col(d).alias(f"_key{i}") for i, d in enumerate(on.values())] + [F.col(c) for c in out]
    )
    condition = _all([facts[f] == keyed[f"_key{i}"] for i, f in enumerate(on)])
    return facts.join(keyed, condition, how).drop(*[f"_key{i}" for i in range(len(on))])


def first_match_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    out: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Left lookup that adds one dimension row at most: the first by ``order``.

    The dimension is cut to one row per key before the join, so the row count of
    the facts never changes.
    """
    unique = dedupe(dim, list(on.values()), keep="first", order=order)
    return natural_key_join(facts, unique, on, out, "left")


def lookup(
    df: DataFrame,
    mapping: DataFrame,
    code: str,
    label: str,
    how: str = "left",
    keep_code: bool = True,
    mapping_code: str = "code",
    mapping_label: str = "label",
) -> DataFrame:
    """Add ``label`` for the code in column ``code``; an unknown code gives null.

    Mapping codes are text, the codes of the data may be numbers. A mapping code
    that is not a number cannot match a number and must not stop the query. With
    ``keep_code=False`` the code column goes; ``label`` may reuse its name.
    """
    code_type = df.schema[code].dataType
    sides = mapping.select(
        F.col(mapping_code).try_cast(code_type).alias("_code"),
        F.col(mapping_label).alias("_label"),
    )
    joined = df.join(sides, df[code] == sides["_code"], how)
    kept = [F.col(f"`{c}`") for c in df.columns if keep_code or c != code]
    return joined.select(*kept, F.col("_label").alias(label))


@dataclass(frozen=True)
class Band:
    """``left - right`` must lie in [-below, above]."""

    left: str
    right: str
    below: float
    above: float


def band_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    bands: Sequence[Band],
    binned: bool = False,
) -> DataFrame:
    """Inner join on equal keys and numeric tolerances.

    Column names of the two sides must differ. ``binned`` cuts the first band's axis
    into bins as wide as the band and adds the bin to the equal keys: a key with very
    many rows is then spread over its bins, and only near rows are compared. A right
    row lies in two bins at most and a pair meets in exactly one, so the right side
    should be the smaller.
    """
    equal = [left[a] == right[b] for a, b in on.items()]
    if binned:
        first = bands[0]
        width = F.lit(float(first.below + first.above))
        if first.below + first.above <= 0:
            raise ValueError("a binned band must have a width")
        left = left.withColumn("_bin", F.floor(F.col(first.left) / width))
        right = right.withColumn(
            "_bins",
            F.explode(
                F.sequence(
                    F.floor((F.col(first.right) - F.lit(first.below)) / width),
                    F.floor((F.col(first.right) + F.lit(first.above)) / width),
                )
            ),
        )
        equal = [F.col(a) == F.col(b) for a, b in on.items()] + [F.col("_bin") == F.col("_bins")]
    near = [
        F.col(b.left).between(F.col(b.right) - F.lit(b.below), F.col(b.right) + F.lit(b.above))
        for b in bands
    ]
    joined = left.join(right, _all(equal + near), "inner")
    return joined.drop("_bin", "_bins")


def loose_band_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], bands: Sequence[Band]
) -> DataFrame:
    """Equal keys and bounds joined by OR: equal, or below the top, or above the bottom.

    Every non-null pair passes such a test, so this is the equal-key join of rows
    with non-null coordinates. ``right`` should have few rows per key.
    """
    def loose(b: Band) -> Column:
        x, y = F.col(b.left), F.col(b.right)
        return (x == y) | (x <= y + F.lit(b.above)) | (x >= y - F.lit(b.below))

    equal = [left[a] == right[b] for a, b in on.items()]
    return left.join(right, _all(equal + [loose(b) for b in bands]), "inner")


def full_outer(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Full outer join on equal keys; column names of the two sides must differ.

    Spark can neither split a hot key nor broadcast a side of a full outer join, but
    it can do both for its two halves: the left outer join, and the right rows
    whose key is nowhere on the left.
    """
    equal = [left[a] == right[b] for a, b in on.items()]
    matched = left.join(right, _all(equal), "left")
    known = left.select([F.col(a).alias(f"_key{i}") for i, a in enumerate(on)]).distinct()
    absent = [right[b] == known[f"_key{i}"] for i, b in enumerate(on.values())]
    lonely = right.join(known, _all(absent), "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def pivot_back(
    df: DataFrame, keys: Sequence[str], column: str, value: str, values: Sequence[str]
) -> DataFrame:
    """One row per entity and set of attributes: attributes once, the entity's pivoted values beside them.

    The input is read once. Rows are combined by keys and attributes before the shuffle, so
    a key with many rows is not moved to one task; only the combined rows meet by key, where
    each cell takes its largest value. Rows with a null in a key are left out.
    """
    attributes = [c for c in df.columns if c not in {*keys, column, value}]
    known = df.filter(_all([F.col(k).isNotNull() for k in keys]))
    wide = pivot_values(known, [*keys, *attributes], column, values, value)
    entity = Window.partitionBy(*keys)
    return wide.select(*keys, *attributes, *[F.max(f"`{v}`").over(entity).alias(str(v)) for v in values])
