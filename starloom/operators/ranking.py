"""Row numbers that no single task has to compute alone.

A window without a partition, or with a hot key in one, sorts all those rows in one
task. Here rows are range-partitioned by the full order instead, numbered inside
their partition, and shifted by the number of rows in the partitions before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.session import materialise

# Fixed layout of generated ids: partition number above, row number in the low 33 bits.
_ROW_BITS = 33


def row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, not dense, not stable between runs; costs no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _sorted_slots(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Range-sorted copy of the rows with partition and place in it.

    The copy is written out: range bounds are sampled, so evaluating the sort again
    could put a row into another partition.
    """
    spread = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    slotted = materialise(spread.withColumn("_slot", F.monotonically_increasing_id()), label)
    return slotted.withColumns({
        "_part": F.shiftright("_slot", _ROW_BITS),
        "_place": F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    }).drop("_slot")


def dense_id(df: DataFrame, order: Sequence[str], name: str = "id", start: int = 1) -> DataFrame:
    """Ids without gaps in the given total order."""
    slots = _sorted_slots(df, order, "dense-id")
    counts = slots.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: a small fixed number, whatever the table holds.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    shifted = slots.join(offsets, "_part").withColumn(
        name, F.col("_before") + F.col("_place") + F.lit(start)
    )
    return shifted.select(*[F.col(f"`{c}`") for c in df.columns], name)


def position_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """1-based place of each row in its key by a total order.

    A key may span several range partitions; only those few need a shift.
    """
    slots = _sorted_slots(df, [*keys, *order], "position")
    run = [*keys, "_part"]
    counts = slots.groupBy(*run).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_before", F.sum("_rows").over(before))
        .filter(F.col("_before").isNotNull())
        .select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(run)], "_before")
    )
    in_run = F.row_number().over(Window.partitionBy(*run).orderBy("_place"))
    same = [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(run)]
    placed = slots.withColumn("_in_run", in_run).join(offsets, same, "left")
    place = (F.col("_in_run") + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint")
    return placed.withColumn(name, place).select(*[F.col(f"`{c}`") for c in df.columns], name)
