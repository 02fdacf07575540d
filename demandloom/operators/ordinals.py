"""Positions in a global sort order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.session import pin


def sorted_positions(distinct_rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in the ascending order of ``order``.

    Rows are range-partitioned and sorted within their partition; a position is then the
    rows of all earlier partitions plus the place inside its own. The partitioned rows are
    pinned, so both parts of that sum speak of the same partitions even after a retry.
    """
    placed = pin(
        distinct_rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id()),
        "positions",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select("_part", "_first", "_start")
    )
    return placed.join(F.broadcast(starts), "_part").select(  # one row per partition
        *distinct_rows.columns,
        (F.col("_start") + F.col("_seq") - F.col("_first")).alias(name),
    )


def ordinal_codes(df: DataFrame, key: str, code: str) -> DataFrame:
    """``(key, code)``: position of each distinct non-null key in sorted order, from 0."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return sorted_positions(keys, [key], "_pos").select(key, F.col("_pos").cast("int").alias(code))


def label_ordinals(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(field, label, code)`` for several label columns in one pass, pinned for the lookups."""
    pairs = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), F.col(c).alias("label")) for c in labels
        ])).alias("pair"))
        .select("pair.*")
        .where(F.col("label").isNotNull())
        .distinct()
    )
    placed = sorted_positions(pairs, ["field", "label"], "_pos")
    firsts = placed.groupBy("field").agg(F.min("_pos").alias("_first"))
    coded = placed.join(F.broadcast(firsts), "field").select(  # one row per label column
        "field", "label", (F.col("_pos") - F.col("_first")).cast("int").alias("code")
    )
    return pin(coded, "label-codes")
