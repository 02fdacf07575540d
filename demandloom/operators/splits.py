"""Time splits, their row accounting and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.scoring import percentage
from demandloom.schemas import Period, SplitSpec

OUTSIDE = "outside"


def in_period(period: Period, day: str = "date") -> Column:
    return F.col(day).between(F.lit(period.start), F.lit(period.end))


def split_label(spec: SplitSpec, day: str = "date") -> Column:
    return F.coalesce(*[F.when(in_period(p, day), p.name) for p in spec.periods], F.lit(OUTSIDE))


def select_period(df: DataFrame, period: Period, day: str = "date") -> DataFrame:
    """Inclusive date filter; reaches the scan as pushed range predicates."""
    return df.where(in_period(period, day))


def split_summary(features: DataFrame, spec: SplitSpec) -> DataFrame:
    """Rows, share and actual date range per split, and of rows outside all of them."""
    counted = features.groupBy(split_label(spec).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )
    names = F.array(*[F.lit(p.name) for p in spec.periods], F.lit(OUTSIDE))
    listed = features.sparkSession.range(1).select(F.explode(names).alias("split"))
    # At most four rows from here on.
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return (
        counted.join(listed, "split", "right")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .withColumn("pct", percentage(F.col("rows"), total))
        .select("split", "rows", "pct", "min_date", "max_date")
    )


def split_checks(features: DataFrame, spec: SplitSpec, expected_rows: int | None = None) -> DataFrame:
    """One row of pass/fail flags over the accounting."""
    train, validation, test = spec.periods
    ordered = train.end < validation.start < validation.end < test.start
    disjoint = train.end < validation.start and validation.end < test.start
    label = split_label(spec)
    first = {p.name: F.min(F.when(label == p.name, F.col("date"))) for p in spec.periods}
    last = {p.name: F.max(F.when(label == p.name, F.col("date"))) for p in spec.periods}
    apart = (last[train.name] < first[validation.name]) & (last[validation.name] < first[test.name])
    counted = features.agg(
        F.coalesce(apart, F.lit(False)).alias("dates_apart_ok"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(label != OUTSIDE).alias("assigned_rows"),
        F.count_if(label == OUTSIDE).alias("outside_rows"),
    )
    expected = F.lit(True) if expected_rows is None else F.col("total_rows") == expected_rows
    return counted.select(
        "*",
        (F.col("assigned_rows") + F.col("outside_rows") == F.col("total_rows")).alias("accounting_ok"),
        F.lit(ordered).alias("ordering_ok"),
        F.lit(disjoint).alias("no_overlap_ok"),
        expected.alias("expected_total_ok"),
    )
