"""Errors, buckets and labels of scored rows, and the one list of regression metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Demand ranges by their inclusive edges. Fractions between two ranges match
# none of them and are reported under UNBUCKETED.
DEMAND_RANGES = (
    ("demand = 0", 0.0, 0.0),
    ("demand 1-5", 1.0, 5.0),
    ("demand 6-20", 6.0, 20.0),
    ("demand 21-100", 21.0, 100.0),
    ("demand > 100", 100.0, None),
)
UNBUCKETED = "unbucketed"


def floored_ratio(numerator: Column, denominator: Column, floor: float) -> Column:
    return numerator / F.greatest(denominator, F.lit(floor))


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent; 0 when there is nothing to divide by."""
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def demand_range(actual: Column) -> Column:
    matches = [
        F.when(actual > low if high is None else actual.between(low, high), name)
        for name, low, high in DEMAND_RANGES
    ]
    return F.coalesce(*matches, F.lit(UNBUCKETED))


def prediction_ratio_bucket(ratio: Column) -> Column:
    return (
        F.when(ratio < 0.5, "< 0.5")
        .when(ratio < 0.8, "0.5-0.8")
        .when(ratio <= 1.2, "0.8-1.2")
        .otherwise("> 1.2")
    )


def sse_share_label(pct_rows: Column, pct_sse: Column) -> Column:
    return (
        F.when(pct_sse > pct_rows * 2, "DISPROPORTIONATE")
        .when(pct_sse < pct_rows * 0.5, "low contribution")
        .otherwise("proportionate")
    )


def overall_bias_label(bias: Column) -> Column:
    return (
        F.when(bias > 0, "OVERPREDICTS")
        .when(bias < 0, "UNDERPREDICTS")
        .when(bias == 0, "No systematic bias")
    )


def range_bias_label(bias: Column) -> Column:
    """Per range a bias of exactly 0 counts as under-prediction."""
    return F.when(bias > 0, "overpredicts").when(bias <= 0, "underpredicts")


def safe_r2(sse: Column, tss: Column, rows: Column) -> Column:
    """NULL for fewer than two rows or a target without spread."""
    return F.when((rows > 1) & (tss > 1e-6), 1.0 - sse / tss)


def regression_metrics(actual: str = "target", predicted: str = "predicted") -> list[Column]:
    """Aggregates for ``agg``: usable ungrouped, per range, store, split or cohort.

    The total sum of squares comes from ``var_pop``, which merges partial results stably,
    and not from sums of squares, which cancel.
    """
    y, p = F.col(actual), F.col(predicted)
    error = p - y
    rows = F.count(F.lit(1))
    sse = F.sum(error * error)
    return [
        rows.alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        safe_r2(sse, F.var_pop(y) * rows, rows).alias("r2"),
        (F.sum(F.abs(error)) / F.nullif(F.sum(F.abs(y)), F.lit(0.0)) * 100.0).alias("wape"),
        F.avg(y).alias("mean_actual"),
        F.avg(p).alias("mean_pred"),
        F.avg(error).alias("bias"),
        F.coalesce(sse, F.lit(0.0)).alias("sse"),
    ]
