"""Supervised features of a gapless series: next-day target and what is known before it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.calendar import calendar_columns
from demandloom.functions.parsing import shifted_category
from demandloom.operators.checks import unique_by
from demandloom.operators.splits import select_period
from demandloom.schemas import (
    CATEGORICAL_COLUMNS,
    FEATURE_TABLE_COLUMNS,
    MODEL_COLUMNS,
    Period,
    series_window,
)
from demandloom.session import pin

LAGS = (1, 7, 14, 28)
MEAN_WINDOWS = (7, 14, 28)
STD_WINDOWS = (7, 28)
TARGET = "target"
DEMAND = "daily_demand"


def add_target(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn(TARGET, F.lead(DEMAND, 1).over(series_window()))


def add_lags(prepared: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    series = series_window()
    return prepared.withColumns({f"lag_{k}": F.lag(DEMAND, k).over(series) for k in lags})


def add_price_change(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn(
        "price_change", F.col("price") - F.lag("price", 1).over(series_window())
    )


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("date")))


def add_rolling(
    prepared: DataFrame,
    mean_windows: Sequence[int] = MEAN_WINDOWS,
    std_windows: Sequence[int] = STD_WINDOWS,
) -> DataFrame:
    """Mean and sample deviation of the N days before each day; NULL unless there are N.

    If every window is a multiple of the shortest one, no frame slides at all: the days of the
    shortest window are lags, and the longer windows are put together from its earlier
    results (sums add up; squared deviations combine by the parallel variance formula). A
    missing lag makes a sum NULL, which is the "unless there are N" rule.
    """
    block = min([*mean_windows, *std_windows])
    if any(n % block for n in [*mean_windows, *std_windows]):
        return _add_rolling_by_frames(prepared, mean_windows, std_windows)

    series = series_window()
    days = [f"_day_{k}" for k in range(1, block + 1)]
    blocks = prepared.withColumns(
        {name: F.lag(DEMAND, k).over(series) for k, name in enumerate(days, start=1)}
    )
    blocks = blocks.withColumn("_sum_0", _total([F.col(d) for d in days]))
    center = F.col("_sum_0") / block
    blocks = blocks.withColumn("_dev_0", _total([_square(F.col(d) - center) for d in days]))
    count = max([*mean_windows, *std_windows]) // block
    earlier = {
        f"{part}_{back}": F.lag(f"{part}_0", back * block).over(series)
        for back in range(1, count)
        for part in ("_sum", "_dev")
    }
    blocks = blocks.withColumns(earlier) if earlier else blocks
    sums = [F.col(f"_sum_{back}") for back in range(count)]
    devs = [F.col(f"_dev_{back}") for back in range(count)]

    def mean(n: int) -> Column:
        return _total(sums[: n // block]) / n

    def std(n: int) -> Column:
        k = n // block
        between = _total([_square(s / block - mean(n)) for s in sums[:k]]) * block
        deviations = _total(devs[:k]) + between if k > 1 else devs[0]
        return F.sqrt(deviations / (n - 1))

    return blocks.withColumns(
        {
            **{f"rolling_mean_{n}": mean(n) for n in mean_windows},
            **{f"rolling_std_{n}": std(n) for n in std_windows},
        }
    ).drop(*days, "_sum_0", "_dev_0", *earlier)


def _total(parts: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left + right, parts)


def _square(value: Column) -> Column:
    return value * value


def _add_rolling_by_frames(
    prepared: DataFrame, mean_windows: Sequence[int], std_windows: Sequence[int]
) -> DataFrame:
    series = series_window()

    def over_full(n: int, aggregate: Column) -> Column:
        frame = series.rowsBetween(-n, -1)
        return F.when(F.count(F.lit(1)).over(frame) == n, aggregate.over(frame))

    return prepared.withColumns(
        {
            **{f"rolling_mean_{n}": over_full(n, F.avg(DEMAND)) for n in mean_windows},
            **{f"rolling_std_{n}": over_full(n, F.stddev_samp(DEMAND)) for n in std_windows},
        }
    )


def features_for_period(prepared: DataFrame, period: Period) -> DataFrame:
    """``series_features`` of one period, from the days that its rows look at.

    A date filter can't pass below the windows by itself. The series are gapless, so the longest lag
    before the first day and the target's day after the last one are all that is needed.
    """
    needed = F.col("date").between(
        F.lit(period.start - dt.timedelta(max(*LAGS, *MEAN_WINDOWS, *STD_WINDOWS))),
        F.lit(period.end + dt.timedelta(1)),
    )
    return select_period(series_features(prepared.where(needed)), period)


def series_features(prepared: DataFrame) -> DataFrame:
    """All features that come from the series itself; rows without a target are dropped.

    Today's demand is dropped as well: it is no model input.
    """
    featured = add_calendar(add_rolling(add_price_change(add_lags(add_target(prepared)))))
    return featured.where(F.col(TARGET).isNotNull()).drop(DEMAND)


def attach_items(
    features: DataFrame, items: DataFrame, codes: DataFrame, trusted: bool = False
) -> DataFrame:
    """Add ``item_code`` (unknown -1) and catalog codes (uncatalogued NULL).

    Both lookups are per item, so they are joined to each other first and the features meet
    one dimension table. It is pinned, so that its true size decides whether the wide feature
    rows stay where they are (broadcast) or are shuffled by item. ``codes`` must hold each
    item once: that is checked unless ``trusted``.
    """
    codes = codes if trusted else unique_by(codes, ["item_id"])
    dimension = pin(items.join(codes, "item_id", "left"), "item-dimension")
    return features.join(dimension, "item_id", "left").withColumn(
        "item_code", F.coalesce("item_code", F.lit(-1))
    )


def build_features(prepared: DataFrame, items: DataFrame, codes: DataFrame, trusted: bool = False) -> DataFrame:
    """The 28-column feature table."""
    return attach_items(series_features(prepared), items, codes, trusted).select(*FEATURE_TABLE_COLUMNS)


def model_input(features: DataFrame, extra: Sequence[str] = ("date", "item_id", TARGET)) -> DataFrame:
    """Model columns as the trees read them: float numbers, categories from 0 (missing)."""
    return features.select(
        *[c for c in extra if c in features.columns],
        *[
            shifted_category(F.col(c), c).alias(c)
            if c in CATEGORICAL_COLUMNS
            else F.col(c).cast("float").alias(c)
            for c in MODEL_COLUMNS
        ],
    )


def feature_report(prepared: DataFrame, features: DataFrame) -> DataFrame:
    """One row: rows in and out, rows without a target, date range, target statistics."""
    target = F.col(TARGET)
    built = features.agg(
        F.lit(0).cast("long").alias("input_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.min(target).alias("target_min"),
        F.max(target).alias("target_max"),
        F.avg(target).alias("target_mean"),
        F.stddev_pop(target).alias("target_std"),
    )
    read = prepared.agg(F.count(F.lit(1)).alias("input_rows"))
    folded = built.unionByName(read, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in built.columns]
    )
    return folded.withColumn("rows_without_target", F.col("input_rows") - F.col("output_rows"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early on an empty feature set or period (reads at most one row)."""
    if df.isEmpty():
        raise RuntimeError(f"no rows found for {what}")
    return df

