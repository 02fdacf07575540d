"""Daily demand, its validation, and the gapless series built from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.calendar import day_span
from demandloom.functions.scoring import percentage
from demandloom.operators.checks import fold_rows
from demandloom.operators.cleaning import drop_index_column, median_positive_price, without_returns
from demandloom.operators.quantiles import exact_median
from demandloom.schemas import DAY_KEYS, SERIES_KEYS, series_window


def _with_keys(df: DataFrame) -> DataFrame:
    """Rows with a missing key belong to no group."""
    return df.dropna(subset=list(DAY_KEYS))


def aggregate_daily_demand(sales: DataFrame) -> DataFrame:
    """Sum of quantity and mean price per date, store and item, of already clean rows."""
    return (
        _with_keys(sales)
        .groupBy(*DAY_KEYS)
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("daily_demand"),
            F.avg("price_base").alias("price"),
        )
    )


def daily_demand_from_raw(
    sales: DataFrame, keep_returns: bool = True, partitions: int | None = None
) -> DataFrame:
    """Price repair and daily aggregation in one go, for raw rows.

    Same result as ``aggregate_daily_demand(clean_sales(sales))``. A group's mean needs only
    the sum and count of its good prices and the number of bad ones, so medians are joined to
    the aggregated days: raw rows are pre-aggregated where they are read and a hot series is
    spread over its dates.

    ``partitions`` sets the number of tasks of the join by series, which everything that
    follows on the same series inherits (see ``prepare_demand``).
    """
    sales = drop_index_column(sales)
    if not keep_returns:
        sales = without_returns(sales)
    price = F.col("price_base")
    days = (
        _with_keys(sales)
        .groupBy(*DAY_KEYS)
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("daily_demand"),
            F.coalesce(F.sum(F.when(price >= 0, price)), F.lit(0.0)).alias("_good_sum"),
            F.count_if(price >= 0).alias("_good"),
            F.count_if(price < 0).alias("_bad"),
        )
    )
    if partitions:
        days = days.repartition(partitions, *SERIES_KEYS)
    median = F.col("median_price")
    repaired = F.when(median.isNotNull(), F.col("_bad")).otherwise(F.lit(0))
    total = F.col("_good_sum") + F.coalesce(median, F.lit(0.0)) * repaired
    count = F.col("_good") + repaired
    return days.join(median_positive_price(sales), list(SERIES_KEYS), "left").select(
        *DAY_KEYS, "daily_demand", F.when(count > 0, total / count).alias("price")
    )


def _surplus_keys(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first per date, store and item; shuffles the keys only."""
    copies = df.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_keys")
    )


def daily_profile(daily: DataFrame) -> DataFrame:
    """One row describing a ``(date, store, item, daily_demand, price)`` table.

    Rows are reduced to counters per series where they are read; distinct items and stores
    are then counted over series. Only the duplicate check shuffles something per row.
    """
    demand, price = F.col("daily_demand"), F.col("price")
    series = daily.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("date").alias("_dates"),
        F.count("daily_demand").alias("_demands"),
        F.count("price").alias("_prices"),
        F.min("date").alias("_min_date"),
        F.max("date").alias("_max_date"),
        F.min(demand).alias("_min_demand"),
        F.max(demand).alias("_max_demand"),
        F.sum(demand).alias("_sum_demand"),
        F.count_if(demand < 0).alias("_negative"),
        F.count_if(demand == 0).alias("_zero"),
        F.min(price).alias("_min_price"),
        F.max(price).alias("_max_price"),
        F.sum(price).alias("_sum_price"),
        F.count_if(price < 0).alias("_negative_price"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    def rows_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("_rows"))), F.lit(0))

    profile = series.agg(
        total("_rows").alias("number_of_rows"),
        F.count_distinct("item_id").alias("unique_products"),
        F.count_distinct("store_id").alias("unique_stores"),
        F.min("_min_date").alias("min_date"),
        F.max("_max_date").alias("max_date"),
        (total("_rows") - total("_dates")).alias("null_date"),
        rows_where(F.col("store_id").isNull()).alias("null_store_id"),
        rows_where(F.col("item_id").isNull()).alias("null_item_id"),
        (total("_rows") - total("_demands")).alias("null_daily_demand"),
        (total("_rows") - total("_prices")).alias("null_price"),
        F.min("_min_demand").alias("min_daily_demand"),
        F.max("_max_demand").alias("max_daily_demand"),
        (F.sum("_sum_demand") / F.nullif(F.sum("_demands"), F.lit(0))).alias("mean_daily_demand"),
        total("_negative").alias("negative_daily_demand_count"),
        total("_zero").alias("zero_daily_demand_count"),
        F.min("_min_price").alias("min_price"),
        F.max("_max_price").alias("max_price"),
        (F.sum("_sum_price") / F.nullif(F.sum("_prices"), F.lit(0))).alias("mean_price"),
        total("_negative_price").alias("negative_price_count"),
    )
    surplus = _surplus_keys(daily).withColumnRenamed("duplicate_keys", "duplicate_combinations")
    return fold_rows(profile, surplus).withColumn(
        "negative_daily_demand_pct",
        percentage(F.col("negative_daily_demand_count"), F.col("number_of_rows")),
    )


def demand_median(daily: DataFrame) -> DataFrame:
    """One row: exact median of daily demand."""
    return exact_median(daily, "daily_demand", name="median_daily_demand", few_groups=True)


def market_trend(daily: DataFrame, days: int = 7) -> DataFrame:
    """Total demand per date and its trailing mean; the first days use what there is.

    The window has no partition key, but its input has one row per calendar day.
    """
    trailing = Window.orderBy("date").rowsBetween(1 - days, 0)
    return (
        daily.groupBy("date")
        .agg(F.sum("daily_demand").alias("total_demand"))
        .withColumn("trend", F.avg("total_demand").over(trailing))
    )


def series_bounds(daily: DataFrame) -> DataFrame:
    """First and last day of each series and the days from one to the other."""
    return (
        daily.groupBy(*SERIES_KEYS)
        .agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        .withColumn("span_days", day_span(F.col("first_date"), F.col("last_date")))
    )


def clip_negative(value: Column) -> Column:
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def prepared_row_count(daily: DataFrame) -> DataFrame:
    """One row ``(prepared_rows)``: how many rows ``prepare_demand`` will give."""
    return series_bounds(daily).agg(F.coalesce(F.sum("span_days"), F.lit(0)).alias("prepared_rows"))


def prepare_demand(daily: DataFrame, partitions: int | None = None) -> DataFrame:
    """Gapless series: one row per day from the first to the last sale of each series.

    Negative demand becomes 0, missing days get demand 0, prices are carried forward and
    never backward. No calendar grid is joined: each observed row, knowing the next observed
    date, emits the days up to it, so a series is hashed once and its rows stay in place for
    the feature windows. A series has at most one row per calendar day, which bounds both the
    windows and the rows that one row can emit.

    The planner sizes tasks by the observed rows and cannot foresee how many days are added.
    For sparse series set ``partitions`` by ``prepared_row_count`` (or have it set where the
    daily table is built, which saves a shuffle).
    """
    if partitions:
        daily = daily.repartition(partitions, *SERIES_KEYS)
    series = series_window()
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    observed = daily.select(
        "date",
        *SERIES_KEYS,
        F.coalesce(clip_negative(F.col("daily_demand")), F.lit(0.0)).alias("_demand"),
        F.last("price", ignorenulls=True).over(so_far).alias("price"),
        F.lead("date").over(series).alias("_next"),
    )
    last_day = F.greatest(F.date_sub("_next", 1), F.col("date"))
    return observed.select(
        "*", F.explode(F.sequence("date", F.coalesce(last_day, F.col("date")))).alias("_day")
    ).select(
        F.col("_day").alias("date"),
        *SERIES_KEYS,
        F.when(F.col("_day") == F.col("date"), F.col("_demand")).otherwise(F.lit(0.0)).alias("daily_demand"),
        "price",
    )


def _stage_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counters of one table, per series first so that distinct counts stay small."""
    demand = F.col("daily_demand")
    counters = ("rows", "negative", "null_demand", "null_price")
    per_series = df.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(demand < 0).alias("negative"),
        F.count_if(demand.isNull()).alias("null_demand"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.min(demand).alias("min_demand"),
        F.max(demand).alias("max_demand"),
    )
    return per_series.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters],
        F.count_distinct("item_id").alias("items"),
        F.count_distinct("store_id").alias("stores"),
        *[F.min(c).alias(c) for c in ("min_date", "min_demand")],
        *[F.max(c).alias(c) for c in ("max_date", "max_demand")],
    )


def preparation_report(daily: DataFrame, prepared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What preparation did, overall or per store (``by=["store_id"]``).

    Both tables are reduced to their counters first; the small results are stacked and folded
    into one row per group.
    """
    by = list(by)
    parts = {
        "daily": _stage_counts(daily, by),
        "prepared": _stage_counts(prepared, by),
        "surplus": _surplus_keys(prepared, by),
    }
    labelled = [df.withColumn("_part", F.lit(part)) for part, df in parts.items()]
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), labelled)

    def pick(part: str, name: str) -> Column:
        return F.max(F.when(F.col("_part") == part, F.col(name)))

    before, after = pick("daily", "rows"), pick("prepared", "rows")
    return stacked.groupBy(*by).agg(
        before.alias("original_rows"),
        after.alias("prepared_rows"),
        (after - before).alias("inserted_rows"),
        pick("daily", "negative").alias("negative_demand_before"),
        pick("prepared", "negative").alias("negative_demand_after"),
        pick("prepared", "null_demand").alias("null_demand"),
        pick("prepared", "null_price").alias("null_prices"),
        pick("surplus", "duplicate_keys").alias("duplicate_keys"),
        pick("prepared", "items").alias("unique_products"),
        pick("prepared", "stores").alias("unique_stores"),
        pick("prepared", "min_date").alias("min_date"),
        pick("prepared", "max_date").alias("max_date"),
        pick("prepared", "min_demand").alias("min_demand"),
        pick("prepared", "max_demand").alias("max_demand"),
    )
