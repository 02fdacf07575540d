"""Item-level data quality: raw rows against daily demand against prepared series.

Everything is computed for all items at once; auditing one item is a filter on ``item_id``
(``for_item``), which reaches the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.calendar import iso_text
from demandloom.operators.quantiles import exact_median
from demandloom.schemas import DAY_KEYS

TOLERANCE = 1e-4
ARITHMETIC_TOLERANCE = 0.05


def for_item(df: DataFrame, item_id: str) -> DataFrame:
    return df.where(F.col("item_id") == item_id)


def with_arithmetic(sales: DataFrame) -> DataFrame:
    """Compare the recorded total with quantity times price, and derive the unit price."""
    expected = F.col("quantity") * F.col("price_base")
    return sales.withColumns(
        {
            "expected_sum": expected,
            "abs_diff": F.abs(F.col("sum_total") - expected),
            "effective_unit_price": F.when(
                F.col("quantity") > 0, F.col("sum_total") / F.col("quantity")
            ),
        }
    )


def transaction_granularity(sales: DataFrame) -> DataFrame:
    """Per item: rows per date and store, and whether the raw table is already daily."""
    per_day = sales.groupBy("item_id", "date", "store_id").agg(F.count(F.lit(1)).alias("tx"))
    return per_day.groupBy("item_id").agg(
        F.min("tx").alias("min_tx"),
        F.max("tx").alias("max_tx"),
        F.avg("tx").alias("mean_tx"),
        ((F.min("tx") == 1) & (F.max("tx") == 1)).alias("already_daily"),
    )


def item_statistics(sales: DataFrame) -> DataFrame:
    """Per item: quantity, price and total statistics, arithmetic consistency, coverage.

    Distinct prices are counted here and listed by ``item_prices``: a list inside a row could
    grow without bound.
    """
    q, p, t = F.col("quantity"), F.col("price_base"), F.col("sum_total")
    measured = with_arithmetic(sales).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("tx_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        # A third distinct count would copy every row for each of them; days and stores are few.
        F.size(F.collect_set("date")).cast("long").alias("distinct_dates"),
        F.size(F.collect_set("store_id")).cast("long").alias("distinct_stores"),
        F.count_distinct("price_base").alias("distinct_prices"),
        F.sum(q).alias("qty_sum"),
        F.min(q).alias("qty_min"),
        F.max(q).alias("qty_max"),
        F.avg(q).alias("qty_mean"),
        F.stddev_samp(q).alias("qty_std"),
        F.min(p).alias("price_min"),
        F.max(p).alias("price_max"),
        F.avg(p).alias("price_mean"),
        F.sum(t).alias("total_sum"),
        F.min(t).alias("total_min"),
        F.max(t).alias("total_max"),
        F.avg(t).alias("total_mean"),
        F.max("abs_diff").alias("max_arithmetic_diff"),
        F.avg("abs_diff").alias("mean_arithmetic_diff"),
        F.min("effective_unit_price").alias("min_unit_price"),
        F.max("effective_unit_price").alias("max_unit_price"),
        F.avg("effective_unit_price").alias("mean_unit_price"),
    )
    medians = exact_median(sales, "quantity", ["item_id"], "qty_median")
    return measured.join(medians, "item_id", "left").withColumn(
        "arithmetic_ok", F.col("max_arithmetic_diff") < ARITHMETIC_TOLERANCE
    )


def item_prices(sales: DataFrame) -> DataFrame:
    """Every distinct price of every item, with the rows that carry it."""
    return sales.groupBy("item_id", "price_base").agg(F.count(F.lit(1)).alias("tx_rows"))


def item_by_store(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id", "store_id").agg(
        F.count("quantity").alias("record_count"),
        F.sum("quantity").alias("qty_sum"),
        F.min("quantity").alias("qty_min"),
        F.avg("quantity").alias("qty_mean"),
        F.max("quantity").alias("qty_max"),
        F.sum("sum_total").alias("revenue"),
    )


def reaggregate(sales: DataFrame) -> DataFrame:
    """Raw rows (prices as recorded) summed again to date, store and item."""
    return (
        sales.dropna(subset=list(DAY_KEYS))
        .groupBy(*DAY_KEYS)
        .agg(
            F.count("quantity").alias("raw_tx_count"),
            F.count(F.lit(1)).alias("raw_rows"),
            F.sum("quantity").alias("raw_quantity_sum"),
            F.avg("price_base").alias("raw_price_mean"),
            F.sum("sum_total").alias("raw_sum_total"),
        )
    )


def reconcile_daily(sales: DataFrame, daily: DataFrame) -> DataFrame:
    """Raw re-aggregate against daily demand, one row per key of either side."""
    left = reaggregate(sales).withColumn("_left", F.lit(True))
    right = daily.withColumn("_right", F.lit(True))
    return left.join(right, list(DAY_KEYS), "full").select(
        *DAY_KEYS,
        "raw_tx_count",
        "raw_rows",
        "raw_quantity_sum",
        "raw_price_mean",
        "raw_sum_total",
        "daily_demand",
        "price",
        F.coalesce(F.col("raw_quantity_sum") - F.col("daily_demand"), F.lit(0.0)).alias("qty_diff"),
        F.coalesce(F.col("raw_price_mean") - F.col("price"), F.lit(0.0)).alias("price_diff"),
        F.col("_right").isNull().alias("only_raw"),
        F.col("_left").isNull().alias("only_daily"),
    )


def _differs(name: str) -> Column:
    return F.coalesce(F.max(F.abs(F.col(name))) > TOLERANCE, F.lit(False))


def reconcile_daily_by_item(sales: DataFrame, daily: DataFrame) -> DataFrame:
    """Per item: row parity, discrepancies, and keys found on one side only."""
    return (
        reconcile_daily(sales, daily)
        .groupBy("item_id")
        .agg(
            F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
            F.count_if(~F.col("only_raw")).alias("daily_rows"),
            _differs("qty_diff").alias("qty_discrepancy"),
            _differs("price_diff").alias("price_discrepancy"),
            F.count_if("only_raw").alias("only_raw"),
            F.count_if("only_daily").alias("only_daily"),
        )
        .withColumn("row_parity", F.col("raw_rows") == F.col("daily_rows"))
    )


def reconcile_prepared(daily: DataFrame, prepared: DataFrame) -> DataFrame:
    """Daily demand against prepared demand, one row per key of either side."""
    left = daily.select(*DAY_KEYS, F.col("daily_demand").alias("demand_daily"), F.lit(True).alias("_left"))
    right = prepared.select(
        *DAY_KEYS, F.col("daily_demand").alias("demand_prepared"), F.lit(True).alias("_right")
    )
    return left.join(right, list(DAY_KEYS), "full").select(
        *DAY_KEYS,
        "demand_daily",
        "demand_prepared",
        F.coalesce(F.col("demand_daily") - F.col("demand_prepared"), F.lit(0.0)).alias("qty_diff"),
        F.col("_right").isNull().alias("only_daily"),
        F.col("_left").isNull().alias("only_prepared"),
    )


def reconcile_prepared_by_item(daily: DataFrame, prepared: DataFrame) -> DataFrame:
    return (
        reconcile_prepared(daily, prepared)
        .groupBy("item_id")
        .agg(
            F.count_if(~F.col("only_prepared")).alias("daily_rows"),
            F.count_if(~F.col("only_daily")).alias("prepared_rows"),
            _differs("qty_diff").alias("qty_discrepancy"),
            F.count_if("only_daily").alias("only_daily"),
            F.count_if("only_prepared").alias("only_prepared"),
        )
        .withColumn("inserted_rows", F.col("prepared_rows") - F.col("daily_rows"))
    )


def sales_listing(sales: DataFrame, prepared: DataFrame) -> DataFrame:
    """Each raw row next to the prepared demand of its day.

    Prepared rows are unique per day, store and item, and a hot item is spread over its days.
    """
    right = prepared.select(*DAY_KEYS, F.col("daily_demand").alias("prepared_demand"))
    return sales.join(right, list(DAY_KEYS), "left").select(
        *DAY_KEYS, "quantity", "price_base", "sum_total", "prepared_demand"
    )


def item_presence(
    items: DataFrame, catalog: DataFrame, price_history: DataFrame, discounts_history: DataFrame
) -> DataFrame:
    """Per item of ``items``: rows in each side table, and its recorded price history.

    Every table is reduced to one row per item before anything is joined.
    """
    counts = {
        "catalog": catalog.groupBy("item_id").agg(F.count(F.lit(1)).alias("catalog_rows")),
        "price_history": price_history.groupBy("item_id").agg(
            F.count(F.lit(1)).alias("price_history_rows"),
            F.min("date").alias("price_first_date"),
            F.max("date").alias("price_last_date"),
            F.count_distinct("price").alias("price_points"),
        ),
        "discounts_history": discounts_history.groupBy("item_id").agg(
            F.count(F.lit(1)).alias("discounts_history_rows")
        ),
    }
    wanted = items.select("item_id").where(F.col("item_id").isNotNull()).distinct()
    found = reduce(lambda left, right: left.join(right, "item_id", "left"), counts.values(), wanted)
    row_counts = ("catalog_rows", "price_history_rows", "price_points", "discounts_history_rows")
    filled = found.withColumns({c: F.coalesce(c, F.lit(0)) for c in row_counts})
    return filled.withColumns(
        {
            "in_catalog": F.col("catalog_rows") > 0,
            "in_price_history": F.col("price_history_rows") > 0,
            "in_discounts_history": F.col("discounts_history_rows") > 0,
        }
    )


def as_report(section: str, df: DataFrame, keys: tuple[str, ...] = ("item_id",)) -> DataFrame:
    """A result as rows ``(section, *keys, metric, value, text)``: numbers and flags (0 and 1) as values,
    dates as ISO texts."""
    none = {"value": F.lit(None).cast("double"), "text": F.lit(None).cast("string")}
    entries = []
    for name, kind in df.dtypes:
        if name in keys:
            continue
        cell = dict(none)
        if kind == "date":
            cell["text"] = iso_text(F.col(name))
        elif kind in ("double", "float", "int", "bigint", "boolean"):
            cell["value"] = F.col(name).cast("double")
        else:
            continue
        entries.append(F.struct(F.lit(name).alias("metric"), *[c.alias(n) for n, c in cell.items()]))
    return df.select(F.lit(section).alias("section"), *keys, F.inline(F.array(*entries)))


def audit_report(
    sales: DataFrame,
    daily: DataFrame,
    prepared: DataFrame,
    catalog: DataFrame,
    price_history: DataFrame,
    discounts_history: DataFrame,
) -> DataFrame:
    """All sections of the item audit, stacked in long form."""
    sections = {
        "presence": item_presence(sales, catalog, price_history, discounts_history),
        "granularity": transaction_granularity(sales),
        "statistics": item_statistics(sales),
        "raw_vs_daily": reconcile_daily_by_item(sales, daily),
        "daily_vs_prepared": reconcile_prepared_by_item(daily, prepared),
    }
    return reduce(DataFrame.unionByName, [as_report(name, df) for name, df in sections.items()])
