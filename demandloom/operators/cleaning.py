"""Audit and repair of raw point-of-sale rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.scoring import percentage
from demandloom.operators.checks import duplicate_rows, null_count_columns
from demandloom.operators.quantiles import exact_median
from demandloom.schemas import SERIES_KEYS

INDEX_COLUMN = "Unnamed: 0"
NO_MATCH_NOTE = "no_positive_price"


def drop_index_column(sales: DataFrame) -> DataFrame:
    return sales.drop(INDEX_COLUMN)


def without_returns(sales: DataFrame) -> DataFrame:
    """Keep ``quantity >= 0``; a missing quantity goes too."""
    return sales.where(F.col("quantity") >= 0)


def audit_sales(sales: DataFrame) -> DataFrame:
    """One row of counts and shares, from one scan without a row shuffle."""
    problems: dict[str, Column] = {
        "negative_quantity": F.col("quantity") < 0,
        "zero_quantity": F.col("quantity") == 0,
        "negative_price": F.col("price_base") < 0,
        "zero_price": F.col("price_base") == 0,
        "negative_sum_total": F.col("sum_total") < 0,
    }
    data = drop_index_column(sales)
    counted = data.agg(
        F.count(F.lit(1)).alias("total_records"),
        *null_count_columns(data.columns),
        *[F.count_if(test).alias(f"{name}_count") for name, test in problems.items()],
    )
    return counted.select(
        "total_records",
        F.lit(INDEX_COLUMN in sales.columns).alias("has_index_column"),
        *[f"null_{c}" for c in data.columns],
        *[f"{name}_count" for name in problems],
        *[
            percentage(F.col(f"{name}_count"), F.col("total_records")).alias(f"{name}_pct")
            for name in problems
        ],
    )


def sales_duplicates(sales: DataFrame) -> DataFrame:
    return duplicate_rows(sales, ignore=(INDEX_COLUMN,))


def median_positive_price(sales: DataFrame) -> DataFrame:
    """``(store_id, item_id, median_price)`` over positive prices only."""
    positive = sales.where(F.col("price_base") > 0)
    return exact_median(positive, "price_base", SERIES_KEYS, "median_price")


def _negative_with_median(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("price_base") < 0).join(
        median_positive_price(sales), list(SERIES_KEYS), "left"
    )


def correct_negative_prices(sales: DataFrame) -> DataFrame:
    """Replace each negative price by the median positive price of its store and item.

    Without such a price the result is NULL. Only the negative rows meet the medians: all
    others pass straight through, unshuffled.
    """
    repaired = _negative_with_median(sales).withColumn("price_base", F.col("median_price"))
    untouched = sales.where(F.col("price_base").isNull() | (F.col("price_base") >= 0))
    return untouched.unionByName(repaired.select(*sales.columns))


def price_correction_report(sales: DataFrame) -> DataFrame:
    """One row: negative prices, how many were imputed, how many found no median."""
    negative = sales.where(F.col("price_base") < 0).groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    matched = negative.join(median_positive_price(sales), list(SERIES_KEYS), "left")
    found = F.col("median_price").isNotNull()

    def rows_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("_rows"))), F.lit(0))

    return matched.agg(
        rows_where(F.lit(True)).alias("total_negative_prices"),
        rows_where(found).alias("imputed_count"),
        rows_where(~found).alias("unmatched_count"),
    )


def unmatched_prices(sales: DataFrame) -> DataFrame:
    """Every negative-price row whose store and item has no positive price."""
    return (
        _negative_with_median(sales)
        .where(F.col("median_price").isNull())
        .select("date", *SERIES_KEYS, F.col("price_base").alias("old_price"), F.lit(NO_MATCH_NOTE).alias("note"))
    )


def imputed_price_sample(sales: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` repaired rows by date, store, item and old price."""
    return (
        _negative_with_median(sales)
        .where(F.col("median_price").isNotNull())
        .select(
            "date",
            *SERIES_KEYS,
            F.col("price_base").alias("old_price"),
            F.col("median_price").alias("imputed_price"),
        )
        .orderBy("date", *SERIES_KEYS, "old_price")
        .limit(n)
    )


def clean_sales(
    sales: DataFrame, keep_returns: bool = True, repair_prices: bool = True
) -> DataFrame:
    """Drop the index column, apply the returns switch, then repair prices."""
    cleaned = drop_index_column(sales)
    if not keep_returns:
        cleaned = without_returns(cleaned)
    return correct_negative_prices(cleaned) if repair_prices else cleaned
